"""Is every row of the source in the target, and how often?

The work happens on one frame, :func:`key_coverage`: source and target keys
are stacked and counted per key in a single hash aggregate. Each task first
reduces its own rows to one per key, so a key that holds a third of either
side costs one row per task in the shuffle. No join is involved, and neither
side has to be unique.

Keys with a NULL part never match anything. They are counted apart and take
no part in ranges or repairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StringType

from gapmend.functions.columns import any_null, as_list, named, none_null, quoted
from gapmend.operators.joins import join_unique
from gapmend.operators.ranges import in_range
from gapmend.shared import Written, narrow_scan, plan_bytes, write_shared

Keys = str | Sequence[str]

# Copies of one source row that a task writes out at a time.
COPIES_PER_PART = 100_000

# A target is narrowed to the keys of a source that is so many times smaller.
NARROW_FROM = 16


def key_coverage(source: DataFrame, target: DataFrame, keys: Keys) -> DataFrame:
    """One row per distinct source key: ``source_rows`` and ``target_rows``.

    Where the plans say that the source is much smaller than the target, its
    keys are counted and written first, and only target keys that can match
    are shuffled.
    """
    keys = as_list(keys)
    source, target = same_types(source, target, keys)
    if is_much_smaller(source, target, keys):
        counts = count_keys(source, keys)
        return compare_keys(counts.frame, narrowed(target, counts, keys), keys)
    return compare_keys(source.select(*map(named, keys), F.lit(1).cast("bigint").alias("source_rows")), target, keys)


def is_much_smaller(source: DataFrame, target: DataFrame, keys: list[str]) -> bool:
    return NARROW_FROM * plan_bytes(source.select(*map(named, keys))) < plan_bytes(target.select(*map(named, keys)))


def same_types(source: DataFrame, target: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with keys of the type in which Spark would compare them, so
    that every step after this compares the same values."""
    common = source.select(*map(named, keys)).union(target.select(*map(named, keys))).schema
    sides = []
    for side in (source, target):
        own = side.select(*map(named, keys)).schema
        casts = {
            name: named(name).cast(both.dataType)
            for name, mine, both in zip(keys, own, common) if mine.dataType != both.dataType
        }
        sides.append(side.withColumns(casts) if casts else side)
    return sides[0], sides[1]


def in_one_order(df: DataFrame, other: DataFrame, key: str) -> bool:
    """Whether a range of ``other`` holds for ``df`` and survives the driver:
    equal types, or whole numbers of any size. Numbers in text have another
    order, floating-point keys are rounded, and times depend on a zone."""
    one, two = (side.select(named(key)).schema[0].dataType for side in (df, other))
    if isinstance(one, IntegralType) and isinstance(two, IntegralType):
        return True
    return one == two and isinstance(one, (DecimalType, StringType, DateType))


def count_keys(source: DataFrame, keys: Keys) -> Written:
    """Write ``source_rows`` of each source key, NULL keys too."""
    counts = source.groupBy(*map(named, as_list(keys))).agg(F.count(F.lit(1)).alias("source_rows"))
    return write_shared(counts, "source-keys", narrow=True)


def narrowed(target: DataFrame, counts: Written, keys: Keys) -> DataFrame:
    """The target rows whose key the source can have.

    The range of each key column is pushed to the scan of the target as plain
    values, and keys that were measured to be few are broadcast against it;
    beyond that a shuffled semi-join would move as much as the count itself,
    so the count alone goes on.
    """
    keys = as_list(keys)
    bounds = [f(named(k)) for k in keys for f in (F.min, F.max)]
    row = counts.frame.where(none_null(keys)).agg(*bounds).first()
    for i, key in enumerate(keys):
        if row[2 * i] is None:
            return target.where(F.lit(False))
        if in_one_order(target, counts.frame, key):
            target = in_range(target, key, row[2 * i], row[2 * i + 1])
    if counts.fits_broadcast():
        target = target.join(F.broadcast(counts.frame.select(*map(named, keys))), keys, "left_semi")
    return target


def compare_keys(counted: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`key_coverage` of source rows that may be counted already."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    left = counted.select(*map(named, keys), "source_rows", none.alias("target_rows"))
    right = target.where(none_null(keys)).select(
        *map(named, keys), none.alias("source_rows"), one.alias("target_rows")
    )
    return (
        left.unionByName(right)
        .groupBy(*map(named, keys))
        .agg(
            F.sum("source_rows").alias("source_rows"),
            F.sum("target_rows").alias("target_rows"),
        )
        .where(F.col("source_rows") > 0)
    )


def is_missing(keys: Keys) -> Column:
    """True on the rows of :func:`key_coverage` that the target lacks."""
    return (F.col("target_rows") == 0) & none_null(as_list(keys))


def coverage_metrics(keys: Keys) -> list[Column]:
    """The aggregates over :func:`key_coverage` that describe a coverage."""
    keys = as_list(keys)
    missing, rows = is_missing(keys), F.col("source_rows")
    metrics = [
        F.coalesce(F.sum(rows), F.lit(0)).alias("source_rows"),
        _joined_rows().alias("matched_rows"),
        F.coalesce(F.sum(F.when(missing, rows)), F.lit(0)).alias("missing_rows"),
        F.count_if(missing).alias("missing_keys"),
        F.count_if(F.col("target_rows") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(any_null(keys), rows)), F.lit(0)).alias("null_keys"),
    ]
    if len(keys) == 1:
        only = F.when(missing, named(keys[0]))
        metrics += [F.min(only).alias("min_missing"), F.max(only).alias("max_missing")]
    return metrics


def _joined_rows() -> Column:
    """Size of the join, exact also for a key that is hot on both sides.

    Its part can be beyond a ``bigint``, so it is summed up as a decimal. The
    other keys stay with whole numbers, which are faster.
    """
    source, target = F.col("source_rows"), F.col("target_rows")
    usual = (source < 40_000) & (target < 40_000)
    product = source.cast("decimal(19,0)") * target.cast("decimal(19,0)")
    low = F.coalesce(F.sum(F.when(usual, source * target)), F.lit(0))
    high = F.coalesce(F.sum(F.when(~usual, product)), F.lit(0))
    return (low.cast("decimal(38,0)") + high).cast("decimal(38,0)")


def coverage_status() -> Column:
    """Compare counts only: equal is ``present``, more in the target is
    ``duplicated``, fewer is ``missing``. Duplicates can hide gaps in it, so
    decide on ``missing_rows``."""
    source, matched = F.col("source_rows"), F.col("matched_rows")
    return (
        F.when(matched == source, "present")
        .when(matched > source, "duplicated")
        .otherwise("missing")
    )


def coverage(source: DataFrame, target: DataFrame, keys: Keys, dense: bool = False) -> DataFrame:
    """One row that says how well ``target`` covers ``source``.

    ``matched_rows`` is NULL in the odd case that it does not fit a bigint;
    the status is right all the same. ``dense`` says that the key is a whole
    number with few gaps and few copies: words of 64 keys are compared then, and
    only words with copies are counted key by key. The answer is the same.
    """
    if dense:
        if not have_words(source, target, as_list(keys)):
            raise ValueError("words are for one key of whole numbers on both sides")
        return _with_status(coverage_by_words(source, target, as_list(keys)[0]))
    return _with_status(key_coverage(source, target, keys).agg(*coverage_metrics(keys)))


def _with_status(counted: DataFrame) -> DataFrame:
    return counted.withColumn("status", coverage_status()).withColumn(
        "matched_rows", F.col("matched_rows").try_cast("bigint")
    )


def missing_keys(source: DataFrame, target: DataFrame, keys: Keys) -> DataFrame:
    """Source keys that the target lacks, with their number of source rows.

    One key of whole numbers is looked up in words of 64 keys, so that a target
    of dense keys shuffles a row for each word. Other keys are counted.
    """
    keys = as_list(keys)
    if have_words(source, target, keys) and not is_much_smaller(source, target, keys):
        return missing_by_words(source, target, keys[0])
    counted = key_coverage(source, target, keys).where(is_missing(keys))
    return counted.select(*map(named, keys), "source_rows")


def have_words(source: DataFrame, target: DataFrame, keys: list[str]) -> bool:
    """Whether both sides have one key of whole numbers."""
    kinds = [side.select(named(keys[0])).schema[0].dataType for side in (source, target)]
    return len(keys) == 1 and all(isinstance(kind, IntegralType) for kind in kinds)


# Whole numbers in words: bit ``k & 63`` of word ``k >> 6`` stands for key k.


def _word(key: str) -> Column:
    return F.shiftright(named(key).cast("bigint"), 6)


def _bit(key: str) -> Column:
    return F.expr(f"shiftleft(1L, CAST(CAST({quoted(key)} AS BIGINT) & 63 AS INT))")


def key_words(df: DataFrame, key: str) -> DataFrame:
    """``word`` and ``bits``: which keys ``df`` has, one row for each 64 keys.

    ``bit_or`` is a hash aggregate on one long, so each task reduces its rows to
    words before the shuffle. Sparse keys have no more words than keys.
    """
    rows = df.where(named(key).isNotNull()).select(_word(key).alias("word"), _bit(key).alias("bit"))
    return rows.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def missing_by_words(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """:func:`missing_keys` of one key of whole numbers."""
    source, target = same_types(source, target, [key])
    have = key_words(target, key).withColumnsRenamed({"word": "_word", "bits": "_bits"})
    # Source keys are counted first, so that no hot key meets the join, which is
    # a broadcast where the words are few and else a shuffle of distinct keys.
    counts = source.where(named(key).isNotNull()).groupBy(named(key)).agg(F.count(F.lit(1)).alias("source_rows"))
    there = (_word(key) == F.col("_word")) & (F.col("_bits").bitwiseAND(_bit(key)) != 0)
    return counts.join(have, there, "left_anti")


def coverage_by_words(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The figures of :func:`coverage_metrics` for a key of whole numbers.

    Words in which no key has a copy on either side tell all by their bits. The
    rows of other words, which are written, are read again and counted by key.
    """
    source, target = same_types(source, target, [key])
    kind = source.select(named(key)).schema[0].dataType
    target = target.where(named(key).isNotNull())
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.select(
            _word(key).alias("word"), F.coalesce(_bit(key), none).alias(f"{mine}_bits"), one.alias(f"{mine}_rows"),
            none.alias(f"{other}_bits"), none.alias(f"{other}_rows"),
        )

    stacked = side(source, "source", "target").unionByName(side(target, "target", "source"))
    sides = ("source", "target")
    held = [F.bit_or(f"{s}_bits").alias(f"{s}_bits") for s in sides] + [F.sum(f"{s}_rows").alias(f"{s}_rows") for s in sides]
    words = write_shared(stacked.groupBy("word").agg(*held), "key-words", narrow=True).frame
    # Source rows without a key are in a word of their own.
    unique = " AND ".join(f"{s}_rows = bit_count({s}_bits)" for s in sides)
    plain = words.where(f"word IS NULL OR ({unique})").withColumn("gaps", F.expr("source_bits & ~target_bits"))
    digits = "length(bin(gaps))"
    lowest, highest = (
        F.when(F.col("gaps") != 0, F.expr(f"word * 64 + ({digits} - {less})")).cast(kind)
        for less in ("length(rtrim('0', bin(gaps)))", "1")
    )
    missing = F.sum(F.expr("bit_count(gaps)").cast("bigint"))
    by_bits = plain.agg(
        F.sum("source_rows").alias("source_rows"), F.sum(F.expr("bit_count(source_bits & target_bits)")).alias("matched_rows"),
        missing.alias("missing_rows"), missing.alias("missing_keys"), none.alias("duplicated_keys"),
        F.sum(F.when(F.col("word").isNull(), F.col("source_rows"))).alias("null_keys"),
        F.min(lowest).alias("min_missing"), F.max(highest).alias("max_missing"),
    )
    others = write_shared(words.where(f"word IS NOT NULL AND NOT ({unique})").select(F.col("word").alias("_word")), "other-words")
    rows = [df.join(others.for_join(), _word(key) == F.col("_word"), "left_semi") for df in (source, target)]
    counted = rows[0].select(named(key), one.alias("source_rows"))
    by_key = compare_keys(counted, rows[1], [key]).agg(*coverage_metrics(key))
    both = by_bits.unionByName(by_key)
    figures = [c for c in both.columns if not c.endswith("_missing")]
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast(by_key.schema[c].dataType).alias(c) for c in figures]
    return both.agg(*totals, F.min("min_missing").alias("min_missing"), F.max("max_missing").alias("max_missing"))


def missing_preview(source: DataFrame, target: DataFrame, keys: Keys, n: int = 20) -> DataFrame:
    """The ``n`` lowest missing keys, in order."""
    keys = as_list(keys)
    return missing_keys(source, target, keys).orderBy(*map(named, keys)).limit(n)


def missing_range(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Lowest and highest missing key, one row; NULLs when nothing is missing."""
    return missing_keys(source, target, key).agg(
        F.min(named(key)).alias("min_missing"), F.max(named(key)).alias("max_missing")
    )


def matched_rows(source: DataFrame, target: DataFrame, keys: Keys) -> DataFrame:
    """Source rows that the target has, each once, with its ``target_rows``.

    The target is counted per key before the join, so its copies are never
    paired up one by one; hot source keys are joined apart.
    """
    keys = as_list(keys)
    copies = (
        target.where(none_null(keys))
        .groupBy(*map(named, keys))
        .agg(F.count(F.lit(1)).alias("target_rows"))
    )
    return join_unique(source, copies, keys, "inner").select(
        *map(named, source.columns), "target_rows"
    )


def matched_copies(
    source: DataFrame, target: DataFrame, keys: Keys, per_part: int = COPIES_PER_PART
) -> DataFrame:
    """The equi-join itself: one row for each target copy of a source row.

    The copies are counted before the join and spelled out after it. A key
    with more than ``per_part`` copies is first cut into parts of that size,
    which are spread over all tasks, so no task writes out a hot key alone.
    (AQE would not notice one: equal keys compress to next to nothing in a
    shuffle.) Use :func:`matched_rows` or :func:`coverage` when the number of
    copies is enough.
    """
    found = matched_rows(source, target, keys).withColumnRenamed("target_rows", "_copies")
    copies, part = F.col("_copies"), F.col("_part")
    tasks = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_part = F.ceil(copies / per_part) - 1
    hot = (
        found.where(copies > per_part)
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part)))
        .repartition(tasks, *map(named, as_list(keys)), part)
        .withColumn("_copies", F.least(F.lit(per_part), copies - part * per_part))
        .drop("_part")
    )
    each = F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy")
    parts = found.where(copies <= per_part).unionByName(hot)
    return parts.select(*map(named, source.columns), each).drop("_copy")


def present_key_days(
    source: DataFrame, target: DataFrame, keys: Keys, day: str = "day"
) -> DataFrame:
    """The days on which each source key already lives in the target.

    One row per key and day with the copies on both sides. Both sides are
    counted first, so a key brings at most one row per day to the join.
    """
    keys = as_list(keys)
    per_day = (
        target.where(none_null(keys))
        .groupBy(*map(named, keys), named(day))
        .agg(F.count(F.lit(1)).alias("target_rows"))
    )
    per_key = (
        source.where(none_null(keys))
        .groupBy(*map(named, keys))
        .agg(F.count(F.lit(1)).alias("source_rows"))
    )
    return per_day.join(per_key, keys, "inner").select(
        *map(named, keys), named(day), "source_rows", "target_rows"
    )


def find_missing(source: DataFrame, target: DataFrame, keys: Keys) -> Written:
    """Write the missing keys to the shared folder."""
    keys = as_list(keys)
    missing = missing_keys(source, target, keys).select(*map(named, keys))
    return write_shared(missing, "missing-keys", narrow=True)


def missing_rows(
    source: DataFrame, target: DataFrame, keys: Keys, missing: Written | None = None
) -> DataFrame:
    """Whole source rows whose key the target lacks.

    Works in two steps, so that the wide source rows are shuffled only when
    there is no other way: the first step reads keys alone and writes the
    missing ones, the second reads the source again and keeps their rows.
    The second step broadcasts the missing keys if they were measured to be
    few, and is a shuffled semi-join otherwise.
    """
    keys = as_list(keys)
    missing = missing or find_missing(source, target, keys)
    return join_unique(source, missing, keys, "left_semi").select(
        *map(named, source.columns)
    )


def rows_in_missing_range(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """All source rows from the lowest to the highest missing key.

    The two bounds come to the driver first: as plain values they reach the
    scan of the source, which a subquery would not.
    """
    with narrow_scan(source.sparkSession):
        bounds = missing_range(source, target, key).first()
    if bounds.min_missing is None:
        return source.where(F.lit(False))
    return in_range(source, key, bounds.min_missing, bounds.max_missing)
