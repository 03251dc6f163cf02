"""Find and remove repeated keys in a day-partitioned table.

The first step is always a count per key, which needs the key columns only
and reduces hot keys inside each task. The duplicated keys, normally few, are
written to the shared folder; later steps look at their rows alone.

No step sorts or collects the copies of a hot key in one task. While no key has
more than ``HOT_ROWS`` copies, rows of duplicated keys are shuffled by key once:
a Bloom filter drops the others where they are read, and the rows are counted or
ordered where they arrive. Above that, copies are counted per key and day (and
file) before any window or shuffle, and the surviving copy is chosen by an
aggregate that each task applies to its own rows first. Rows whose key has a
NULL part are never duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType, VariantType

from gapmend.functions.columns import any_null, as_list, named, none_null, quoted
from gapmend.operators.gaps import Keys, key_coverage
from gapmend.operators.joins import HOT_ROWS, join_unique, row_filter
from gapmend.shared import Written, broadcast_limit, write_shared

# Copies of a key on one day that one task numbers.
HOT_COPIES = 1_000_000


def duplicate_keys(df: DataFrame, keys: Keys) -> DataFrame:
    """Keys that occur more than once, with their number of ``copies``."""
    keys = as_list(keys)
    return (
        df.where(none_null(keys))
        .groupBy(*map(named, keys))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def source_keys_duplicated(source: DataFrame, target: DataFrame, keys: Keys) -> DataFrame:
    """Source keys that the target holds more than once."""
    return key_coverage(source, target, keys).where(F.col("target_rows") > 1)


def find_duplicates(df: DataFrame, keys: Keys) -> Written:
    """Write the duplicated keys and their copies to the shared folder."""
    return write_shared(duplicate_keys(df, keys), "duplicate-keys", narrow=True)


def most_copies(duplicates: Written) -> int:
    """Copies of the most frequent key."""
    return duplicates.frame.agg(F.max("copies")).first()[0] or 0


def copies_by(
    df: DataFrame, keys: list[str], by: list[str], duplicates: Written
) -> DataFrame:
    """Number of copies of each duplicated key per value of ``by``."""
    # Written above the aggregate on purpose: Catalyst moves the semi-join
    # below it when the keys can be broadcast, and otherwise the shuffle of
    # the join carries counts instead of rows.
    return (
        df.groupBy(*map(named, keys), *map(named, by))
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(duplicates.for_join(), keys, "left_semi")
    )


def counts_are_sent(duplicates: Written) -> bool:
    """Whether counts have to be shuffled instead of rows, for a key is hot."""
    return not duplicates.fits_broadcast() and most_copies(duplicates) > HOT_ROWS


# A number of the whole key, for the filter that Spark makes of a join's first column.
HASH = "_key_hash"


def _hash(df: DataFrame, keys: list[str]):
    """The number of a key; keys that are equal by a collation share but one."""
    types = [f.dataType for f in df.select(*map(named, keys)).schema.fields]
    plain = all(isinstance(t, AtomicType) and "collate" not in t.simpleString() for t in types)
    return F.xxhash64(*map(named, keys)) if plain else F.lit(0).cast("bigint")


def rows_of(df: DataFrame, keys: list[str], duplicates: Written) -> DataFrame:
    """The rows of duplicated keys and ``HASH``; those of one key meet in one task.

    To be run within :func:`row_filter`.
    """
    right = duplicates.frame.where(F.col("copies") > 1)
    right = right.select(_hash(right, keys).alias(HASH), *map(named, keys))
    how = "broadcast" if duplicates.fits_broadcast() else "merge"
    return df.withColumn(HASH, _hash(df, keys)).join(right.hint(how), [HASH, *keys], "left_semi")


def _counted(df: DataFrame, keys: list[str], by: list[str], duplicates: Written) -> DataFrame:
    rows = rows_of(df, keys, duplicates)
    return rows.groupBy(HASH, *map(named, keys), *map(named, by)).agg(F.count(F.lit(1)).alias("copies"))


@contextmanager
def copies_to_write(df: DataFrame, keys: list[str], by: list[str], duplicates: Written) -> Iterator[DataFrame]:
    """:func:`copies_by`, to be written in the body: while no key is hot, rows are
    filtered where they are read."""
    if duplicates.fits_broadcast() or counts_are_sent(duplicates):
        yield copies_by(df, keys, by, duplicates)
        return
    columns = [*map(named, keys), *map(named, by), "copies"]
    with row_filter(duplicates):
        yield _counted(df, keys, by, duplicates).select(*columns)


def write_copies(df: DataFrame, keys: list[str], by: list[str], duplicates: Written) -> Written:
    """:func:`copies_by` as a table."""
    with copies_to_write(df, keys, by, duplicates) as counted:
        return write_shared(counted, "copies", narrow=True)


def number_copies(copies: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Turn copies per key and day into the numbers of the extra copies."""
    in_order = Window.partitionBy(*map(named, keys)).orderBy(named(day))
    last = F.sum("copies").over(in_order)
    first = F.greatest(F.col("last_rno") - F.col("copies") + 1, F.lit(2))
    return (
        copies.withColumn("last_rno", last)
        .withColumn("first_rno", first)
        .withColumn("extra_rows", F.col("last_rno") - F.col("first_rno") + 1)
        .where(F.col("extra_rows") > 0)
        .select(*map(named, keys), named(day), "first_rno", "last_rno", "extra_rows")
    )


def duplicate_occurrences(
    df: DataFrame,
    keys: Keys,
    day: str = "day",
    duplicates: Written | None = None,
) -> DataFrame:
    """The second and later copies of each key, in day order.

    Numbering the copies of a key by day gives those of one day consecutive
    numbers, so a day is one row: its copies from number ``first_rno`` to
    ``last_rno`` (never number 1, the copy that stays), ``extra_rows`` in all.
    """
    keys = as_list(keys)
    duplicates = duplicates or find_duplicates(df, keys)
    return number_copies(_copies(df, keys, day, duplicates), keys, day)


def _copies(df: DataFrame, keys: list[str], day: str, duplicates: Written) -> DataFrame:
    if duplicates.fits_broadcast():
        return copies_by(df, keys, [day], duplicates)
    return write_copies(df, keys, [day], duplicates).frame


def number_rows(
    df: DataFrame,
    keys: Keys,
    order_by: Sequence[str],
    day: str = "day",
    duplicates: Written | None = None,
) -> DataFrame:
    """The second and later copies themselves, each with its number ``rno``.

    Copies are numbered by day and within a day by ``order_by``, ties by the
    columns that hold plain values. Copies of a key on one day that are more than
    ``HOT_COPIES`` are dealt to tasks by ranges of the same order, whose sizes are
    added up, so that no task sorts a hot key alone and the numbers are the same.
    """
    keys = as_list(keys)
    duplicates = duplicates or find_duplicates(df, keys)
    rows = df.join(duplicates.for_join(), keys, "left_semi")
    per_day = _copies(df, keys, day, duplicates)
    earlier = Window.partitionBy(*map(named, keys)).orderBy(named(day)).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(earlier), F.lit(0))
    per_day = per_day.select(*map(named, keys), named(day), "copies", before.alias("_before"))
    key_day = [*map(named, keys), named(day)]
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    order = [*map(named, order_by), *(named(c) for c in plain if c not in order_by)]
    # A day may be NULL, which a join by name would lose.
    same = [named(k) == F.col(f"_right.{quoted(k)}") for k in keys] + [named(day).eqNullSafe(F.col(f"_right.{quoted(day)}"))]

    def matched(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.select(F.struct("*").alias("_right")), same)

    names = list(map(named, df.columns))
    place = Window.partitionBy(*key_day).orderBy(*order)
    hot_keys = duplicates.frame.where(F.col("copies") > HOT_COPIES)
    hot_rows = hot_keys.agg(F.sum("copies")).first()[0] or 0
    few = per_day.where(F.col("copies") <= HOT_COPIES)
    if hot_rows:
        # One row for each HOT_COPIES rows of the table at most: broadcast, so that
        # hot copies are dealt before any join could gather them.
        found = write_shared(per_day.where(F.col("copies") > HOT_COPIES), "hot-pairs").frame
        pairs = F.broadcast(found.select(F.struct("*").alias("_right")))
        hot, rows = rows.join(pairs, same), rows.join(pairs, same, "left_anti")
    usual = matched(rows, few).withColumn("rno", F.col("_right._before") + F.row_number().over(place)).select(*names, "rno")
    if not hot_rows:
        return usual.where(F.col("rno") > 1)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-hot_rows // HOT_COPIES))
    many = hot.select(*names, F.col("_right._before").alias("_before"))
    dealt = many.repartitionByRange(tasks, *key_day, *order).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part", *key_day).orderBy(*order)
    # Written, since ranges that are drawn again could differ.
    many = write_shared(dealt.withColumn("_row", F.row_number().over(inside)), "hot-copies").frame
    sizes = many.groupBy(*key_day, "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*key_day).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*key_day, "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    part = [*same, F.col("_part") == F.col("_right._part")]
    many = many.join(sizes.select(F.struct("*").alias("_right")), part).withColumn(
        "rno", F.col("_before") + F.col("_right._ahead") + F.col("_row")
    )
    return usual.unionByName(many.select(*names, "rno")).where(F.col("rno") > 1)


def _known_to(
    source: DataFrame, keys: list[str], shared: list[str], duplicates: Written
) -> Written:
    """The duplicated keys whose ``shared`` part occurs in ``source``."""
    parts = duplicates.for_join().select(*map(named, shared))
    hits = source.select(*map(named, shared)).distinct().join(parts, shared, "left_semi")
    return write_shared(
        join_unique(duplicates.frame, hits, shared, "left_semi").select(*map(named, keys), "copies"),
        "duplicate-source-keys",
        narrow=True,
    )


def duplicate_files(
    df: DataFrame,
    keys: Keys,
    source: DataFrame | None = None,
    source_keys: Keys | None = None,
    day: str = "day",
    filename: str = "filename",
    duplicates: Written | None = None,
) -> DataFrame:
    """The days and files that hold second and later copies of a key.

    ``extra_rows`` counts the copies to remove from the file; the copy in the
    first file of the first day stays. With ``source``, only keys that occur
    there are reported; ``source_keys`` names its part of the key when it has
    only some of the key columns.
    """
    keys = as_list(keys)
    shared = as_list(source_keys or keys)
    if source is not None and shared == keys and duplicates is None:
        found = source_keys_duplicated(source, df, keys).select(
            *map(named, keys), F.col("target_rows").alias("copies")
        )
        duplicates = write_shared(found, "duplicate-source-keys", narrow=True)
    else:
        duplicates = duplicates or find_duplicates(df, keys)
        if source is not None:
            duplicates = _known_to(source, keys, shared, duplicates)
    columns = [*map(named, keys), named(day), named(filename)]
    if counts_are_sent(duplicates):
        per_file = write_copies(df, keys, [day, filename], duplicates).frame
        place = F.struct(named(day), named(filename))
        # A key's smallest place is found by an aggregate, not by a window over all
        # its files, and a key in very many files is joined apart.
        first = per_file.groupBy(*map(named, keys)).agg(F.min(place).alias("first_place"))
        rows = join_unique(per_file, first, keys, "inner", most_copies(duplicates))
        is_first = place.eqNullSafe(F.col("first_place"))
    else:
        rows = _counted(df, keys, [day, filename], duplicates)
        is_first = F.row_number().over(Window.partitionBy(HASH, *map(named, keys)).orderBy(named(day), named(filename))) == 1
    extra = rows.withColumn("extra_rows", F.col("copies") - F.when(is_first, 1).otherwise(0))
    extra = extra.where(F.col("extra_rows") > 0).select(*columns, "extra_rows")
    # Written, so that a sort of the result does not compute it twice.
    with row_filter(duplicates):
        return write_shared(extra, "duplicate-files", narrow=True).frame


def survivors(df: DataFrame, keys: list[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the lowest in ``order_by``.

    An aggregate, not a window: every task keeps one candidate per key before
    the shuffle.
    """
    grouped = {name.lower() for name in keys}
    rest = [name for name in df.columns if name.lower() not in grouped]
    if not rest:
        return df.distinct()
    kept = F.min_by(
        F.struct(*map(named, rest)), F.struct(*map(named, order_by or rest))
    )
    chosen = df.groupBy(*map(named, keys)).agg(kept.alias("_kept"))
    fields = [F.col("_kept").getField(name).alias(name) for name in rest]
    return chosen.select(*map(named, keys), *fields).select(*map(named, df.columns))


# Rows of a file that one row of bits stands for, 64 in each word.
BLOCK_ROWS = 32_768
# A block as it is broadcast: its words, the file's name and what holds them.
BLOCK_BYTES = 8 * 1024
# Scans of the table that one plan may hold, one for each batch of files.
MOST_BATCHES = 64


def has_places(df: DataFrame) -> bool:
    """Whether each row of ``df`` is one row of a file that is known by file and
    position, as in filters and projections of Parquet files."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias", "View"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema
    except AnalysisException:
        return False
    return True


def losers(df: DataFrame, keys: list[str], order_by: Sequence[str], duplicates: Written) -> Written:
    """The rows that are not the first of their key, as bits: ``file``, ``block``
    (of ``BLOCK_ROWS`` rows) and ``words``.

    The first is the lowest in ``order_by``, ties by file and position. Keys,
    order and places are all that is read and shuffled.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    columns = dict.fromkeys([*keys, *order_by])
    narrow = df.select(*map(named, columns), *place)
    order = [*(named(c).alias(f"_{i}") for i, c in enumerate(order_by)), "_file", "_row"]
    rows = None
    if counts_are_sent(duplicates):
        rows = join_unique(narrow, duplicates, keys, "left_semi", most_copies(duplicates))
        rows = write_shared(rows, "duplicate-places", narrow=True)
        first = rows.frame.groupBy(*map(named, keys)).agg(F.min(F.struct(*order)).alias("_first")).select("_first._file", "_first._row")
        gone = rows.frame.select("_file", "_row").join(first, ["_file", "_row"], "left_anti")
    else:
        in_order = Window.partitionBy(HASH, *map(named, keys)).orderBy(*map(named, order_by), "_file", "_row")
        gone = rows_of(narrow, keys, duplicates).withColumn("_place", F.row_number().over(in_order)).where("_place > 1")
    row = F.col("_row")
    word = F.shiftright(row.bitwiseAND(F.lit(BLOCK_ROWS - 1)), 6).cast("int")
    bit = F.expr("shiftleft(1L, CAST(_row & 63 AS INT))")
    words = gone.groupBy(
        F.col("_file").alias("file"), F.floor(row / BLOCK_ROWS).cast("bigint").alias("block"), word.alias("word")
    ).agg(F.bit_or(bit).alias("bits"))
    held = words.groupBy("file", "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    numbers = F.sequence(F.lit(0), F.lit(BLOCK_ROWS // 64 - 1))
    every = F.transform(numbers, lambda w: F.coalesce(F.try_element_at("held", w), F.lit(0).cast("bigint")))
    with row_filter(duplicates):
        blocks = write_shared(held.select("file", "block", every.alias("words")), "loser-blocks", narrow=True)
    if rows is not None:
        rows.drop()
    return blocks


def batches_of(gone: Written) -> int:
    """Batches of files whose bits can be broadcast each; files differ in size,
    so a batch is planned for half of the limit."""
    return max(1, -(-2 * gone.rows * BLOCK_BYTES // broadcast_limit(gone.frame.sparkSession)))


def without_losers(df: DataFrame, gone: Written) -> DataFrame:
    """The rows of ``df`` that are not among the :func:`losers`.

    The bits are broadcast, so that whole rows stay where they are read. Where
    they are too many for that, files are dealt to batches, and each scan reads
    the files of its batch and gets their bits alone.
    """
    batches = batches_of(gone)
    row = F.col("_metadata.row_index")
    kept = None
    for batch in range(batches):
        rows, bits = df, gone.frame
        if batches > 1:
            rows = rows.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(batches)) == batch)
            bits = bits.where(F.pmod(F.xxhash64("file"), F.lit(batches)) == batch)
        bits = F.broadcast(bits.select(F.struct("*").alias("_bits")))
        here = (F.col("_file") == F.col("_bits.file")) & (F.floor(F.col("_row") / BLOCK_ROWS).cast("bigint") == F.col("_bits.block"))
        rows = rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": row}).join(bits, here, "left")
        word = F.expr(f"_bits.words[CAST(shiftright(_row & {BLOCK_ROWS - 1}, 6) AS INT)]")
        bit = F.expr("shiftleft(1L, CAST(_row & 63 AS INT))")
        rows = rows.where(F.col("_bits").isNull() | (word.bitwiseAND(bit) == 0)).select(*map(named, df.columns))
        kept = rows if kept is None else kept.unionByName(rows)
    return kept


def dedup_by_place(df: DataFrame, rows: DataFrame, keys: list[str], order_by: Sequence[str], duplicates: Written) -> DataFrame | None:
    """The ``rows`` of ``df`` that are the first of their key, found by file and
    position, or nothing where rows have no place or the bits are too many."""
    if not order_by or broadcast_limit(df.sparkSession) <= 0 or not has_places(df):
        return None
    gone = losers(df, keys, order_by, duplicates)
    if batches_of(gone) > MOST_BATCHES:
        gone.drop()
        return None
    return without_losers(rows, gone)


def dedup(
    df: DataFrame,
    keys: Keys,
    order_by: Sequence[str],
    duplicates: Written | None = None,
) -> DataFrame:
    """Keep the first copy of each key in ``order_by`` and every other row.

    Put the day first in ``order_by`` and enough columns after it to make the
    choice certain. While the duplicated keys are small enough to broadcast,
    only their rows are shuffled. Beyond that the rows to drop are found by keys
    and order alone and named by file and position, so that whole rows are not
    shuffled; where rows have no such place, one aggregate shuffles the table.
    """
    keys = as_list(keys)
    duplicates = duplicates or find_duplicates(df, keys)
    if not duplicates.fits_broadcast():
        placed = dedup_by_place(df, df, keys, order_by, duplicates)
        if placed is not None:
            return placed
        kept = survivors(df.where(none_null(keys)), keys, order_by)
        return kept.unionByName(df.where(any_null(keys)))
    single = df.join(duplicates.for_join(), keys, "left_anti")
    repeated = df.join(duplicates.for_join(), keys, "left_semi")
    first = survivors(repeated, keys, order_by)
    return single.select(*map(named, df.columns)).unionByName(first)
