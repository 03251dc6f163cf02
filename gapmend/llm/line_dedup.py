"""Remove repeated runs of lines by a suffix array over the lines of a corpus.

A document is a sequence of line ids, 128-bit hashes of its lines that are not
blank. The suffixes of all sequences are sorted by prefix doubling: by their
first line, then by the ranks of the first and second half of 2, 4, 8 ... lines.
A step sorts by range partitioning. Each partition ranks its own rows, and one
row of summary for each partition tells where a group goes on in the next.

Suffixes of equal rank after a step are an interval of the suffix array whose
longest common prefix has at least so many lines. The first of them in the
corpus is kept, the others are later copies. A suffix that shares its rank with
no other leaves the work, so the steps shrink and end with the longest repeated
run. Each later copy covers the lines of its deepest interval; together these
are a document's maximal repeated runs, and they are deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapmend.functions.columns import named
from gapmend.llm.texts import text_key
from gapmend.shared import Written, scratch_tables, write_shared

# Groups are named by partition and row; a partition has fewer rows than this.
ROWS = 1 << 40
DOCUMENT = ["doc_id", "text_key"]
PLACE = [*DOCUMENT, "line"]


def is_blank(line: Column) -> Column:
    return ~F.rlike(line, F.lit(r"\S"))


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line (its number, without blank lines) and the id, a and b.

    Rows that agree in doc_id and text are one document.
    """
    lines = F.filter(F.split("text", "\n", -1), lambda x: ~is_blank(x))
    ids = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))
    each = docs.select(*DOCUMENT, F.posexplode(ids).alias("line", "id"))
    return each.select(*PLACE, F.col("id.a").alias("a"), F.col("id.b").alias("b")).dropDuplicates()


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not unique: their place, rank and whether a row of
    equal keys stands earlier in the corpus. Ranks are ordered as the keys.

    The result reads a table in the shared folder.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys, *PLACE).withColumn("part", F.spark_partition_id())
    by_key = Window.partitionBy("part").orderBy(*keys)
    group = Window.partitionBy("part", *keys)
    dealt = write_shared(
        dealt.select(
            *PLACE, *keys, "part", F.rank().over(by_key).cast("bigint").alias("row"),
            (F.row_number().over(group.orderBy(*PLACE)) > 1).alias("later"),
            (F.count(F.lit(1)).over(group) > 1).alias("shared"),
        ),
        "suffixes",
    ).frame
    key = F.struct(*keys)
    ends = dealt.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.max("row").alias("row"))
    # One row for each partition.
    summary, names, last, name = ends.orderBy("part").collect(), [], None, None
    for i, end in enumerate(summary):
        goes_on = i > 0 and end["first"] == last
        carried = name if goes_on else None
        if not (goes_on and end["row"] == 1):
            name = end["part"] * ROWS + end["row"]
        last = end["last"]
        continued = i + 1 < len(summary) and summary[i + 1]["first"] == last
        names.append((end["part"], carried, end["row"] if continued else None))
    edges = spark.createDataFrame(names, "part int, carried bigint, continued bigint")
    rows = dealt.join(F.broadcast(edges), "part")
    inherits = (F.col("row") == 1) & F.col("carried").isNotNull()
    goes_on = F.coalesce(F.col("row") == F.col("continued"), F.lit(False))
    return rows.filter(F.col("shared") | inherits | goes_on).select(
        *PLACE,
        F.when(inherits, F.col("carried")).otherwise(F.col("part") * F.lit(ROWS) + F.col("row")).alias("rank"),
        (F.col("later") | inherits).alias("later"),
    )


def repeated_prefixes(lines: DataFrame) -> list[Written]:
    """For 1, 2, 4 ... lines the suffixes that share as many with another."""
    levels = [_written_ranks(lines, ["a", "b"])]
    while levels[-1].rows:
        half = 1 << (len(levels) - 1)
        ahead = Window.partitionBy(*DOCUMENT).orderBy("line").rangeBetween(half, half)
        both = levels[-1].frame.select(*PLACE, "rank", F.first("rank").over(ahead).alias("second"))
        levels.append(_written_ranks(both.filter("second is not null"), ["rank", "second"]))
    return levels[:-1]


def _written_ranks(rows: DataFrame, keys: list[str]) -> Written:
    """:func:`ranked` rows as a table, without the one they are made from."""
    with scratch_tables(rows.sparkSession) as keep:
        level = write_shared(ranked(rows, keys), "suffix-ranks")
        keep(level.path)
    return level


def later_copies(lines: DataFrame, levels: list[Written], min_lines: int) -> DataFrame:
    """doc_id, text_key, start and end (in lines) of the runs to delete."""
    deep = [
        level.frame.filter("later").select(*PLACE, (F.col("line") + (1 << k)).alias("end"))
        for k, level in enumerate(levels) if 1 << k >= min_lines
    ]
    if not deep:
        return lines.select(*DOCUMENT, F.col("line").alias("start"), F.col("line").alias("end")).limit(0)
    copies = reduce(DataFrame.unionByName, deep).groupBy(*PLACE).agg(F.max("end").alias("end"))
    order = Window.partitionBy(*DOCUMENT).orderBy("line")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.coalesce(reach, F.lit(-1)) < F.col("line")).cast("int")
    runs = copies.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    return runs.groupBy(*DOCUMENT, "run").agg(F.min("line").alias("start"), F.max("end").alias("end")).drop("run")


def line_dedup(
    docs: DataFrame, min_lines: int = 2, text: str = "text", doc_id: str = "doc_id", keep: Sequence[str] = (),
    long_lines: int | None = None,
) -> DataFrame:
    """Delete later copies of runs of ``min_lines`` or more lines.

    A run is consecutive lines, blank ones left out, that also stand earlier:
    in a document of smaller doc_id (of equal ids, smaller hash of the text), or
    further up in the same one. ``min_lines`` is a power of two. Returns a row
    for each row of ``docs``: doc_id, text_key, n_lines (not blank), n_removed,
    n_runs, longest_run (in lines), text, its other lines in their order, and
    others, a struct of the columns that ``keep`` names, if any. With ``long_lines``,
    a greater power of two, n_long_removed, n_long_runs, longest_long_run and
    long_text say the same of runs of so many lines alone.

    Blank lines are never deleted. A text that loses nothing is unchanged, and
    null stays null with no lines. Rows that agree in doc_id and text are one
    document, and each returns the same; a null doc_id comes first. An empty
    table gives no rows; other columns are not looked at. The result reads the
    table of runs, which stays in the shared folder; the tables of the steps go.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines is a power of two")
    if long_lines is not None and (long_lines <= min_lines or long_lines & (long_lines - 1)):
        raise ValueError("long_lines is a power of two greater than min_lines")
    others = F.struct(*map(named, keep)).alias("others") if keep else F.lit(None).alias("others")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"), others)
    with scratch_tables(docs.sparkSession) as keep_table:
        lines = write_shared(line_table(rows), "lines")
        levels = repeated_prefixes(lines.frame)
        asked = {"runs": min_lines} | ({"long_runs": long_lines} if long_lines else {})
        found = [later_copies(lines.frame, levels, m).withColumn("of", F.lit(name)) for name, m in asked.items()]
        run = F.struct("start", "end")
        runs = reduce(DataFrame.unionByName, found).groupBy(*DOCUMENT).agg(
            *[F.sort_array(F.collect_list(F.when(F.col("of") == name, run))).alias(name) for name in asked]
        )
        runs = write_shared(runs, "line-runs")
        keep_table(runs.path)
    # A shuffled join at any size, and one that does not sort the texts.
    runs = runs.frame.withColumnsRenamed({"doc_id": "d", "text_key": "k"}).hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    found = rows.join(runs, same, "left").withColumn("lines", F.split("text", "\n", -1))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    full = F.filter(numbers, lambda i: ~is_blank(F.col("lines")[i]))
    found = found.withColumn("full", F.coalesce(F.when(F.col("text").isNotNull(), full), F.array().cast("array<int>")))

    def without(name: str) -> list[Column]:
        """Lines of the runs, their number, the longest, and the text without them."""
        runs = F.col(name)
        gone = F.flatten(F.transform(runs, lambda r: F.slice("full", r["start"] + 1, r["end"] - r["start"])))
        kept = F.transform(F.array_except(numbers, gone), lambda i: F.col("lines")[i])
        sizes = F.coalesce(F.transform(runs, lambda r: r["end"] - r["start"]), F.array().cast("array<int>"))
        return [
            F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b),
            F.size(sizes).cast("bigint"),
            F.coalesce(F.array_max(sizes), F.lit(0)).cast("bigint"),
            F.when(F.coalesce(F.size(runs), F.lit(0)) <= 0, F.col("text")).otherwise(F.array_join(kept, "\n")),
        ]

    names = ["n_removed", "n_runs", "longest_run", "text"]
    long_names = ["n_long_removed", "n_long_runs", "longest_long_run", "long_text"]
    return found.select(
        *DOCUMENT, F.size("full").cast("bigint").alias("n_lines"),
        *[c.alias(n) for c, n in zip(without("runs"), names)],
        *([c.alias(n) for c, n in zip(without("long_runs"), long_names)] if long_lines else []),
        *([F.col("others")] if keep else []),
    )
