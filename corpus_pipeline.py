"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapmend.llm.decontaminate import contamination
from gapmend.llm.line_dedup import line_dedup
from gapmend.llm.packing import pack
from gapmend.llm.queries import VOCABULARY, languages, table
from gapmend.llm.simhash import near_duplicates
from gapmend.llm.texts import text_key
from gapmend.shared import Written, delete_path, fresh_path, scratch_tables, write_shared


def _dropped(judged: DataFrame, label: str) -> Written:
    """The documents that go, by id and text."""
    return write_shared(judged.select("doc_id", "text_key").distinct(), label)


def _without(docs: DataFrame, dropped: Written) -> DataFrame:
    """Documents that are not named; broadcast where the names are few by
    measure, so that texts stay where they are."""
    names = dropped.for_join().withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("d")) & (text_key(F.col("row.text")) == F.col("k"))
    return rows.join(names, same, "left_anti").select("row.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not known."""
    return _without(docs, _dropped(languages(spark, docs, sf_dir).filter("not accepted"), "no-language"))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop later copies of lines, alone or in runs; all documents stay."""
    keep = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    columns = [own.get(c, F.col("others").getField(c)) for c in docs.columns]
    return line_dedup(docs, 1, keep=keep).select(*[x.alias(c) for x, c in zip(columns, docs.columns)])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    groups = write_shared(near_duplicates(docs), "near-duplicates").frame
    kept = _without(docs, _dropped(groups.filter("not leader"), "near-copies"))
    # Rows that agree in id and text lead together; one of them stays.
    twice = groups.filter("leader").groupBy("doc_id", "text_key").count().filter("count > 1")
    twice = _dropped(twice, "repeated-rows")
    if not twice.rows:
        return kept
    names = twice.frame.withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    rows = kept.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), text_key("text").alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("d")) & (F.col("own_key") == F.col("k"))
    single = rows.join(names, same).groupBy("d", "k").agg(F.min("row").alias("row")).select("row.*")
    return _without(kept, twice).unionByName(single)


def not_in_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold too much of benchmark items."""
    judged = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, _dropped(judged.filter("contaminated"), "contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return pack(docs, VOCABULARY).drop("text_key")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", new_lines),
    ("near_dedup", one_of_each),
    ("decontamination", not_in_benchmarks),
    ("packing", packed),
]

# SQL cannot tokenise, so tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents of ``sf_dir`` end up in.

    Their table is all that stays in the shared folder: what a stage writes on
    its way goes with it, and its rows go once those of the next are written.
    """
    rows, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with scratch_tables(spark):
            stage(spark, rows, sf_dir).write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        rows, before = spark.read.parquet(path), path
    return rows
