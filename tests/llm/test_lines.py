import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gapmend.llm.line_dedup import line_dedup, line_table, ranked, repeated_prefixes
from gapmend.llm.texts import text_key
from gapmend.shared import folder_names, session_conf, shared_dir
from tests.llm.cases import documents, later_lines, odd_documents


def keyed(df):
    return [tuple(r) for r in df.select("doc_id", "text", text_key("text")).collect()]


def found(df, **options):
    out = line_dedup(df, **options)
    return out, {(r.doc_id, r.text_key): (r.n_lines, r.n_removed, r.text) for r in out.collect()}


def wanted(df, m):
    return {(i, k): v for (i, _, k), v in later_lines(keyed(df), m).items()}


@pytest.mark.parametrize("m", [1, 2, 4])
def test_odd_documents(spark, m):
    df = odd_documents(spark)
    out, got = found(df, min_lines=m, keep=["lang", "clash ing"])
    assert got == wanted(df, m)
    assert out.count() == df.count() and out.select("others.*").columns == ["lang", "clash ing"]


def test_empty_table(spark):
    assert found(documents(spark, []))[1] == {}


def test_only_powers_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        line_dedup(documents(spark, []), min_lines=3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=12), st.sampled_from([1, 2, 4]))
def test_runs_against_brute_force(spark, lines, m):
    df = documents(spark, ["\n".join(x) for x in lines] or [""], extra=False)
    assert found(df, min_lines=m)[1] == wanted(df, m)


def test_ranks_are_those_of_sorted_suffixes(spark):
    """Over many partitions, with a group that goes on over several of them."""
    texts = ["\n".join("abcabxcabc"[i % 7 :]) for i in range(40)] + ["\n".join("aaaaaaaa")] * 3
    rows = documents(spark, texts, extra=False).select("doc_id", text_key("text").alias("text_key"), "text")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "13"}):
        lines = line_table(rows).cache()
        ids = {(r.doc_id, r.line): (r.a, r.b) for r in lines.collect()}
        levels = repeated_prefixes(lines)
    assert len(levels) == 4
    for k, level in enumerate(levels):
        width = 1 << k
        windows = {}
        for doc, line in ids:
            if (doc, line + width - 1) in ids:
                key = tuple(ids[doc, line + i] for i in range(width))
                windows.setdefault(key, []).append((doc, line))
        shared = {key: sorted(v) for key, v in windows.items() if len(v) > 1}
        got = {}
        for r in level.frame.collect():
            got.setdefault(r["rank"], []).append((r.doc_id, r.line, r.later))
        assert [sorted(got[n])[0][:2] for n in sorted(got)] == [shared[key][0] for key in sorted(shared)]
        assert all([x[:2] for x in sorted(v)] == shared[key] for (_, v), key in zip(sorted(got.items()), sorted(shared)))
        assert all([x[2] for x in sorted(v)] == [False] + [True] * (len(v) - 1) for v in got.values())


def test_hot_line_is_split(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("text_key"), F.lit(0).alias("line"),
        F.lit(5).cast("bigint").alias("a"), F.lit(6).cast("bigint").alias("b"),
    )
    out = ranked(rows, ["a", "b"])
    assert out.select("rank").distinct().count() == 1
    assert out.filter("not later").collect()[0].doc_id == 0 and out.filter("later").count() == 4999


def test_no_line_comes_twice(spark):
    """With runs of one line no line that is not blank is left a second time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = [x for r in line_dedup(docs, 1).collect() for x in (r.text or "").split("\n") if x.strip()]
    assert len(lines) == len(set(lines)) > 0


def test_only_the_runs_stay(spark):
    """The tables of the steps are gone when the result is handed out."""
    docs = documents(spark, ["a\nb\nc", "x\na\nb\nc", "a\nb"])
    before = set(folder_names(spark, f"{shared_dir(spark)}/gapmend"))
    out = line_dedup(docs, 1)
    left = set(folder_names(spark, f"{shared_dir(spark)}/gapmend")) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["line-runs"]
    assert sorted(r.n_removed for r in out.collect()) == [0, 2, 3]


def test_long_runs_are_told_apart(spark):
    """Single lines go, and runs of two are still found as runs."""
    df = documents(spark, ["a\nb\nc", "a\nx\nb\nc\nc", "c\n\na\nb", "y", None, ""], extra=False)
    rows = line_dedup(df, 1, long_lines=2).collect()
    for m, names in ((1, ("n_removed", "text")), (2, ("n_long_removed", "long_text"))):
        assert {(r.doc_id, r.text_key): (r.n_lines, *(r[n] for n in names)) for r in rows} == wanted(df, m)
    assert sorted((r.n_runs, r.longest_run, r.n_long_runs, r.longest_long_run) for r in rows if r.n_runs) == [
        (1, 3, 1, 2), (2, 3, 1, 2)
    ]
    with pytest.raises(ValueError, match="greater than min_lines"):
        line_dedup(df, 2, long_lines=2)
