import pytest
from hypothesis import given, settings, strategies as st

from gapmend.llm import substring_dedup as passages
from gapmend.llm.decontaminate import contamination
from gapmend.llm.substring_dedup import Automaton, substring_dedup
from tests.llm.cases import (
    ODD_TEXTS, PASSAGE, as_counter, contaminated, documents, odd_documents, repeated_words, unspaced,
)


def kept(df):
    return as_counter(substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept").collect())


def brute(df):
    rows = df.select("doc_id", "text").collect()
    return as_counter((r.doc_id, *x) for r, x in zip(rows, repeated_words([r.text for r in rows], 35)))


@pytest.mark.parametrize("limit", [0, 50_000])
def test_odd_documents(spark, monkeypatch, limit):
    """By counting windows alone and by automata."""
    monkeypatch.setattr(passages, "AUTOMATON_WORDS", limit)
    df = odd_documents(spark)
    assert kept(df) == brute(df)


@pytest.mark.parametrize("limit", [0, 2_000, 50_000])
def test_passage_in_many_places(spark, monkeypatch, limit):
    monkeypatch.setattr(passages, "AUTOMATON_WORDS", limit)
    texts = [" ".join(f"l{i}.{j}" for j in range(i % 40)) + f" {PASSAGE} " + f"r{i} " * (i % 3) for i in range(300)]
    df = documents(spark, texts + ["only here " + " ".join(f"u{i}" for i in range(80))], extra=False)
    assert kept(df) == brute(df)


def test_empty_table(spark):
    assert kept(documents(spark, [])) == {}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 90), st.sampled_from(["", "x ", "y y "])), max_size=14))
def test_against_brute_force(spark, cuts):
    source = [f"t{i % 45}" for i in range(140)]
    df = documents(spark, [mark + " ".join(source[a : a + n]) for a, n, mark in cuts] or [""], extra=False)
    assert kept(df) == brute(df)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=6), st.integers(1, 4))
def test_automaton_counts(sequences, size):
    automaton = Automaton()
    for s in sequences:
        automaton.add(s, 1)
    automaton.sum_up()
    windows = [tuple(s[a : a + size]) for s in sequences for a in range(len(s) - size + 1)]
    for s in sequences:
        want = [a for a in range(len(s) - size + 1) if windows.count(tuple(s[a : a + size])) > 1]
        assert automaton.repeated(s, size) == want


ITEMS = [
    (1, " ".join(f"pass{i}" for i in range(5, 30))),
    (2, " ".join(f"Pass{i}" for i in range(20, 33))),
    (3, "two, three"),
    (4, "ONE"),
    (4, "ONE"),
    (10, ""),
    (11, None),
    (None, "three"),
    (12, " ".join(f"w{i}x{i}" for i in range(100, 160))),
    (13, "日本"),
]


def judged(df, items):
    out = contamination(df, items).collect()
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) and r.n_items == len(r.item_ids) for r in out)
    return as_counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in out)


def brute_items(df, items):
    rows = df.select("doc_id", "text").collect()
    return as_counter((r.doc_id, a, b, tuple(c)) for r, (a, b, c) in zip(rows, contaminated([r.text for r in rows], items)))


def test_items_in_odd_documents(spark):
    df = odd_documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "1 AS hash", "2 AS span", "3 AS row")
    found = judged(df, items)
    assert found == brute_items(df, ITEMS)
    assert any(n for _, _, n, _ in found)


def test_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    df = odd_documents(spark)
    assert judged(df, none) == brute_items(df, [])
    assert judged(documents(spark, []), spark.createDataFrame(ITEMS, none.schema)) == {}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 40)), min_size=1, max_size=8), st.integers(1, 20))
def test_every_long_shared_span_is_found(spark, cuts, n):
    source = [f"s{i % 23}" for i in range(80)]
    items = [(1, " ".join(source[3 : 3 + n])), (2, " ".join(source[10:45]))]
    df = documents(spark, ["zz " + " ".join(source[a : a + k]) + " yy" for a, k in cuts], extra=False)
    assert judged(df, spark.createDataFrame(items, "item_id bigint, text string")) == brute_items(df, items)


def test_words_as_the_pattern_says():
    assert unspaced(ODD_TEXTS[2]) == []


def test_words_that_a_power_of_two_takes_for_equal(spark):
    """The Thue-Morse word of 1,024 letters and its complement."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    head = " ".join(["same"] * 17)
    tail = " ".join(["else"] * 17)
    df = documents(spark, [f"{head} {word} {tail}", f"{head} {other} {tail}"])
    assert [r.n_removed for r in substring_dedup(df, 35).collect()] == [0, 0]
