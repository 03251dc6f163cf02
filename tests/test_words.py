"""Keys of different types, and whole numbers compared in words of 64."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from gapmend.operators import coverage, gaps, missing_keys
from tests.tables import ids

TYPES = ["string", "bigint", "int", "decimal(12,0)", "decimal(12,2)", "double", "float", "date"]


def typed(spark, values, kind):
    text = [None if v is None else f"2024-01-{v:02}" if kind == "date" else str(v) for v in values]
    return ids(spark, text, "id string").selectExpr(f"CAST(id AS {kind}) AS id")


@pytest.mark.parametrize("one, two", [(a, b) for a in TYPES for b in TYPES if (a == "date") == (b == "date") or "string" in (a, b)])
def test_a_narrowed_target_gives_the_same_answer(spark, monkeypatch, one, two):
    """Numbers whose order as text is another: 9 and 10, 2 and 30."""
    dates = "date" in (one, two)
    source = typed(spark, [2, 9, 10, 11, 21, 30, None], "date" if dates and one == "string" else one)
    target = typed(spark, [2, 9, 9, 10, 21, 30, 31, None], "date" if dates and two == "string" else two)
    if dates:
        source, target = (df.selectExpr(f"CAST(id AS {kind}) AS id") for df, kind in ((source, one), (target, two)))
    found = []
    for limit in (0, 10**12):
        monkeypatch.setattr(gaps, "NARROW_FROM", limit)
        missing = missing_keys(source, target, "id").collect()
        found.append(([str(r[0]) for r in missing], [r[1] for r in missing], coverage(source, target, "id").first()))
    assert found[0] == found[1]
    assert found[0][1] == [1] and "11" in found[0][0][0]
    assert (found[0][2].matched_rows, found[0][2].missing_rows, found[0][2].null_keys) == (6, 1, 1)


EDGES = [-(2**63), -(2**63) + 1, -65, -64, -63, -1, 0, 1, 62, 63, 64, 127, 2**40, 2**63 - 64, 2**63 - 1]
KEYS = st.lists(st.one_of(st.none(), st.sampled_from(EDGES), st.integers(-5, 200)), max_size=25)


def by_hand(source, target):
    s, t = Counter(x for x in source if x is not None), Counter(x for x in target if x is not None)
    missing = sorted(k for k in s if k not in t)
    return (
        len(source), sum(n * t[k] for k, n in s.items()), sum(s[k] for k in missing), len(missing),
        sum(t[k] > 1 for k in s), source.count(None), missing[0] if missing else None, missing[-1] if missing else None,
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS)
def test_words_hold_every_whole_number(spark, source, target):
    left, right = ids(spark, source), ids(spark, target)
    row = coverage(left, right, "id", dense=True).first()
    assert tuple(row)[:-1] == by_hand(source, target)
    assert row == coverage(left, right, "id").first()
    counts = Counter(x for x in source if x is not None and x not in target)
    assert {r.id: r.source_rows for r in missing_keys(left, right, "id").collect()} == counts


def test_words_of_mixed_sizes(spark):
    left, right = ids(spark, [1, 5, 5, 300], "id int"), ids(spark, [5, 2**40])
    assert sorted(map(tuple, missing_keys(left, right, "id").collect())) == [(1, 1), (300, 1)]
    row = coverage(left, right, "id", dense=True).first()
    assert (row.missing_keys, row.min_missing, row.max_missing, row.status) == (2, 1, 300, "missing")


def test_words_are_for_one_whole_number(spark):
    with pytest.raises(ValueError):
        coverage(ids(spark, ["a"], "id string"), ids(spark, ["a"], "id string"), "id", dense=True)


def test_dense_targets_shuffle_words(spark):
    """A row for each 64 target keys, and no exchange of the keys themselves."""
    from tests.test_plans import shuffled_rows

    source, target = spark.range(0, 64_000).where("id % 7 <> 1"), spark.range(0, 64_000).where("id % 10 <> 0")
    target = target.unionByName(target)
    sent = shuffled_rows(spark, missing_keys(source, target, "id"))
    assert min(n for n in sent if n) <= 8 * 1_001
