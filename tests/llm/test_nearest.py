import numpy as np
import pytest
from pyspark.sql import functions as F

from gapmend.llm import nearest as module
from gapmend.llm.nearest import cosine, fit, nearest, unit


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    vectors = unit(np.array([v for _, v in rows], float))
    out = {}
    for name, v in queries:
        scores = vectors @ unit(np.array([v], float))[0]
        order = [i for i in np.lexsort((ids, -np.round(scores, 12))) if ids[i] != name][:k]
        out[name] = [(int(ids[i]), scores[i]) for i in order]
    return out


def found(df, queries, **options):
    out = {}
    for r in nearest(df, queries, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block", [16, 1024])
def test_recall_on_a_table(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = df.filter("vec_id % 50 = 0")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [(r.vec_id, r.embedding) for r in queries.collect()], 5)
    got = found(df, queries)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact = {i: v for i, v in rows}
    for q, pairs in got.items():
        a = np.array(exact[q], float)
        for i, score in pairs:
            b = np.array(exact[i], float)
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0]),
        (6, [-1.0, 0.0]), (7, [3e38, 3e38]), (8, [1e-38, 0.0]), (20, None), (21, []), (22, [0.0, 0.0]), (23, [nan, 1.0]),
        (24, [inf, 1.0]), (25, [None, 1.0]), (26, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    df = df.selectExpr("*", "1 AS id", "2 AS leaf", "3 AS n", "4 AS score", "5 AS block")
    good = [(i, v) for i, v in dict((i, v) for i, v in rows if i and i < 20).items()]
    want = brute(good, good, 4)
    got = found(df, df, k=4, recall=1.0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(np.isclose(a[1], b[1]) for q in want for a, b in zip(got[q], want[q]))
    assert [i for i, _ in got[1]] == [2, 3, 4, 8]


def test_without_vectors_or_queries(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert found(df, df.limit(0)) == {} == found(df.limit(0), df)
    assert found(df, df) == {}
    assert nearest(df.limit(0), df).columns == nearest(df, df).columns


def test_common_vector(spark):
    """A third of the rows under one vector; ties go to the smallest ids."""
    random = np.random.default_rng(3)
    rows = [(i, [0.5] * 8 if i % 3 == 0 else random.normal(size=8).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = found(df, df.filter("vec_id IN (0, 6, 300)"))
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15]
    assert [i for i, _ in got[6]] == [0, 3, 9, 12, 15]
    assert [i for i, _ in got[300]] == [0, 3, 6, 9, 12]


def test_tree_holds_every_leaf_once():
    random = np.random.default_rng(0)
    vectors = unit(random.normal(size=(3000, 6)))
    tree = fit(vectors)
    leaf = tree.assign(vectors)
    assert set(leaf.tolist()) <= set(range(tree.leaves)) and tree.leaves > 20
    near = tree.centres @ vectors[0]
    order = tree.order(near, tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and order[0] == leaf[0]


def test_equal_vectors_have_equal_scores():
    random = np.random.default_rng(9)
    a, b = random.normal(size=(50, 64)), random.normal(size=(1, 64))
    one = [cosine(a[i : i + 1], b)[0] for i in range(50)]
    assert cosine(a, np.repeat(b, 50, axis=0)).tolist() == one
    assert fit(np.zeros((0, 4))).leaves == 1
    assert F.lit(1) is not None
