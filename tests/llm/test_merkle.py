import hashlib

import pytest
from pyspark.sql import functions as F

from gapmend.llm.merkle import descend, fold, height, merkle_manifest, parent_of, records_of, steps_up
from tests.llm.cases import CLASHING, as_counter, documents, odd_documents

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([hashed("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def beside(levels, i):
    for level in levels[:-1]:
        begin = i // 3 * 3
        run = level[begin : begin + 3]
        yield i - begin, run[: i - begin] + run[i - begin + 1 :]
        i //= 3


def manifest(rows, changed):
    """By the definition, from rows of COLUMNS."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        trees[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    levels = {s: levels_of([leaf_of(r) for r in trees[s]]) for s in order}
    top = levels_of([levels[s][-1][0] for s in order])
    root = top[-1][0] if order else None
    out = []
    for place, source in enumerate(order):
        for i, row in enumerate(trees[source]):
            steps = [*beside(levels[source], i), *beside(top, place)]
            node = leaf_of(changed(row))
            for digit, others in steps:
                node = hashed("".join([*others[:digit], node, *others[digit:]]))
            proof = hashed("".join(x for _, others in steps for x in others))
            out.append((row[0], levels[source][0][i], levels[source][-1][0], root, proof, node, node == root))
    return out


def stripped(row):
    text = row[4].replace("\n", "") if row[4] is not None and (row[0] or 0) % 2 == 0 else row[4]
    return (*row[:4], text)


CHANGED = "CASE WHEN coalesce(doc_id, 0) % 2 = 0 THEN replace(text, '\n', '') ELSE text END"


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_odd_documents(spark, levels):
    """Null sources, ids and texts, repeated rows, sources of one row, and trees
    that take several blocks one above the other."""
    source = F.expr("CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'é' WHEN 2 THEN 'Z' ELSE '' END")
    source = F.when(F.col("doc_id") == 7, "alone").otherwise(source)
    df = odd_documents(spark).withColumn("source", source).withColumn("lang", F.nullif("lang", F.lit("en")))
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    out = merkle_manifest(df, check={"text": F.expr(CHANGED)}, levels=levels).collect()
    want = manifest(rows, stripped)
    assert as_counter(out) == as_counter(want)
    assert {True, False} == {r.verified for r in out}


def test_many_sources(spark):
    """More subroots than a block holds at its foot, a third of the rows equal."""
    df = documents(spark, [(i if i % 3 else 0, f"text {i % 3 and i}") for i in range(300)], extra=False)
    df = df.withColumn("source", F.when(F.col("doc_id") % 7 > 2, F.concat(F.lit("s"), "doc_id")))
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert as_counter(merkle_manifest(df, levels=2).collect()) == as_counter(manifest(rows, tuple))


def test_empty_and_single(spark):
    assert merkle_manifest(documents(spark, [])).count() == 0
    (row,) = merkle_manifest(documents(spark, ["only"])).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == hashed("")
    assert "text_key" in CLASHING


def test_descent_and_fold():
    for n in (1, 2, 3, 4, 9, 10, 80):
        leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        top, records = records_of(leaves, height(n))
        for i in range(n):
            node, path = descend(records, top, i, height(n))
            assert node == leaves[i] and fold(node, steps_up(path)) == top
            if n > 1:
                assert fold(parent_of([node]), steps_up(path)) != top
