import numpy as np
import pytest
from pyspark.sql import functions as F

from gapmend.llm.components import components
from gapmend.llm.sharding import KEY_DIGITS, Cutter, minimax_shards
from gapmend.llm.simhash import block_masks, forest, near_duplicates, near_links
from tests.llm.cases import as_counter, documents, linked, odd_documents, simhash


def as_long(x):
    return x - 2**64 if x >= 2**63 else x


def test_odd_documents(spark):
    df = odd_documents(spark)
    rows = df.select("doc_id", "text").collect()
    prints = [simhash(r.text) for r in rows]
    parts = linked(prints, 4)
    best = {}
    for r, p in zip(rows, parts):
        if r.doc_id is not None:
            best[p] = min(best.get(p, r.doc_id), r.doc_id)
    out = near_duplicates(df).collect()
    assert as_counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == as_counter(
        (r.doc_id, as_long(x), best.get(p)) for r, x, p in zip(rows, prints, parts)
    )
    part = dict(zip(map(as_long, prints), parts))
    leaders = {(part[r.fingerprint], r.doc_id, r.text_key) for r in out if r.leader}
    assert sorted(p for p, _, _ in leaders) == sorted(set(parts))


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("tile", [8, 4096])
def test_links_join_what_all_pairs_join(spark, tile):
    """Also where buckets are cut into tiles of one population count."""
    random = np.random.default_rng(5)
    centres = random.integers(0, 2**63, 30, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for c in centres[:10]:
        for _ in range(40):
            flips = random.choice(64, random.integers(1, 5), replace=False)
            prints.add(int(c) ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    df = spark.createDataFrame([(as_long(p),) for p in prints], "fingerprint bigint")
    found = dict(map(tuple, components(near_links(df, 4, tile)).collect()))
    want = linked(prints, 4)
    groups = {}
    for p, c in zip(prints, want):
        groups.setdefault(c, set()).add(as_long(p))
    got = {}
    for node, root in found.items():
        got.setdefault(root, set()).add(node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)
    assert all(root == min(g) for root, g in got.items())


def test_pairs_within_the_radius_share_two_blocks():
    masks = block_masks(4)
    assert len(masks) == 15
    random = np.random.default_rng(1)
    for _ in range(200):
        flips = sum(1 << int(b) for b in random.choice(64, 4, replace=False))
        assert any(flips & m == 0 for m in masks)


def test_forest_between_two_tiles():
    left, right = np.array([0, 0xFF00], np.uint64), np.array([1, 0xFF01, 1 << 40 | 0xFFFF0000], np.uint64)
    centres, members = forest(left, right, 4)
    assert set(zip(centres.tolist(), members.tolist())) == {(0, 1), (0xFF00, 0xFF01)}


def test_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    found = dict(map(tuple, components(df).collect()))
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


def brute_capacity(sizes, shards):
    def needs(capacity):
        n, filled = 1, 0
        for s in sizes:
            if s > capacity:
                return 10**9
            n, filled = (n, filled + s) if filled + s <= capacity else (n + 1, s)
        return n

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needs(middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_cuts_are_minimax(shards):
    random = np.random.default_rng(3)
    for n in (0, 1, 5, 30, 400):
        for top in (10, 10_000):
            sizes = random.integers(8, 8 + top, n).tolist()
            if n == 30:
                sizes[7] = 5 * sum(sizes)
            cutter = Cutter(sizes, shards)
            cuts = [0, *cutter.cuts(), n]
            parts = [sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])]
            assert len(parts) == shards and sum(parts) == sum(sizes) and cuts == sorted(cuts)
            assert max(parts) == brute_capacity(sizes, shards)


def dealt(df, shards):
    rows = minimax_shards(df, shards).collect()
    by_shard, by_key = {}, {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
        by_key.setdefault(r.key, set()).add(r.shard)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by_shard.values())
    assert all(len(v) == 1 for v in by_key.values()) and set(by_shard) <= set(range(shards))
    order = sorted((r.key, r.shard) for r in rows)
    assert [s for _, s in order] == sorted(s for _, s in order)
    return rows, {s: sum(r["size"] for r in v) for s, v in by_shard.items()}


def test_shards_of_odd_documents(spark):
    import zlib

    df = odd_documents(spark)
    rows, _ = dealt(df, 5)
    texts = df.select("doc_id", "text").collect()
    assert as_counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == as_counter(
        (r.doc_id, 8 + len((r.text or "").encode()), zlib.crc32((r.text or "").encode())) for r in texts
    )


def test_shards_of_a_table_are_minimax(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # A third of the rows under one text.
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("hot " * 99)).otherwise(F.col("text")))
    rows, sizes = dealt(docs, 24)
    groups = {}
    for r in rows:
        groups[r.key] = groups.get(r.key, 0) + r["size"]
    assert max(groups) < 16**KEY_DIGITS
    assert max(sizes.values()) == brute_capacity([groups[k] for k in sorted(groups)], 24)
    assert len(sizes) == 24


def test_no_documents_no_shards(spark):
    assert dealt(documents(spark, []), 24)[0] == []
