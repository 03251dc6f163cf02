"""Near duplicates by SimHash fingerprints, compared exactly in tiles.

Only different fingerprints are compared, so copies cost one row. Two
fingerprints within the radius of each other agree in whole blocks of bits: cut
into two blocks more than the radius, they share at least two. Each pair of
blocks deals the fingerprints to buckets by those bits, and the comparison goes
tile by tile within buckets: exclusive-or and bit counts in numpy over all pairs
of a tile or of two tiles. Tiles of large buckets hold fingerprints of one
population count, and pairs of tiles whose counts differ by more than the
radius are left out. No link is lost by either rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gapmend.llm.components import components
from gapmend.llm.texts import LOWER, UNSPACED, chunks, schema_of, text_key, words_of, write_scanned
from gapmend.shared import write_shared

# Fingerprints in a tile; a pair of tiles is compared in blocks of this size.
TILE = 4096
ROWS_AT_ONCE = 256


def spaced(words) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each word begins."""
    sizes = words.ends - words.starts + 1
    begins = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(begins[-1]) + np.repeat(words.starts - begins[:-1], sizes)
    data = words.data[np.minimum(at, max(len(words.data) - 1, 0))]
    data[begins[1:] - 1] = 32
    return data, begins


def shingle_prints(words, size: int, seed: int) -> np.ndarray:
    """Fingerprints of texts: bits set in over half their shingles' XXH64."""
    data, begins = spaced(words)
    counts = words.counts()
    # A text of fewer words than a shingle is one shingle; one of none has none.
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    before = np.concatenate(([0], np.cumsum(shingles)))
    first = np.arange(before[-1]) + np.repeat(words.first[:-1] - before[:-1], shingles)
    last = np.minimum(first + size, np.repeat(words.first[1:], shingles))
    raw, digest = data.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], seed) for a, b in zip(begins[first].tolist(), (begins[last] - 1).tolist())),
        np.uint64,
        len(first),
    )
    prints = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        sums = np.add.reduceat(bits, before[some], axis=0, dtype=np.int32)
        most = 2 * sums > shingles[some][:, None]
        prints[some] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    return prints


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, text_key and fingerprint (64 bits as a long) of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    schema = schema_of(rows.select("doc_id", "text_key"), "fingerprint long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            found = shingle_prints(words_of(LOWER[data], bounds, UNSPACED), size, seed)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(found.view(np.int64))],
                ["doc_id", "text_key", "fingerprint"],
            )

    return rows.mapInArrow(score, schema)


def block_masks(radius: int) -> list[int]:
    """Masks of all pairs among ``radius + 2`` blocks of the 64 bits."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs within the radius join: a star for each
    connected part, as centres and members. Without ``right`` the pairs are
    those within ``left``, else those between the two."""
    same = right is None
    other = left if same else right
    near = np.empty((len(left), len(other)), bool)
    for a in range(0, len(left), ROWS_AT_ONCE):
        near[a : a + ROWS_AT_ONCE] = np.bitwise_count(left[a : a + ROWS_AT_ONCE, None] ^ other) <= radius
    if same:
        np.fill_diagonal(near, False)
    free_rows, free_columns = near.any(axis=1), near.any(axis=0)
    centres, members = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for i in np.flatnonzero(free_rows):
        if not free_rows[i]:
            continue
        rows = np.array([i])
        free_rows[i] = False
        if same:
            free_columns[i] = False
        while len(rows):
            columns = np.flatnonzero(near[rows].any(axis=0) & free_columns)
            free_columns[columns] = False
            members.append(other[columns])
            if same:
                rows = columns
            else:
                rows = np.flatnonzero(near[:, columns].any(axis=1) & free_rows)
                members.append(left[rows])
            free_rows[rows] = False
        centres.append(np.full(sum(map(len, members)) - sum(map(len, centres)), left[i]))
    return np.concatenate(centres), np.concatenate(members)


def near_links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Links u, v among the different values of ``fingerprint`` that join all
    that lie within ``radius`` bits of each other, directly or by others."""
    masks = block_masks(radius)
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m - 2**64 if m >= 2**63 else m)).alias("key"))
        for t, m in enumerate(masks)
    ])
    keyed = (
        prints.select("fingerprint", F.bit_count("fingerprint").alias("ones"), F.explode(tables).alias("k"))
        .select("fingerprint", "ones", "k.t", "k.key")
    )
    counts = keyed.groupBy("t", "key", "ones").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("t", "key").agg(
        F.sum("n").alias("n"),
        # At most 65 population counts.
        F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))).alias("tiles"),
    )
    shared = write_shared(sizes.filter("n > 1"), "simhash-buckets").frame
    # Small buckets are one tile; large ones have tiles of one population count.
    small = F.col("n") <= tile
    ones = F.when(small, F.lit(-1)).otherwise(F.col("ones"))
    part = F.when(small, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("fingerprint"), F.element_at("tiles", F.col("ones")).cast("bigint")).cast("int")
    )
    dealt = keyed.join(shared, ["t", "key"]).select("t", "key", ones.alias("ones"), part.alias("part"), "fingerprint")
    tiles = write_shared(
        dealt.groupBy("t", "key", "ones", "part").agg(F.collect_list("fingerprint").alias("left")), "simhash-tiles"
    ).frame
    within = tiles.select("left", F.lit(None).cast("array<bigint>").alias("right"))
    # Pairs of tiles of a large bucket: the counts of ones within the radius.
    partners = F.expr(
        f"flatten(transform(filter(map_keys(tiles), o -> o >= ones and o <= ones + {int(radius)}),"
        " o -> transform(sequence(0, tiles[o] - 1), p -> struct(o as ones2, p as part2))))"
    )
    large = shared.filter(F.col("n") > tile)
    pairs = (
        tiles.filter("ones >= 0").join(large, ["t", "key"])
        .select("t", "key", "ones", "part", "left", F.explode(partners).alias("p"))
        .select("t", "key", "ones", "part", "left", "p.ones2", "p.part2")
        .filter("ones2 > ones or part2 > part")
    )
    others = tiles.filter("ones >= 0").select(
        "t", "key", F.col("ones").alias("ones2"), F.col("part").alias("part2"), F.col("left").alias("right")
    )
    between = pairs.join(others, ["t", "key", "ones2", "part2"]).select("left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                right = right.values.to_numpy().view(np.uint64) if right.is_valid else None
                found.append(forest(left.values.to_numpy().view(np.uint64), right, radius))
            centres, members = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(centres.view(np.int64)), pa.array(members.view(np.int64))], ["u", "v"])

    return within.unionByName(between).mapInArrow(compare, "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame, radius: int = 4, text: str = "text", doc_id: str = "doc_id", size: int = 4, seed: int = 42
) -> DataFrame:
    """Group documents whose fingerprints link at up to ``radius`` bits.

    Returns doc_id, text_key, fingerprint (a long), component_id, the smallest
    doc_id that can be reached, itself included, and leader, true for the rows
    of one document of each group: that of component_id, of several texts with
    this id the one of the smallest text_key. Null and empty texts and texts
    without words have fingerprint zero and are linked like any other. Rows
    with a null doc_id take part; a group of such rows alone has a null
    component_id. Repeated rows are returned as often as they come. An empty
    table gives no rows; other columns are not looked at.
    """
    prints = write_scanned(fingerprints(docs, text, doc_id, size, seed), "simhash-prints").frame
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    nodes = write_shared(prints.groupBy("fingerprint").agg(first.alias("first")), "simhash-nodes").frame
    roots = write_shared(components(near_links(nodes, radius)), "simhash-roots").frame
    linked = nodes.join(roots, nodes.fingerprint == roots.node).select("fingerprint", "first", "root")
    groups = linked.groupBy("root").agg(F.min("first").alias("least"))
    labels = linked.join(groups, "root").select(F.col("fingerprint").alias("print"), "least")
    firsts = nodes.join(labels, nodes.fingerprint == labels.print, "left").select(
        "fingerprint", F.coalesce("least", "first").alias("least")
    )
    # Written, so that Spark can split the rows of a hot fingerprint in the join.
    firsts = write_shared(firsts, "simhash-firsts").frame
    leader = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    return prints.join(firsts, "fingerprint").select(
        "doc_id", "text_key", "fingerprint", F.col("least.doc_id").alias("component_id"), leader.alias("leader")
    )
