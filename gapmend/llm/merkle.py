"""A Merkle manifest of a dataset, and the proof of each row against it.

Rows are leaves, in order within their group; every run of three nodes is
hashed to their parent until one is left, and the groups' subroots are hashed
the same way to one root. The tree is kept as records of a content-addressed
DAG, digest to children, bundled by block: a block is the part of a tree that
hangs under one node six levels above, at most 729 nodes of the lowest of them.
So a tree of any size is built by one grouping for each six levels.

A proof is found by descent. Requests start at the root and go down by the
digits of the rank, to base three: the digit names the child to go to, the other
children are collected. Requests below one node share their way so far, so the
descent takes one join for each six levels, and the request of a single leaf
exists in its last block only. Reversed, the collected path leads from leaf to
root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gapmend.llm.texts import schema_of, write_scanned
from gapmend.shared import Written, write_shared

FANOUT = 3
# Levels of a tree in a block, which has at most FANOUT ** LEVELS nodes at its foot.
LEVELS = 6

RECORDS = "digests array<binary>, children array<array<binary>>"


def digest_of(columns: Sequence[Column]) -> Column:
    """SHA-256 of values of a row as 32 bytes: each a hyphen if null, else its
    number of UTF-8 bytes, a colon and the value."""
    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(part, columns)), 256))


def parent_of(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def height(nodes: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def records_of(nodes: list[bytes], levels: int) -> tuple[bytes, dict[bytes, list[bytes]]]:
    """The node ``levels`` above, and the children of all nodes down to it."""
    records = {}
    for _ in range(levels):
        runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        nodes = [parent_of(run) for run in runs]
        records.update(zip(nodes, runs))
    return nodes[0], records


def descend(records: dict[bytes, list[bytes]], node: bytes, rank: int, levels: int) -> tuple[bytes, bytes]:
    """The node of a rank ``levels`` below, and the path to it: for each level
    the digit, the number of other children, and these."""
    path = []
    for level in range(levels - 1, -1, -1):
        digit = rank // FANOUT**level % FANOUT
        run = records[node]
        others = run[:digit] + run[digit + 1 :]
        path.append(bytes((digit, len(others))) + b"".join(others))
        node = run[digit]
    return node, b"".join(path)


def steps_up(path: bytes) -> list[tuple[int, list[bytes]]]:
    """The digits and other children of a path, from its end to the root."""
    steps, at = [], 0
    while at < len(path):
        end = at + 2 + 32 * path[at + 1]
        steps.append((path[at], [path[i : i + 32] for i in range(at + 2, end, 32)]))
        at = end
    return steps[::-1]


def fold(leaf: bytes, steps: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and the nodes beside its way lead to."""
    for digit, others in steps:
        leaf = parent_of([*others[:digit], leaf, *others[digit:]])
    return leaf


def ranked(rows: DataFrame, order: Sequence[str], made: list[Written]) -> DataFrame:
    """Rows with ``place``, from 0 in ``order`` within their ``tree``, and
    ``size``, the rows of the tree.

    Range partitions number their own rows; one row for each tree in a partition
    says how many went before. Rows that agree in all of ``order`` are dealt to
    partitions too.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, "tree", *keys)
    dealt = dealt.withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part", "tree").orderBy(*keys)
    # Written, since ranges that are drawn again could differ.
    made.append(write_shared(dealt.withColumn("_row", F.row_number().over(inside) - 1).drop("_tie"), "merkle-order"))
    dealt = made[-1].frame
    counts = dealt.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        F.col("_part").alias("p"), F.col("tree").alias("t"), F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(tree).alias("size")
    )
    made.append(write_shared(counts, "merkle-counts"))
    same = (F.col("_part") == F.col("p")) & F.col("tree").eqNullSafe(F.col("t"))
    return dealt.join(made[-1].for_join(), same).withColumn("place", F.col("before") + F.col("_row")).drop("_part", "_row", "p", "t", "before")


def grow(nodes: DataFrame, levels: int = LEVELS) -> list[Written]:
    """The blocks of all trees, lowest first.

    ``nodes`` has tree, place, size, digest and own, a struct that stays with
    the lowest nodes. Each table of blocks has tree, place (the block's), size (the
    nodes of the tree at its foot), digest (its top), its records and owns. Where
    size fits one block, that holds the rest of the tree and its top is the root.
    """
    most = FANOUT**levels
    segments = []
    while True:
        block = F.floor(F.col("place") / most).cast("bigint")
        foot = F.sort_array(F.collect_list(F.struct("place", "digest", "own")))
        rows = nodes.groupBy("tree", block.alias("place"), "size").agg(foot.alias("foot")).select(
            "tree", "place", "size", F.col("foot.digest").alias("foot"), F.col("foot.own").alias("owns")
        )
        schema = schema_of(rows.drop("foot"), f"digest binary, {RECORDS}")

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tops, digests, children = [], [], []
                for foot, size in zip(batch.column("foot").to_pylist(), batch.column("size").to_pylist()):
                    top, records = records_of(foot, levels if size > most else height(size))
                    tops.append(top)
                    digests.append(list(records))
                    children.append(list(records.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("tree", "place", "size", "owns")), pa.array(tops, pa.binary()),
                        pa.array(digests, pa.list_(pa.binary())), pa.array(children, pa.list_(pa.list_(pa.binary()))),
                    ],
                    schema.names,
                )

        segments.append(write_scanned(rows.mapInArrow(build, schema), "merkle-blocks"))
        higher = segments[-1].frame.filter(F.col("size") > most)
        if higher.isEmpty():
            return segments
        size = F.ceil(F.col("size") / most).cast("bigint")
        nodes = higher.select("tree", "place", size.alias("size"), "digest", F.lit(None).cast("struct<none:int>").alias("own"))


def walked(blocks: DataFrame, requests: DataFrame, finish: str | None, levels: int = LEVELS) -> Written:
    """Requests for all nodes at the foot of the requested blocks.

    ``requests`` has tree, place, digest, path, subroot and root. With ``finish``,
    the name of a field of own with the leaf as it is to be checked, the leaves
    come back as digest, own, subroot, root, proof_sha256 and folded_root.
    """
    most = FANOUT**levels
    asked = requests.withColumnsRenamed({c: f"_{c}" for c in requests.columns})
    here = (
        (F.col("digest") == F.col("_digest")) & (F.col("place") == F.col("_place")) & F.col("tree").eqNullSafe(F.col("_tree"))
    )
    rows = blocks.join(asked, here).drop("_digest", "_place", "_tree")
    own = blocks.schema["owns"].dataType.elementType
    kept = blocks.select("tree", F.lit(None).cast(own).alias("own"), F.lit(b"").alias("digest"))
    if finish:
        schema = schema_of(kept, "subroot binary, root binary, proof_sha256 string, folded_root binary")
    else:
        schema = schema_of(kept, "place long, path binary, subroot binary, root binary")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owns = batch.column("owns")
            counts = pa.compute.list_value_length(owns).to_pylist()
            row_of = pa.array([r for r, n in enumerate(counts) for _ in range(n)], pa.int32())
            flat = owns.flatten()
            checked = flat.field(finish).to_pylist() if finish else None
            columns = {name: batch.column(name).to_pylist() for name in ("place", "size", "digest", "digests", "children", "_path")}
            ends, places, paths, proofs, folded = [], [], [], [], []
            for place, size, top, digests, children, path in zip(*columns.values()):
                records = dict(zip(digests, children))
                depth = levels if size > most else height(size)
                above = steps_up(path)
                for i in range(min(size - place * most, most)):
                    node, below = descend(records, top, i, depth)
                    if finish:
                        steps = steps_up(below) + above
                        proof = "".join(x.hex() for _, others in steps for x in others)
                        proofs.append(hashlib.sha256(proof.encode()).hexdigest())
                        folded.append(fold(checked[len(ends)], steps))
                    else:
                        places.append(place * most + i)
                        paths.append(path + below)
                    ends.append(node)
            above = [batch.column(name).take(row_of) for name in ("_subroot", "_root")]
            if finish:
                more = [*above, pa.array(proofs, pa.string()), pa.array(folded, pa.binary())]
            else:
                more = [pa.array(places, pa.int64()), pa.array(paths, pa.binary()), *above]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree").take(row_of), flat, pa.array(ends, pa.binary()), *more], schema.names
            )

    return write_scanned(rows.mapInArrow(walk, schema), "merkle-requests")


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    doc_id: str = "doc_id",
    check: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """The Merkle tree over all rows, as each row's proof against its root.

    A leaf is the digest of ``columns``. Leaves stand in the order of ``doc_id``
    (nulls first, ties by digest) within their ``group``, subroots in that of the
    groups (null first). Returns doc_id, leaf, subroot, root, proof_sha256 (of
    the nodes beside the way from leaf to root), folded_root, and verified: whether
    the row still leads to the root when ``check`` replaces some columns by what is
    found now. Digests are lower-case hex.

    Null values, empty and long texts are values like others. Rows that agree in
    everything have equal leaves and a place each. An empty table gives no rows;
    other columns are not looked at.
    """
    found = [(check or {}).get(c, F.col(c)) for c in columns]
    own = F.struct(F.col(doc_id).alias("doc_id"), digest_of(found).alias("found"))
    leaves = docs.select(F.col(group).alias("tree"), digest_of([F.col(c) for c in columns]).alias("digest"), own.alias("own"))
    made: list[Written] = []
    # Written, since a range partitioning reads its input twice.
    made.append(write_shared(leaves.withColumn("first", F.col("own.doc_id")), "merkle-leaves"))
    leaves = ranked(made[-1].frame, ["first", "digest"], made).drop("first")
    segments = grow(leaves, levels)
    made += segments
    subroots = None
    for i, segment in enumerate(segments):
        tops = segment.frame.filter(F.col("size") <= FANOUT**levels).select("tree", "digest", F.lit(i).alias("segment"))
        subroots = tops if subroots is None else subroots.unionByName(tops)
    trees = ranked(
        subroots.select(F.lit("").alias("tree"), "digest", F.struct(F.col("tree").alias("name"), "segment").alias("own"))
        .withColumn("first", F.col("own.name")),
        ["first"],
        made,
    ).drop("first")
    above = grow(trees, levels)
    made += above
    top = above[-1].frame.filter(F.col("size") <= FANOUT**levels)
    requests = top.select("tree", "place", "digest", F.lit(b"").alias("path"), F.lit(b"").alias("subroot"), F.col("digest").alias("root"))
    for segment in reversed(above):
        done = walked(segment.frame, requests, None, levels)
        made.append(done)
        requests = done.for_join().select("tree", "place", "digest", "path", "subroot", "root")
    ask = done.frame.select(
        F.col("own.name").alias("tree"), F.lit(0).cast("bigint").alias("place"), "digest", "path",
        F.col("digest").alias("subroot"), "root", F.col("own.segment").alias("segment"),
    )
    ask = write_shared(ask, "merkle-subroots")
    made.append(ask)
    lower = None
    for i in range(len(segments) - 1, -1, -1):
        requests = ask.frame.filter(F.col("segment") == i).drop("segment")
        if lower is not None:
            requests = requests.unionByName(lower.frame.select(*requests.columns))
        made.append(write_shared(requests, "merkle-requests"))
        lower = walked(segments[i].frame, made[-1].for_join(), None if i else "found", levels)
        made += [lower] if i else []
    for table in made:
        table.drop()
    hexed = [F.lower(F.hex(c)).alias(n) for c, n in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))]
    return lower.frame.select(
        F.col("own.doc_id").alias("doc_id"), *hexed, "proof_sha256", F.lower(F.hex("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
