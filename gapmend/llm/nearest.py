"""Nearest vectors by cosine, found in a hierarchical k-means tree.

The tree is fitted on a bounded sample of unit vectors: each node is cut into a
few clusters, again and again. Every vector is then filed under the leaf it
falls to. A query walks the tree best bin first: a priority queue holds the
branches not yet taken, and the one whose centre is nearest goes on, so leaves
come in the order in which they promise neighbours. How many of them a query
visits is calibrated: a sample of queries is answered from all vectors in
blocks, and for queries as close to their first leaf as each other, visits are
widened until these would have found the wished share of the true neighbours.

Vectors that are alike bit by bit are filed once with the smallest ids that
could be asked for, so a very common vector is one row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gapmend.llm.texts import fields, schema_of
from gapmend.shared import session_conf, write_shared

# Vectors that the tree is fitted on at most, those of smallest hash.
MOST_FITTED = 20_000
BRANCHES = 8
LEAF_SAMPLE = 100
# Queries that calibrate the visits at most.
MOST_CALIBRATED = 400
RECALL = 0.95
# Vectors in a block of a leaf, and queries that meet it at once.
BLOCK = 1024
# Queries are as hard as others of the same tenth of cosine to their first leaf.
TENTHS = 10


@dataclass
class Tree:
    """Centres of all nodes, children of inner nodes, and the leaf numbers."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray
    leaves: int

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls to, taking the nearest branch."""
        node = np.zeros(len(vectors), np.int64)
        todo = np.arange(len(vectors)) if self.children[0] else np.zeros(0, np.int64)
        while len(todo):
            for at in np.unique(node[todo]):
                rows = todo[node[todo] == at]
                kids = np.array(self.children[at])
                node[rows] = kids[np.argmax(vectors[rows] @ self.centres[kids].T, axis=1)]
            todo = todo[[bool(self.children[at]) for at in node[todo]]]
        return self.leaf[node]

    def order(self, near: np.ndarray, visits: int) -> list[int]:
        """The first leaves, best bin first; ``near`` holds a query's cosines to
        all centres."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            at = heapq.heappop(queue)[1]
            while self.children[at]:
                kids = sorted(self.children[at], key=lambda k: -near[k])
                for kid in kids[1:]:
                    heapq.heappush(queue, (-near[kid], kid))
                at = kids[0]
            found.append(int(self.leaf[at]))
        return found


def clusters(vectors: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the cluster of each vector, by spherical k-means."""
    centres = vectors[random.choice(len(vectors), min(BRANCHES, len(vectors)), replace=False)]
    for _ in range(10):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres, np.argmax(vectors @ centres.T, axis=1)


def fit(vectors: np.ndarray, seed: int = 11) -> Tree:
    """A tree whose leaves hold about ``LEAF_SAMPLE`` of the fitted vectors."""
    random = np.random.default_rng(seed)
    width = vectors.shape[1] if vectors.ndim == 2 else 0
    centres, children, leaf, leaves = [np.zeros(width)], [[]], [-1], 0
    todo = [(0, np.arange(len(vectors)))]
    while todo:
        at, rows = todo.pop()
        if len(rows) > LEAF_SAMPLE:
            middle, own = clusters(vectors[rows], random)
            used = [c for c in range(len(middle)) if (own == c).any()]
            if len(used) > 1:
                for c in used:
                    children[at].append(len(centres))
                    todo.append((len(centres), rows[own == c]))
                    centres.append(middle[c])
                    children.append([])
                    leaf.append(-1)
                continue
        leaf[at] = leaves
        leaves += 1
    return Tree(np.array(centres), children, np.array(leaf), leaves)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row and summed in one order, so equal pairs have equal cosines."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    dot = np.cumsum(a * b, axis=1)[:, -1]
    return dot / np.sqrt(np.cumsum(a * a, axis=1)[:, -1] * np.cumsum(b * b, axis=1)[:, -1])


def usable(vectors: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    rows = vectors.select(F.col(vector_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("id is not null and vector is not null").filter(finite & F.exists("vector", lambda x: x != 0))


def top(scores: np.ndarray, k: int) -> np.ndarray:
    """True for the ``k`` largest of each row, and all about as large as the last."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    # Products round differently than the exact score that follows.
    least = np.partition(scores, -k, axis=1)[:, -k]
    return scores >= least[:, None] - 1e-9


def filed(rows: DataFrame, tree: Tree, k: int) -> DataFrame:
    """Blocks of the leaves: leaf, block, and lists of vectors with their ids.

    Only the ``k + 1`` smallest ids of a vector can be among the nearest of a
    query, which may be one of them itself. Spark limits the rows of a group
    in each task before it shuffles them.
    """
    place = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("n", F.row_number().over(place)).filter(F.col("n") <= k + 1)
    alike = first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shared = rows.sparkSession.sparkContext.broadcast(fields(tree))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = Tree(*shared.value).assign(unit(matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    leaves = write_shared(alike.mapInArrow(file, schema_of(alike, "leaf int")), "nearest-leaves").frame
    blocks = dealt(leaves, F.xxhash64("vector"), BLOCK)
    return write_shared(
        blocks.groupBy("leaf", "block").agg(F.collect_list("ids").alias("ids"), F.flatten(F.collect_list("vector")).alias("vectors")),
        "nearest-blocks",
    ).frame


def dealt(rows: DataFrame, by: Column, size: int) -> DataFrame:
    """Add ``block``: the rows of each leaf in parts of about ``size``."""
    # One row for each leaf; their number is bounded by the fitted sample.
    counts = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    return rows.join(F.broadcast(counts), "leaf").withColumn("block", F.pmod(by, "blocks").cast("int")).drop("blocks")


def visits(queries: DataFrame, tree: Tree, budget: list[int]) -> DataFrame:
    """query_id, vector, leaf and its place in the query's order of leaves."""
    shared = queries.sparkSession.sparkContext.broadcast((fields(tree), budget))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, budget = Tree(*shared.value[0]), shared.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            near = unit(matrix(batch.column("vector"))) @ tree.centres.T
            leaves, tenths = [], []
            for row in near:
                first = tree.order(row, 1)[0]
                tenth = hardness(row[tree.leaf == first][0])
                tenths.append(tenth)
                leaves.append(tree.order(row, budget[tenth]))
            size = [len(x) for x in leaves]
            take = pa.array(np.repeat(np.arange(batch.num_rows), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id").take(take), batch.column("vector").take(take),
                    pa.array(np.concatenate(leaves).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(n) for n in size]).astype(np.int32)),
                    pa.array(np.repeat(tenths, size).astype(np.int32)),
                ],
                schema.names,
            )

    schema = schema_of(queries.select("query_id", "vector"), "leaf int, place int, tenth int")
    return queries.mapInArrow(walk, schema)


def hardness(near: float) -> int:
    return min(max(int(near * TENTHS), 0), TENTHS - 1)


def searched(blocks: DataFrame, steps: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest that the visited leaves hold: query_id, id, score,
    rank, and place and tenth of the step."""
    steps = dealt(steps, F.xxhash64("query_id"), BLOCK // 4)
    asked = steps.groupBy("leaf", "block").agg(
        F.collect_list(F.struct("query_id", "place", "tenth")).alias("queries"),
        F.flatten(F.collect_list("vector")).alias("asked"),
    )
    # Never a broadcast: one query's vector repeats for each leaf, which compresses
    # to little in the shuffle that Spark would measure it by.
    pairs = blocks.drop("block").hint("merge").join(asked.drop("block").hint("merge"), "leaf").drop("leaf")
    query_type = steps.schema["query_id"].dataType.simpleString()
    id_type = blocks.schema["ids"].dataType.elementType.elementType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, queries, asked in zip(*(batch.column(c) for c in ("ids", "vectors", "queries", "asked"))):
                lists, queries = ids.values, queries.values
                mine = vectors.values.to_numpy().reshape(len(lists), -1)
                theirs = asked.values.to_numpy().reshape(len(queries), -1)
                # A query's own vector may be in, so one more.
                query, row = np.nonzero(top(unit(theirs) @ unit(mine).T, k + 1))
                score = cosine(theirs[query], mine[row])
                count = lists.value_lengths().to_numpy()[row]
                begin = lists.offsets.to_numpy()[row]
                at = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
                found = lists.values.to_numpy()[at]
                query, score = np.repeat(query, count), np.repeat(score, count)
                names = queries.field("query_id").to_numpy()[query]
                order = np.lexsort((found, -score, query))
                order = order[names[order] != found[order]]
                new = np.concatenate(([True], query[order][1:] != query[order][:-1]))[: len(order)]
                start = np.flatnonzero(new)
                rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
                best = order[rank < k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[best]), pa.array(found[best]), pa.array(score[best]),
                        queries.field("place").take(pa.array(query[best])), queries.field("tenth").take(pa.array(query[best])),
                    ],
                    ["query_id", "id", "score", "place", "tenth"],
                )

    schema = f"query_id {query_type}, id {id_type}, score double, place int, tenth int"
    # A row is two blocks of vectors, so a few rows are a batch.
    with session_conf(blocks.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}):
        found = write_shared(pairs.mapInArrow(compare, schema), "nearest-found").frame
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def calibrated(blocks: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> list[int]:
    """Leaves to visit, by tenth of cosine: the fewest within which queries of
    a sample find the wished share of their true neighbours."""
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(MOST_CALIBRATED)
    true = searched(blocks, visits(sample, tree, [tree.leaves] * TENTHS), k)
    places: dict[int, list[int]] = {}
    # At most k rows for each query of the sample.
    for tenth, place in true.select("tenth", "place").collect():
        places.setdefault(tenth, []).append(place)
    every = [p for own in places.values() for p in own]

    def needed(own: list[int]) -> int:
        own = sorted(own if len(own) >= 20 * k else every)
        return own[min(int(np.ceil(recall * len(own))), len(own)) - 1] + 1 if own else tree.leaves

    return [needed(places.get(t, [])) for t in range(TENTHS)]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL, vector_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest vectors of each query by cosine, its own id left out.

    Returns query_id, rank (from 1), id and score, nearest first and ties to
    the smaller id; fewer than ``k`` where there are fewer candidates. Scores
    are exact, in double precision on the original vectors; the neighbours are
    those of the visited leaves, about ``recall`` of the true ones.

    Rows take no part that have a null id, or a vector that is null, zero or
    empty, or has null or non-finite components; nor those whose vectors are not
    as long as most (of lengths as frequent, the longer). A repeated id with
    another vector is another candidate, and a query id that comes twice is asked
    for with one of its vectors. Without vectors or queries there are no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vector_id, vector).distinct()
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    width = widths.first()
    rows = write_shared(rows.filter(F.size("vector") == (width["width"] if width else 0)), "nearest-vectors").frame
    asked = usable(queries, vector_id, vector).withColumnRenamed("id", "query_id")
    asked = asked.filter(F.size("vector") == (width["width"] if width else 0))
    asked = write_shared(asked.groupBy("query_id").agg(F.min("vector").alias("vector")), "nearest-queries").frame
    if width is None:
        kind = rows.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    sample = rows.select("vector").distinct().orderBy(F.xxhash64("vector")).limit(MOST_FITTED).toArrow()
    tree = fit(unit(matrix(sample.column("vector").combine_chunks())))
    blocks = filed(rows, tree, k)
    budget = calibrated(blocks, asked, tree, k, recall)
    return searched(blocks, visits(asked, tree, budget), k).select("query_id", "rank", "id", "score")
