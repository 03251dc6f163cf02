"""Quality of documents by a factorisation machine.

A document is a sparse vector: its hashed words, and one entry for the range in
which each statistic of its structure and metadata lies. Its score is linear in
the entries and in all their pairs, where the weight of a pair is the product of
two vectors of low rank. Sum over pairs of <v_i, v_j> x_i x_j is half of
(sum v_i x_i)^2 - sum (v_i x_i)^2, so a document is scored in time linear in its
entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gapmend.llm.texts import LOWER, UNSPACED, byte_table, chunks, fields, schema_of, words_of

WORD_BUCKETS = 1 << 14
RANGES = 16
RANK = 8
# Labelled documents that are learnt from at most, those of smallest hash.
MOST_LABELLED = 5000
EPOCHS = 6
BATCH = 64
RATE = 0.08
DECAY = 1e-5

UPPER = byte_table(lambda b: 65 <= b <= 90)
DIGIT = byte_table(lambda b: 48 <= b <= 57)
SIGN = byte_table(lambda b: 33 <= b < 127 and not chr(b).isalnum())
BEYOND_ASCII = byte_table(lambda b: b >= 128)


@dataclass
class Entries:
    """Sparse rows: the entries of row r are start[r] to start[r + 1]."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def statistics(data: np.ndarray, bounds: np.ndarray, words, hashes: np.ndarray, distinct: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """Statistics of each text, all about from 0 to 1."""

    def total(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[at])

    size = np.maximum(np.diff(bounds), 1)
    count = words.counts()
    some = np.maximum(count, 1)
    same = np.concatenate(([False], hashes[1:] == hashes[:-1]))[: len(hashes)]
    # A word that ends in a sign other than , or . stands out.
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    odd = SIGN[last] & (last != 44) & (last != 46)
    shares = [
        total(UPPER[data], bounds) / size,
        total(DIGIT[data], bounds) / size,
        total(SIGN[data], bounds) / size,
        total(BEYOND_ASCII[data], bounds) / size,
        total(data == 10, bounds) / size * 10,
        total(same, words.first) / some,
        total(odd, words.first) / some,
        distinct / some,
        (size - count) / some / 20,
        np.log1p(count) / 12,
        np.log1p(np.maximum(n_chars, 0)) / 15,
    ]
    return np.sqrt(np.clip(np.column_stack(shares), 0, 1))


N_STATISTICS = 11
SIZE = WORD_BUCKETS + N_STATISTICS * RANGES


def entries(data: np.ndarray, bounds: np.ndarray, n_chars: np.ndarray) -> Entries:
    """The vectors of texts; words weigh by the log of their count, and all words
    of a text together as much as one entry."""
    words = words_of(data, bounds, UNSPACED)
    lower = words_of(LOWER[data], bounds, UNSPACED).hashes()
    texts = len(bounds) - 1
    key, times = np.unique(words.text_of_word() * WORD_BUCKETS + (lower >> np.uint64(50)).astype(np.int64), return_counts=True)
    text, bucket = np.divmod(key, WORD_BUCKETS)
    weight = np.log1p(times)
    norm = np.sqrt(np.bincount(text, weight**2, texts))
    distinct = np.bincount(text, minlength=texts)
    shares = statistics(data, bounds, words, lower, distinct, n_chars)
    ranges = np.minimum((shares * RANGES).astype(np.int64), RANGES - 1)
    columns = WORD_BUCKETS + np.arange(N_STATISTICS) * RANGES + ranges
    every = np.repeat(np.arange(texts), N_STATISTICS)
    row = np.concatenate((text, every))
    order = np.argsort(row, kind="stable")
    value = np.concatenate((weight / norm[text], np.ones(len(every))))
    return Entries(
        np.concatenate(([0], np.cumsum(np.bincount(row, minlength=texts)))),
        np.concatenate((bucket, columns.ravel()))[order].astype(np.int32),
        value[order].astype(np.float32),
    )


@dataclass
class Machine:
    """Intercept, linear weights, and a vector of low rank for each entry."""

    bias: float
    linear: np.ndarray
    vectors: np.ndarray

    def parts(self, x: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores (log odds), and what their gradient needs."""
        scaled = self.vectors[x.index] * x.value[:, None]
        sums = np.add.reduceat(scaled, x.start[:-1], axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), x.start[:-1])
        linear = np.add.reduceat(self.linear[x.index] * x.value, x.start[:-1])
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2, scaled, sums

    def score(self, x: Entries) -> np.ndarray:
        """Probability of label 1; every row has entries, those of its statistics."""
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0].astype(np.float64), -30, 30)))


def fitted(x: Entries, labels: np.ndarray, seed: int = 7) -> Machine:
    """Minimise the logistic loss by AdaGrad over shuffled batches. Without rows
    every score is a half; with labels of one kind it is near their mean."""
    random = np.random.default_rng(seed)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32), random.normal(0, 0.05, (SIZE, RANK)).astype(np.float32)
    )
    if labels.min(initial=1) == labels.max(initial=0):
        machine.vectors[:] = 0
        return machine
    seen_linear, seen_vectors = np.full(SIZE, 1e-3, np.float32), np.full((SIZE, RANK), 1e-3, np.float32)
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            counts = x.start[rows + 1] - x.start[rows]
            start = np.concatenate(([0], np.cumsum(counts)))
            at = np.arange(start[-1]) + np.repeat(x.start[rows] - start[:-1], counts)
            batch = Entries(start, x.index[at], x.value[at])
            scores, scaled, sums = machine.parts(batch)
            error = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - labels[rows]).astype(np.float32)
            row = batch.row()
            slope = error[row] * batch.value
            used, place = np.unique(batch.index, return_inverse=True)
            linear = np.bincount(place, slope, len(used)).astype(np.float32) / len(rows) + DECAY * machine.linear[used]
            each = slope[:, None] * (sums[row] - scaled)
            vectors = np.zeros((len(used), RANK), np.float32)
            np.add.at(vectors, place, each)
            vectors = vectors / len(rows) + DECAY * machine.vectors[used]
            seen_linear[used] += linear**2
            seen_vectors[used] += vectors**2
            machine.linear[used] -= RATE * linear / np.sqrt(seen_linear[used])
            machine.vectors[used] -= RATE * vectors / np.sqrt(seen_vectors[used])
            machine.bias -= RATE * float(error.mean())
    return machine


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for a fifth of the ids, which are never learnt from; false for null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _inputs(docs: DataFrame, text: str, n_chars: str) -> list[Column]:
    return [F.col(text).alias("text"), F.coalesce(F.col(n_chars).cast("bigint"), F.lit(0)).alias("n_chars")]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", n_chars: str = "n_chars",
    doc_id: str = "doc_id", most: int = MOST_LABELLED,
) -> Machine:
    """Learn from at most ``most`` labelled documents that are not held out.

    A document with several labels has the smallest; labels that are null or
    name no document are left out.
    """
    known = labels.filter(~held_out(doc_id)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).alias("label"))
    known = known.filter("doc_id is not null and label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(doc_id).alias("doc_id"), *_inputs(docs, text, n_chars))
    # The labels are bounded by ``most``.
    rows = rows.join(F.broadcast(known), "doc_id")
    # One document for each: repeated rows and ids come in no larger numbers.
    inputs = [c for c in rows.columns if c != "doc_id"]
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(*inputs)).alias("one")).select("doc_id", "one.*")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            x = entries(data, bounds, part.column("n_chars").to_numpy())
            start = pa.array(x.start.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("label").cast(pa.float64()),
                    pa.ListArray.from_arrays(start, pa.array(x.index)), pa.ListArray.from_arrays(start, pa.array(x.value)),
                ],
                ["doc_id", "label", "index", "value"],
            )

    schema = schema_of(rows.select("doc_id"), "label double, index array<int>, value array<float>")
    found = rows.mapInArrow(scan, schema).orderBy("doc_id", "label", F.xxhash64("index", "value")).toArrow().combine_chunks()
    lists = [found.column(name).combine_chunks() for name in ("index", "value")]
    lists = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in lists]
    x = Entries(
        np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64),
        lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy(),
    )
    return fitted(x, found.column("label").to_numpy())


def quality_scores(
    docs: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars", doc_id: str = "doc_id", keep: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``keep`` on) of each row.

    The text and n_chars are all that a score depends on. Null texts are scored
    as empty ones, on their statistics alone; a null n_chars counts as 0.
    Repeated rows are scored alike, an empty table gives no rows, and other
    columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), *_inputs(docs, text, n_chars))
    shared = docs.sparkSession.sparkContext.broadcast(fields(machine))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            score = Machine(*shared.value).score(entries(data, bounds, part.column("n_chars").to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= keep).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    schema = schema_of(rows.select("doc_id", "held_out"), "score double, predicted int")
    return rows.mapInArrow(scan, schema)
