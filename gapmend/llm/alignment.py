"""Which tokens of two tokenizers cover the same bytes, over a whole corpus.

A token-byte matrix has a row for each token of a text and a one for each byte
that the token covers. Kept in compressed rows (CSR) and multiplied row by row
after Gustavson, A times the transpose of B has an entry for each pair of tokens
whose bytes overlap, and its value is the number of bytes they share. Offsets
where tokens of both end cut the tokens into groups; the product of the two
token-group matrices has an entry for each pair of tokens in one group.

Corpus counts of linked ids are looked up without a join of all links. Texts are
worked on in blocks of some megabytes; a block holds its links as one more sparse
matrix, documents by the distinct id pairs of the block. Only the distinct pairs
of each block are counted, joined with their counts and brought back, and the
product of matrix and counts is what each document needs. A row of a table holds
one document or a stretch of pairs, never a block, so that the memory of a task
does not depend on the size of blocks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gapmend.llm.packing import tokenizer
from gapmend.llm.texts import CHUNK_BYTES, chunks, kept_in_process, schema_of, text_key, write_scanned
from gapmend.shared import Written, session_conf, write_shared

# Bytes of text in a block, whose distinct pairs are looked up together.
BLOCK_BYTES = 2 << 20
# Bytes that a text counts for in a block besides its own.
ROW_BYTES = 64
# Pairs of a block's list in a row.
PAIRS_IN_ROW = 4096
# Rows that a scan decodes at once: texts and lists of links are long.
SCAN_ROWS = 256
# Fixed value: what stands for a space in pieces.
SPACE = "▁"


@dataclass(frozen=True)
class Matrix:
    """Ones in compressed rows: those of row i are in the columns
    ``indices[begins[i]:begins[i + 1]]``, in ascending order."""

    begins: np.ndarray
    indices: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))

    def transposed(self) -> "Matrix":
        order = np.argsort(self.indices, kind="stable")
        begins = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns))))
        return Matrix(begins, self.rows()[order], len(self.begins) - 1)


def intervals(sizes: np.ndarray) -> Matrix:
    """Rows of ones that follow each other: the bytes of tokens of such sizes."""
    begins = np.concatenate(([0], np.cumsum(sizes)))
    return Matrix(begins, np.arange(begins[-1]), int(begins[-1]))


def members(groups: np.ndarray, count: int) -> Matrix:
    """A row for each token, with a one in the column of its group."""
    return Matrix(np.arange(len(groups) + 1), groups, count)


def product_sizes(a: Matrix, b: Matrix) -> np.ndarray:
    """For each row of a·b the entries that its row product adds up."""
    sums = np.concatenate(([0], np.cumsum(np.diff(b.begins)[a.indices])))
    return sums[a.begins[1:]] - sums[a.begins[:-1]]


def row_products(a: Matrix, b: Matrix) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a·b by Gustavson: row i is the sum of those rows of b that row i of a
    names. Returns rows, columns and values of the entries, in order."""
    sizes = np.diff(b.begins)[a.indices]
    before = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(b.begins[a.indices] - before, sizes)
    keys = np.repeat(a.rows(), sizes) * b.columns + b.indices[at]
    if len(keys) and (keys[1:] < keys[:-1]).any():
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    keys, values = keys[first], np.diff(np.append(first, len(keys)))
    return keys // max(b.columns, 1), keys % max(b.columns, 1), values


@dataclass(frozen=True)
class Side:
    """A tokenizer's tokens: their bytes, sizes, and how a list of groups writes
    them inside and at the end of a group."""

    tokens: list[bytes]
    sizes: np.ndarray
    inner: np.ndarray
    last: np.ndarray


def side(tokens: list[bytes], end: str) -> Side:
    inner, last = (np.array([f"{i}{mark}" for i in range(len(tokens))], object) for mark in (",", end))
    return Side(tokens, np.array(list(map(len, tokens)), np.int64), inner, last)


class Pair:
    """Two tokenizers, given by files: A a byte-level BPE of the tokenizers
    library, B a sentencepiece model."""

    def __init__(self, byte_level: str, pieces: str):
        self.bpe = tokenizer(byte_level)
        model = self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        named = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        b = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(named)]
        a = [b""] * self.bpe.n_vocab
        for i in range(len(a)):
            try:
                a[i] = self.bpe.decode_single_token_bytes(i)
            except KeyError:
                pass
        self.a, self.b = side(a, "|"), side(b, ";")

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both, none where the tokens do not spell a space and the text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        spelt = (" " + text).encode()
        a, b = self.bpe.encode_ordinary(" " + text), self.model.encode(text)
        if b"".join(map(self.b.tokens.__getitem__, b)) != spelt or b"".join(map(self.a.tokens.__getitem__, a)) != spelt:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)


@dataclass(frozen=True)
class Aligned:
    """Tokens of texts put one after the other. ``group_a`` and ``group_b`` number
    the groups of tokens; links are pairs of positions and the bytes they share."""

    group_a: np.ndarray
    group_b: np.ndarray
    groups: int
    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    # Links of each token of A within its group.
    group_links: np.ndarray


def align(sizes_a: np.ndarray, sizes_b: np.ndarray, most: int = CHUNK_BYTES) -> Aligned:
    """Align tokens of given sizes over the same bytes. Links do not leave their
    group, so that the matrices are made for stretches of whole groups, as many
    as have ``most`` bytes."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    found, inside, group = [], [], 0
    while group < len(cuts):
        begin = cuts[group - 1] if group else 0
        after = max(int(np.searchsorted(cuts, begin + most, side="right")), group + 1)
        (a0, a1), (b0, b1) = (np.searchsorted(g, (group, after)) for g in (group_a, group_b))
        a, b = intervals(sizes_a[a0:a1]), intervals(sizes_b[b0:b1])
        rows, columns, values = row_products(a, b.transposed())
        found.append((rows + a0, columns + b0, values))
        a, b = (members(g - group, after - group) for g in (group_a[a0:a1], group_b[b0:b1]))
        inside.append(product_sizes(a, b.transposed()))
        group = after
    none = np.zeros(0, np.int64)
    links = [np.concatenate(x) for x in zip(*found)] if found else [none] * 3
    return Aligned(group_a, group_b, len(cuts), *links, np.concatenate(inside) if inside else none)


def group_texts(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, found: Aligned, docs_a: np.ndarray, docs_b: np.ndarray) -> list[str]:
    """The groups of each text: ids of A, a bar, ids of B, groups set apart by
    semicolons. Tokens of text t are docs_a[t] to docs_a[t + 1] and so on."""
    place_a = np.arange(len(ids_a)) + np.searchsorted(found.group_b, found.group_a)
    place_b = np.arange(len(ids_b)) + np.searchsorted(found.group_a, found.group_b, side="right")
    out = np.empty(len(ids_a) + len(ids_b), object)
    for table, ids, place, group in ((pair.a, ids_a, place_a, found.group_a), (pair.b, ids_b, place_b, found.group_b)):
        ends = np.append(group[1:] != group[:-1], True)[: len(group)]
        out[place] = np.where(ends, table.last[ids], table.inner[ids])
    out, bounds = out.tolist(), (docs_a + docs_b).tolist()
    return ["".join(out[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def counted_by(parts: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    return np.bincount(parts, values, minlength=n).astype(np.int64)


@dataclass(frozen=True)
class Chunk:
    """Some texts, aligned; ``first`` says where the tokens of each begin."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    found: Aligned


def pair_of(byte_level: str, pieces: str) -> Pair:
    return kept_in_process((byte_level, pieces), lambda: Pair(byte_level, pieces))


def read(pair: Pair, texts: list[str | None]) -> Chunk:
    coded = [pair.encode(t) for t in texts]
    ids_a, ids_b = (np.concatenate([c[i] for c in coded]) for i in (0, 1))
    first_a, first_b = (np.concatenate(([0], np.cumsum([len(c[i]) for c in coded]))) for i in (0, 1))
    return Chunk(ids_a, ids_b, first_a, first_b, align(pair.a.sizes[ids_a], pair.b.sizes[ids_b]))


def alignments(docs: DataFrame, byte_level: str, pieces: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The alignment of each text itself: doc_id, text_key, a and b (the ids),
    group_a and group_b (the group of each token, from 0) and links, by position:
    a, b and the bytes that they share. Rows as for ``align_tokenizers``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    ints = ", ".join(f"{c} array<int>" for c in ("a", "b", "group_a", "group_b"))
    schema = schema_of(rows.select("doc_id", "text_key"), f"{ints}, links array<struct<a:int, b:int, bytes:int>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_level, pieces)
        for part, _, _ in chunks(batches):
            chunk = read(pair, part.column("text").to_pylist())
            found, a, b = chunk.found, chunk.first_a, chunk.first_b
            first = np.searchsorted(found.link_a, a)
            base = [np.repeat(x[:-1], np.diff(first)) for x in (a, b)]
            links = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (found.link_a - base[0], found.link_b - base[1], found.shared)], ["a", "b", "bytes"]
            )
            lists = []
            for values, begins, groups in ((chunk.ids_a, a, None), (chunk.ids_b, b, None), (found.group_a, a, a), (found.group_b, b, b)):
                if groups is not None:
                    starts = np.append(found.group_a, 0)[np.minimum(a[:-1], len(found.group_a))]
                    values = values - np.repeat(starts, np.diff(begins))
                lists.append(pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values.astype(np.int32))))
            lists.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), links))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *lists], schema.names)

    return rows.mapInArrow(run, schema)


OWN = "n_a:bigint, n_b:bigint, n_groups:bigint, n_links:bigint, n_shared:bigint, groups_sha256:string"


def blocks_of(rows: DataFrame, byte_level: str, pieces: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of texts, with their links as a matrix of documents by pairs, where
    a pair is a number made of both ids. Rows are of two kinds, and small however
    much is in a block. Those of documents have their own figures and a row of the
    matrix: the columns (places in the block's list of pairs) and values (links).
    Others have a stretch of that list, from place ``begin``, and ``holders``, the
    documents of the block that hold a pair."""
    name, key = (rows.schema[c].dataType.simpleString() for c in ("doc_id", "text_key"))
    schema = (
        f"block bigint, doc struct<doc_id:{name}, text_key:{key}, {OWN}>, places array<int>, times array<int>,"
        " begin int, pairs array<bigint>, holders array<int>"
    )
    names = ["block", "doc", "places", "times", "begin", "pairs", "holders"]
    int_list, long_list = pa.list_(pa.int32()), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_level, pieces)
        width = len(pair.b.tokens)
        # No two tasks of a stage have the same partition.
        blocks = itertools.count(TaskContext.get().partitionId() << 32)

        def lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))

        def emit(done: list[tuple]) -> Iterator[pa.RecordBatch]:
            block = next(blocks)
            pairs = np.unique(np.concatenate([d[1] for d in done]))
            found = np.zeros(len(pairs), np.int64)
            for docs, held, times, counts in done:
                n, places = len(docs), np.searchsorted(pairs, held)
                # A document has a pair once at most.
                found += np.bincount(places, minlength=len(pairs))
                begins = np.concatenate(([0], np.cumsum(counts)))
                one = [pa.array(np.full(n, block)), docs, lists(begins, places, pa.int32()), lists(begins, times, pa.int32())]
                yield pa.RecordBatch.from_arrays([*one, *(pa.nulls(n, t) for t in (pa.int32(), long_list, int_list))], names)
            begins = np.arange(0, len(pairs), PAIRS_IN_ROW)
            n, bounds = len(begins), np.append(begins, len(pairs))
            one = [pa.array(np.full(n, block)), *(pa.nulls(n, t) for t in (done[0][0].type, int_list, int_list))]
            two = [pa.array(begins, pa.int32()), lists(bounds, pairs, pa.int64()), lists(bounds, found, pa.int32())]
            yield pa.RecordBatch.from_arrays([*one, *two], names)

        done, held = [], 0
        for part, data, _ in chunks(batches):
            n = part.num_rows
            chunk = read(pair, part.column("text").to_pylist())
            found, a, b = chunk.found, chunk.first_a, chunk.first_b
            doc_a = np.repeat(np.arange(n), np.diff(a))
            group_end = np.flatnonzero(np.append(found.group_a[1:] != found.group_a[:-1], True)[: len(found.group_a)])
            hashes = [
                hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(pair, chunk.ids_a, chunk.ids_b, found, a, b)
            ]
            doc_link = doc_a[found.link_a]
            own = [
                part.column("doc_id"), part.column("text_key"), pa.array(np.diff(a)), pa.array(np.diff(b)),
                pa.array(counted_by(doc_a[group_end], None, n)), pa.array(counted_by(doc_link, None, n)),
                pa.array(counted_by(doc_a, found.group_links, n)), pa.array(hashes, pa.string()),
            ]
            docs = pa.StructArray.from_arrays(own, ["doc_id", "text_key", *(f.split(":")[0] for f in OWN.split(", "))])
            # Links of a document with the same two ids are one entry.
            code = chunk.ids_a[found.link_a] * width + chunk.ids_b[found.link_b]
            distinct, place = np.unique(code, return_inverse=True)
            entry, times = np.unique(doc_link * max(len(distinct), 1) + place, return_counts=True)
            doc, place = entry // max(len(distinct), 1), entry % max(len(distinct), 1)
            done.append((docs, distinct[place], times, counted_by(doc, None, n)))
            held += len(data) + ROW_BYTES * n
            if held >= block_bytes:
                yield from emit(done)
                done, held = [], 0
        if done:
            yield from emit(done)

    return rows.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, byte_level: str, pieces: str, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """How the tokens of A and B line up in each text and in the corpus.

    A is the byte-level BPE in the tokenizers file ``byte_level`` on a space and
    the text, B the sentencepiece model ``pieces`` on the text, which adds the
    space itself; strings of special tokens are plain text. Executors must be able
    to open both files. Tokens are linked where their bytes overlap. Returns
    doc_id, text_key, n_a, n_b, n_groups, n_links, n_shared (pairs of tokens in
    one group), n_best (links whose pair of ids is, of all pairs with its id of A,
    linked in the most documents, ties included), count_sum (for each link the
    documents in which its two ids are linked) and groups_sha256, the hash of the
    groups as ``group_texts`` writes them.

    Texts that are null or empty, or that the tokens of A or B do not spell, have
    no tokens: all numbers are 0 and groups_sha256 is ''. Each row counts as a
    document, repeated ones too. An empty table gives no rows; other columns are
    not looked at.
    """
    with session_conf(docs.sparkSession, {"spark.sql.parquet.columnarReaderBatchSize": str(SCAN_ROWS)}):
        return _aligned(docs, byte_level, pieces, text, doc_id, block_bytes)


def _aligned(docs: DataFrame, byte_level: str, pieces: str, text: str, doc_id: str, block_bytes: int) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    made: list[Written] = [write_scanned(blocks_of(rows, byte_level, pieces, block_bytes), "token-blocks")]
    blocks = made[0].frame
    width = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    lists = blocks.where("begin IS NOT NULL")
    each = lists.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x")).select("x.pairs", "x.holders")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n"))
    made.append(write_shared(counts.withColumn("a", F.floor(F.col("pair") / width).cast("bigint")), "pair-counts"))
    counts = made[-1].frame
    # At most one row for each entry of A's vocabulary.
    best = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    counts = counts.join(best, "a").select("pair", F.col("n"), (F.col("n") == F.col("most")).alias("best"))
    asked = lists.select("block", "begin", F.posexplode("pairs").alias("at", "pair"))
    asked = asked.select("block", (F.col("begin") + F.col("at")).alias("place"), "pair")
    answers = asked.join(counts.hint("shuffle_hash"), "pair").select(F.col("block").alias("for_block"), "place", "n", "best")
    texts = blocks.where("doc IS NOT NULL").select("block", "doc.*", "places", "times")
    figures = texts.drop("block", "places", "times")
    schema, own = schema_of(figures, "n_best long, count_sum long"), figures.columns
    # A cogroup sends times in the session's zone and takes them back in UTC only.
    kinds = to_arrow_schema(figures.schema).types

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        places, times = (pc.list_flatten(texts[c]).to_numpy() for c in ("places", "times"))
        begins = np.concatenate(([0], np.cumsum(pc.list_value_length(texts["places"]).to_numpy())))
        sums = []
        for name in ("best", "n"):
            values = np.zeros(answers.num_rows, np.int64)
            if len(values):
                values[answers["place"].to_numpy()] = answers[name].to_numpy()
            total = np.concatenate(([0], np.cumsum(times * values[places])))
            sums.append(pa.array(total[begins[1:]] - total[begins[:-1]], pa.int64()))
        return pa.Table.from_arrays([*(texts[c].cast(kind) for c, kind in zip(own, kinds)), *sums], [*own, "n_best", "count_sum"])

    joined = texts.groupBy("block").cogroup(answers.groupBy("for_block")).applyInArrow(run, schema)
    result = write_scanned(joined, "token-alignment").frame
    for table in made:
        table.drop()
    return result
