"""Pack documents into sequences of tokens next to documents like them.

Texts are tokenised once, and from then on only their ids move. Documents that
share rare tokens are routed to one place: a fixed random order of the
vocabulary, in which rare tokens tend to come first, gives each document the
first few of its tokens as its route, and the table is ranged by routes. Two
documents have the same first token about as often as they share their rare
tokens, copies always, and large groups of one route are cut by id.

Documents are then packed shard by shard, where a shard is as many consecutive
documents of a range as fit a bounded memory. Each shard has a BM25 inverted
index of tokens. The document that begins a sequence is the seed: its unused
neighbours by BM25, the nearest first, fill the window. A document that does not
fit is cut, and its rest is the seed of the next sequence; so only the last
sequence of a range could be short, and that is cut into powers of two, which
need no padding.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gapmend.llm.texts import chunks, kept_in_process, mixed, schema_of, text_key, write_scanned
from gapmend.shared import scratch_tables

WINDOW = 1024
# Documents and tokens in a shard, beyond which the next one begins.
SHARD_DOCUMENTS = 2048
SHARD_TOKENS = 2 << 20
# BM25's usual constants.
K1, B = 1.2, 0.75
# Neighbours that are put in order before the rest.
FIRST_NEIGHBOURS = 64
# No word is a stop word, and a seed asks for all of its words.
STOP_SHARE = 1.0
QUERY_WORDS = sys.maxsize
# A word in at least one of so many entries of an index has a weight for each of them.
DENSE_SHARE = 16
# Tokens that make a document's route, 16 bits of each.
ROUTE_TOKENS = 4
# A document of more windows shares little but its last with others; its route
# is made of that, for all long ones have many tokens and so the same first ones.
ROUTE_WINDOWS = 4
# The token that ends a document.
END = 0
# Fixed value: how byte-level BPE cuts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file, as tiktoken runs it, which gives
    the same ids several times faster. Its added tokens are found in texts by
    ``encode_text``, as that library does."""
    return kept_in_process(path, lambda: read_tokenizer(path))


def read_tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    added = model.get("added_tokens", [])
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at their surroundings are not known")
    special = {t["content"]: t["id"] for t in added}
    # Such files write printable bytes as themselves and others from U+0100 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids that the tokenizers library gives with add_special_tokens=False."""
    return encoding.encode(text, allowed_special="all")


def token_order(size: int) -> np.ndarray:
    """A place from 0 to 65535 for each id of a vocabulary, in random order that
    prefers rare tokens. Byte-pair vocabularies list frequent tokens first, so the
    n-th is taken to be n times as rare as the first, and is drawn so much earlier
    (the smallest of a set is then each token with a chance as its weight)."""
    ids = np.arange(size, dtype=np.uint64)
    even = ((mixed(ids) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    place = np.empty(size, np.int64)
    place[np.argsort(-np.log(even) / (ids + np.uint64(1)))] = np.arange(size)
    return place * 65536 // max(size, 1)


def route(places: np.ndarray) -> int:
    """The first ``ROUTE_TOKENS`` different places, as one signed number."""
    out, least = 0, -1
    for _ in range(ROUTE_TOKENS):
        places = places[places > least]
        least = int(places.min()) if len(places) else 65535
        out = out << 16 | least
    return out - 2**63


class Index:
    """BM25 over the documents of a shard. Documents with the same words are one
    entry of the posting lists, so copies cost no more than one document."""

    def __init__(self, document: np.ndarray, word: np.ndarray, documents: int):
        """``document`` (ascending) and ``word`` (a hash) of every word of the shard."""
        lengths = np.bincount(document.astype(np.int64), minlength=documents)
        bags = np.zeros((documents, 2), np.uint64)
        ends = np.cumsum(lengths)
        for i in range(2):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(word, i + 1))))
            bags[:, i] = sums[ends] - sums[ends - lengths]
        _, of, self.entry, copies = np.unique(bags, axis=0, return_index=True, return_inverse=True, return_counts=True)
        self.entry = self.entry.reshape(-1)
        self.entries = len(of)
        single = of[self.entry[document]] == document
        entry, word = self.entry[document[single]], word[single]
        # One sort of a number made of both, the leading bits of the hash first.
        bits = np.uint64(max(self.entries - 1, 1).bit_length())
        pair = np.sort((word >> bits << bits) | entry.astype(np.uint64))
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))[: len(pair)])
        times = np.diff(np.append(first, len(pair)))
        word = pair[first] >> bits
        self.posting = (pair[first] - (word << bits)).astype(np.int64)
        norm = (K1 * (1 - B + B * lengths / max(lengths.mean(), 1)))[of]
        new = np.concatenate(([True], word[1:] != word[:-1]))[: len(word)]
        self.begin = np.flatnonzero(new)
        self.size = np.diff(np.append(self.begin, len(word)))
        # Documents with the word, copies as often as they come.
        having = np.add.reduceat(copies[self.posting], self.begin) if len(word) else self.size
        idf = np.log1p((documents - having + 0.5) / (having + 0.5))
        self.weight = np.repeat(idf, self.size) * times * (K1 + 1) / (times + norm[self.posting])
        # Common words as rows with the weights of all entries, which are summed
        # without looking up each: at most 4 * DENSE_SHARE bytes for each posting.
        common = np.flatnonzero((self.size * DENSE_SHARE >= self.entries) & (having > 1))
        self.row = np.full(len(self.size), -1)
        self.row[common] = np.arange(len(common))
        term = np.repeat(np.arange(len(self.size)), self.size)
        self.rows = np.zeros((len(common), self.entries), np.float32)
        at = np.flatnonzero(self.row[term] >= 0)
        self.rows[self.row[term[at]], self.posting[at]] = self.weight[at]
        # Words that name a neighbour, by entry.
        at = np.flatnonzero((having > 1)[term])
        at = at[np.argsort(self.posting[at], kind="stable")]
        self.terms = term[at]
        self.first = np.searchsorted(self.posting[at], np.arange(self.entries + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share words with the seed, the nearest first."""
        found, scores = self.scored(seed, unused)
        return found[np.argsort(-scores, kind="stable")]

    def scored(self, seed: int, unused: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unused documents that share words with the seed, and their scores."""
        entry = self.entry[seed]
        terms = self.terms[self.first[entry] : self.first[entry + 1]]
        if not len(terms):
            return terms, np.zeros(0)
        row = self.row[terms]
        dense = self.rows[row[row >= 0]].sum(axis=0)
        terms = terms[row < 0]
        size = self.size[terms]
        before = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.begin[terms] - before, size)
        scores = (dense + np.bincount(self.posting[at], self.weight[at], self.entries))[self.entry]
        found = np.flatnonzero(unused & (scores > 0))
        return found, scores[found]

    def nearest(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """The neighbours one by one. Few are asked for, so the best are sorted
        before the others, and those only if asked for."""
        found, scores = self.scored(seed, unused)
        if len(found) > FIRST_NEIGHBOURS:
            least = np.partition(scores, len(scores) - FIRST_NEIGHBOURS)[len(scores) - FIRST_NEIGHBOURS]
            best = scores > least
            yield from found[best][np.argsort(-scores[best], kind="stable")].tolist()
            found, scores = found[~best], scores[~best]
        yield from found[np.argsort(-scores, kind="stable")].tolist()


@dataclass
class Packer:
    """Open sequence and finished pieces; a piece is (document, start, length,
    sequence, offset)."""

    window: int
    sequence: int
    filled: int = 0
    pieces: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def put(self, document: int, tokens: int) -> None:
        start = 0
        while start < tokens:
            length = min(tokens - start, self.window - self.filled)
            self.pieces.append((document, start, length, self.sequence, self.filled))
            start += length
            self.filled += length
            if self.filled == self.window:
                self.sequence += 1
                self.filled = 0

    def pack(self, index: Index, tokens: np.ndarray) -> None:
        """Place all documents of a shard; ``tokens`` are their lengths."""
        unused = np.ones(len(tokens), bool)
        following = 0
        while True:
            while following < len(tokens) and not unused[following]:
                following += 1
            if following == len(tokens):
                return
            seed, nearest = following, iter(())
            sequence = -1
            while seed is not None:
                unused[seed] = False
                self.put(seed, int(tokens[seed]))
                if sequence != self.sequence:
                    # The window has a new seed: the document that reaches into it.
                    sequence = self.sequence
                    nearest = index.nearest(seed, unused) if self.filled else iter(())
                seed = next((d for d in nearest if unused[d]), None)

    def cut_rest(self) -> list[tuple[int, int, int, int, int]]:
        """Cut the open sequence into powers of two; returns its new pieces."""
        rest = [p for p in reversed(self.pieces) if p[3] == self.sequence][::-1] if self.filled else []
        self.pieces = [p for p in self.pieces if p[3] != self.sequence] if self.filled else self.pieces
        out, room, offset, sequence = [], 0, 0, self.sequence - 1
        left = self.filled
        for document, start, length, _, _ in rest:
            while length:
                if not room:
                    room = 1 << (left.bit_length() - 1)
                    sequence, offset = sequence + 1, 0
                part = min(length, room)
                out.append((document, start, part, sequence, offset))
                start, length, room, offset, left = start + part, length - part, room - part, offset + part, left - part
        self.sequence, self.filled = sequence + 1, 0
        return out


def tokenised(docs: DataFrame, vocabulary: str, window: int, id_type: str) -> DataFrame:
    """doc_id, text_key, route, and ids as numbers of the numpy type ``id_type``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(vocabulary)
        place = kept_in_process(("token order", vocabulary), lambda: token_order(encoding.max_token_value + 1))
        for batch in batches:
            routes, ids = [], []
            for body in batch.column("text").to_pylist():
                own = encoding.encode_to_numpy(body or "", allowed_special="all")
                routes.append(route(place[own if len(own) <= ROUTE_WINDOWS * window else own[-window:]]))
                ids.append(np.append(own, np.uint32(END)).astype(id_type).tobytes())
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(routes, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "route", "ids"])

    return docs.mapInArrow(run, schema_of(docs.select("doc_id", "text_key"), "route long, ids binary"))


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    A document's tokens are the ids of its text by the byte-level BPE in the
    tokenizers file ``vocabulary``, a path that executors can open, and id 0 at
    the end; added tokens such as ``<|endoftext|>`` in a text have their own ids.
    Returns a row for each piece of a document: doc_id, text_key, start
    and length (in its document's tokens), ids_crc32 (of the ids as unsigned
    little-endian 32-bit numbers), doc_tokens, sequence_id and offset (in the
    sequence, gapless from 0). Every token is in one piece. All sequences are
    full but the last few of each range, whose lengths are powers of two.

    Null and empty texts are one token, id 0. Repeated rows are packed as often
    as they come, rows with a null doc_id too. An empty table gives no rows;
    other columns are not looked at. The result is a table in the shared folder,
    which stays there; that of the ids goes.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    # Ids of common vocabularies need two bytes.
    id_type = "<u2" if tokenizer(vocabulary).max_token_value < 65536 else "<u4"
    with scratch_tables(docs.sparkSession) as keep:
        ids = write_scanned(tokenised(rows, vocabulary, window, id_type), "token-ids").frame
        # Rows of one route are told apart by a hash, so that no range has to hold
        # them all, and their order is the same in a task that is run again.
        place = ["route", F.xxhash64("doc_id", "text_key"), "doc_id", "text_key"]
        ranged = ids.repartitionByRange(*place).sortWithinPartitions(*place)
        written = write_scanned(packed_ranges(ranged, window, id_type), "packed-pieces")
        keep(written.path)
    return written.frame


def packed_ranges(ranged: DataFrame, window: int, id_type: str) -> DataFrame:
    """Pieces of the documents of each partition, which is packed in its order."""
    schema = schema_of(
        ranged.select("doc_id", "text_key"),
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )

    width = np.dtype(id_type).itemsize

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        shard, documents, size = [], 0, 0
        for part in chunks(batches, "ids"):
            shard.append(part)
            documents, size = documents + part[0].num_rows, size + len(part[1]) // width
            if documents >= SHARD_DOCUMENTS or size >= SHARD_TOKENS:
                yield shard
                shard, documents, size = [], 0, 0
        if shard:
            yield shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 33)
        # Columns and tokens of the documents that the open sequence reaches into.
        kept: list[tuple] = []
        for shard in shards(batches):
            every = np.frombuffer(b"".join(data.tobytes() for _, data, _ in shard), id_type)
            tokens = np.concatenate([np.diff(bounds) // width for _, _, bounds in shard])
            ids = np.split(every, np.cumsum(tokens)[:-1])
            document = np.repeat(np.arange(len(tokens)), tokens)
            packer.pack(Index(document, mixed(every.astype(np.uint64)), len(tokens)), tokens)
            columns = [pa.chunked_array([part.column(name) for part, _, _ in shard]) for name in ("doc_id", "text_key")]
            open_ = [p for p in packer.pieces if packer.filled and p[3] == packer.sequence]
            done = [p for p in packer.pieces if not (packer.filled and p[3] == packer.sequence)]
            yield from written(done, columns, ids, kept)
            kept = [carried(p, columns, ids, kept) for p in open_]
            packer.pieces = [(-1 - i, *p[1:]) for i, p in enumerate(open_)]
        yield from written(packer.cut_rest(), [], [], kept)

    def carried(piece: tuple, columns: list, ids: list, kept: list) -> tuple:
        """A piece's document is an index into the shard, or below 0 into ``kept``."""
        document = piece[0]
        return kept[-1 - document] if document < 0 else (columns[0][document], columns[1][document], ids[document])

    def written(pieces: list, columns: list, ids: list, kept: list) -> Iterator[pa.RecordBatch]:
        if not pieces:
            return
        crc, total, names, keys = [], [], [], []
        for piece in pieces:
            name, key, own = carried(piece, columns, ids, kept)
            crc.append(zlib.crc32(own[piece[1] : piece[1] + piece[2]].astype("<u4").tobytes()))
            total.append(len(own))
            names.append(name)
            keys.append(key)
        numbers = np.array([p[1:] for p in pieces], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names), pa.array(keys), pa.array(numbers[:, 0]), pa.array(numbers[:, 1]), pa.array(crc, pa.int64()),
                pa.array(total, pa.int64()), pa.array(numbers[:, 2]), pa.array(numbers[:, 3]),
            ],
            schema.names,
        )

    return ranged.mapInArrow(run, schema)
