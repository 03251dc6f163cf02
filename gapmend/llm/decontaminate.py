"""Find benchmark passages in documents by winnowing.

Of every window of consecutive word k-grams the one of smallest hash is kept as
a fingerprint. A span shared by document and item holds a whole window as soon
as it is ``k + window - 1`` words long, so both sides keep the same k-gram of
it: no shared span of that length can be missed. Fingerprints of documents are
joined with those of the items, and each hit is extended word by word to the
spans it stands for. Items shorter than a span keep one hash of all their words,
and every run of that length in a document is looked up.

Before the join, documents drop the fingerprints that no item has, by a bitmap
of fixed size, whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gapmend.llm.texts import (
    ALPHANUMERIC, LOWER, WORD_BASE, Words, chunks, mixed, run_hashes, schema_of, text_key, words_of, write_scanned,
)
from gapmend.shared import write_shared

# A shared span of this many words is found.
SPAN = 13
GRAM = 7
# The bitmap has 2^26 bits, 8 MB.
BITMAP_BITS = 26

FINGERPRINT = "struct<span:int,pos:long,hash:long,lead:int,words:array<string>>"


def gram_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of the ``size`` words from each word on, as far as they go."""
    at = np.arange(max(len(hashes) - size + 1, 0))
    return mixed(run_hashes(hashes, at, at + size, WORD_BASE), seed)


def winnowed(words: Words, hashes: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of first words) and hashes of the fingerprints of all texts."""
    grams = gram_hashes(hashes, gram, span)
    window = span - gram + 1
    ends = np.repeat(words.first[1:], words.counts())
    starts = np.arange(max(len(grams) - window + 1, 0))
    least, place = grams[: len(starts)].copy(), starts.copy()
    for step in range(1, window):
        later = grams[step : step + len(starts)]
        lower = later <= least
        least[lower] = later[lower]
        place[lower] = starts[lower] + step
    # Windows that reach over the end of their text do not count.
    place = place[starts + span <= ends[: len(starts)]]
    place = place[np.concatenate(([True], place[1:] != place[:-1]))] if len(place) else place
    return place, grams[place]


def shorter(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``size`` words and its hash."""
    grams = gram_hashes(hashes, size, size)
    at = np.arange(len(grams))
    inside = at + size <= np.repeat(words.first[1:], words.counts())[: len(grams)]
    return at[inside], grams[inside]


def _fingerprint_rows(words: Words, span: int, places: np.ndarray, hashes: np.ndarray) -> list[list[dict]]:
    """Fingerprints by text, with the words that a span around them can have."""
    counts = words.counts()
    found: list[list[dict]] = [[] for _ in counts]
    text = np.searchsorted(words.first, places, side="right") - 1
    for at, hashed, t in zip(places.tolist(), hashes.view(np.int64).tolist(), text.tolist()):
        before = SPAN - GRAM if span == SPAN else 0
        begin = max(at - before, int(words.first[t]))
        end = min(at + span, int(words.first[t + 1]))
        around = [words.bytes_of(i).decode() for i in range(begin, end)]
        found[t].append({"span": span, "pos": at - int(words.first[t]), "hash": hashed, "lead": at - begin, "words": around})
    return found


def item_fingerprints(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """item_id and its fingerprints. Items without words have none."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    schema = schema_of(rows.select("item_id"), f"prints array<{FINGERPRINT}>")
    kind = _arrow_type()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            words = words_of(LOWER[data], bounds, ALPHANUMERIC)
            hashes, counts = words.hashes(), words.counts()
            found = _fingerprint_rows(words, SPAN, *winnowed(words, hashes))
            for size in set(counts[counts < SPAN].tolist()) - {0}:
                places, hashed = shorter(words, hashes, size)
                whole = np.isin(places, words.first[:-1][counts == size])
                for have, more in zip(found, _fingerprint_rows(words, size, places[whole], hashed[whole])):
                    have += more
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(found, kind)], ["item_id", "prints"])

    found = rows.mapInArrow(scan, schema)
    return found.select("item_id", F.explode("prints").alias("p")).select("item_id", "p.*")


def _arrow_type() -> pa.DataType:
    return pa.list_(pa.struct([
        ("span", pa.int32()), ("pos", pa.int64()), ("hash", pa.int64()), ("lead", pa.int32()), ("words", pa.list_(pa.string())),
    ]))


def bitmap(prints: DataFrame) -> np.ndarray:
    """One bit for the leading bits of each hash; its size does not depend on
    the number of fingerprints, and it comes as at most 2^20 rows."""
    bit = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    parts = prints.groupBy(F.shiftright(bit, 6).alias("at")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 as int)))").alias("bits")
    )
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for at, bits in parts.collect():
        out[at] = bits
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def document_fingerprints(docs: DataFrame, prints: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A row for each document: words, and the fingerprints that items may have."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(bitmap(prints))
    # At most SPAN - 1 lengths.
    sizes = sorted(r[0] for r in prints.filter(F.col("span") < SPAN).select("span").distinct().collect())
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    schema = schema_of(rows.select("doc_id", "text_key"), f"row long, n_words long, prints array<{FINGERPRINT}>")
    kind = _arrow_type()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for part, data, bounds in chunks(batches):
            words = words_of(LOWER[data], bounds, ALPHANUMERIC)
            hashes = words.hashes()
            found: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for size in (*sizes, SPAN):
                places, hashed = (winnowed if size == SPAN else lambda w, h, n=size: shorter(w, h, n))(words, hashes)
                hit = in_bitmap(known.value, hashed)
                for have, more in zip(found, _fingerprint_rows(words, size, places[hit], hashed[hit])):
                    have += more
            ids = np.arange(row, row + part.num_rows)
            row += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(ids), pa.array(words.counts().astype(np.int64)), pa.array(found, kind)],
                ["doc_id", "text_key", "row", "n_words", "prints"],
            )

    return rows.mapInArrow(scan, schema)


def shared_spans(scanned: DataFrame, prints: DataFrame) -> DataFrame:
    """row, start, span and item_id of every window of an item in a document.

    A hit of two fingerprints is extended: each window of ``span`` words that
    holds them on both sides and has the same words is a shared span.
    """
    mine = scanned.select("row", F.explode("prints").alias("p")).select(
        "row", "p.hash", "p.span", "p.pos", F.col("p.lead").alias("lead"), F.col("p.words").alias("words")
    )
    theirs = prints.select("hash", "span", "item_id", F.col("lead").alias("item_lead"), F.col("words").alias("item_words"))
    hits = mine.join(theirs, ["hash", "span"])
    starts = F.expr(
        "filter(sequence(-least(lead, item_lead), 0), s -> lead + s + span <= size(words)"
        " and item_lead + s + span <= size(item_words)"
        " and slice(words, lead + s + 1, span) = slice(item_words, item_lead + s + 1, span))"
    )
    spans = hits.select("row", "pos", "span", "item_id", F.explode(starts).alias("s"))
    return spans.select("row", (F.col("pos") + F.col("s")).alias("start"), "span", "item_id").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """How much of each document stands in benchmark items.

    Words are runs of ASCII letters and digits and of all other characters,
    A-Z in lower case. A word is hit if a window of 13 words of an item, or the
    whole of an item of fewer, covers it. Returns a row for each row of
    ``docs``: doc_id, text_key, n_words, n_hit, n_items, item_ids (sorted as
    strings) and contaminated: a twentieth of the words is hit.

    Null and empty texts have no words and are not contaminated; items without
    words match nothing. Repeated rows are judged each, items of equal text are
    all named, a null item_id counts for the words but is not named. Without
    items nothing is hit. Other columns are not looked at.
    """
    prints = write_shared(item_fingerprints(items, text, item_id), "winnow-items").frame
    scanned = write_scanned(document_fingerprints(docs, prints, text, doc_id), "winnow-documents").frame
    spans = write_shared(shared_spans(scanned, prints), "winnow-spans").frame
    named = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    place = Window.partitionBy("row").orderBy("start")
    reach = spans.groupBy("row", "start").agg((F.col("start") + F.max("span")).alias("end"))
    earlier = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    fresh = reach.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(earlier, F.lit(0)))))
    hit = fresh.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    judged = scanned.drop("prints").join(hit, "row", "left").join(named, "row", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
    return judged.select(
        "doc_id", "text_key", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), "item_ids",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
