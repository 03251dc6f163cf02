"""Remove passages that stand in more than one place, by suffix automata.

A window is a number of consecutive words. Each window belongs to the smallest
hash of the word 8-grams in it, its minimizer, and consecutive windows with the
same minimizer make a span. All places of a window have the same minimizer, so
the spans of one minimizer can be judged by themselves:

- If a minimizer's 8-gram comes once in the corpus, no window with it is
  repeated. This leaves out most of a corpus before any words are moved.
- Of spans with the same words, each window of each is repeated.
- The different spans of a minimizer are the reference of one suffix automaton,
  whose states know how often their words occur. The spans are streamed through
  it, and where the last words of a window occur twice the window is repeated.

An automaton of the whole corpus, or one for each shard of it that every
document meets, would have to reach every executor; here each is built where
the spans of its minimizer meet, and is dropped after them. A minimizer with so
many different spans that an automaton would be too large, as at the edges of a
passage that many documents share, has its windows counted by hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gapmend.llm.simhash import spaced
from gapmend.llm.texts import (
    UNSPACED, WORD_BASE, Words, chunks, mixed, run_hashes, schema_of, text_key, words_of, write_scanned,
)
from gapmend.shared import scratch_tables, write_shared

GRAM = 8
OTHER_BASE = np.uint64(0x165667B19E3779F9)
# Words in the different spans of one automaton; beyond it windows are counted.
AUTOMATON_WORDS = 50_000


class Automaton:
    """A suffix automaton of several sequences, which counts their substrings."""

    def __init__(self) -> None:
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, at: int, by: int, word: int) -> int:
        """A state for the shorter strings of ``at``, reached from ``by``."""
        half = self._state(self.length[by] + 1, dict(self.step[at]), self.link[at])
        self.link[at] = half
        while by >= 0 and self.step[by].get(word) == at:
            self.step[by][word] = half
            by = self.link[by]
        return half

    def add(self, words: list[int], times: int) -> None:
        last = 0
        for word in words:
            known = self.step[last].get(word)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(known, last, word)
            else:
                new, by = self._state(self.length[last] + 1, {}, 0), last
                while by >= 0 and word not in self.step[by]:
                    self.step[by][word] = new
                    by = self.link[by]
                if by >= 0:
                    known = self.step[by][word]
                    self.link[new] = known if self.length[known] == self.length[by] + 1 else self._split(known, by, word)
                last = new
            self.count[last] += times

    def sum_up(self) -> None:
        """Give every state the number of places of its strings."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[int], size: int) -> list[int]:
        """Starts of the windows of ``size`` words that occur twice: where the
        longest match ending at a word is long enough, cut to the window."""
        found, state, match = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in self.step[state]:
                state = self.link[state]
                match = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                match += 1
            while self.length[self.link[state]] >= size and state:
                state = self.link[state]
                match = self.length[state]
            if match >= size and self.count[state] > 1:
                found.append(i - size + 1)
        return found


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` consecutive values."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def spans_of(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """First word, windows and minimizer of each span of all texts, and whether
    the minimizer's words come more than once in it."""
    n = len(hashes)
    if n < size:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    at = np.arange(n - GRAM + 1)
    grams = mixed(run_hashes(hashes, at, at + GRAM, WORD_BASE), 3)
    width = size - GRAM + 1
    least = sliding_least(grams, width)
    starts = np.arange(len(least))
    text = words.text_of_word()
    whole = starts + size <= words.first[1:][text[: len(starts)]]
    starts = starts[whole]
    least, text = least[whole], text[starts]
    if not len(starts):
        return starts, starts, least, whole[:0]
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])))
    firsts = np.flatnonzero(new)
    first, windows, least = starts[firsts], np.diff(np.append(firsts, len(starts))), least[firsts]
    times = np.zeros(len(first), np.int32)
    for step in range(2 * width - 1):
        # A gram that stands once is in at most ``width`` windows.
        times += (step < windows + width - 1) & (grams[np.minimum(first + step, len(grams) - 1)] == least)
    return first, windows, least, (times > 1) | (windows > width)


def span_table(docs: DataFrame, size: int) -> DataFrame:
    """The spans of all documents: minimizer, a 128-bit hash of the words, place."""
    schema = schema_of(docs.select("doc_id", "text_key"), "start int, windows int, least long, many boolean, a long, b long")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            words = words_of(data, bounds, UNSPACED)
            hashes = words.hashes()
            first, windows, least, many = spans_of(words, hashes, size)
            end = first + windows + size - 1
            text = np.searchsorted(words.first, first, side="right") - 1
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(take), part.column("text_key").take(take),
                    pa.array((first - words.first[text]).astype(np.int32)), pa.array(windows.astype(np.int32)),
                    pa.array(least.view(np.int64)), pa.array(many),
                    pa.array(mixed(run_hashes(hashes, first, end, WORD_BASE), 1).view(np.int64)),
                    pa.array(mixed(run_hashes(mixed(hashes, 2), first, end, OTHER_BASE), 2).view(np.int64)),
                ],
                schema.names,
            )

    return docs.mapInArrow(scan, schema)


def with_words(docs: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """Add the hashed words of each span, read from its document."""
    wanted = spans.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("least", "times", "start", "windows", "large")).alias("spans")
    ).withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    rows = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))).drop("d", "k")
    schema = schema_of(
        docs.select("doc_id", "text_key"),
        "least long, times long, start int, windows int, large boolean, words array<long>",
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            words = words_of(data, bounds, UNSPACED)
            hashes = words.hashes().view(np.int64)
            lists = part.column("spans")
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            text = np.repeat(np.arange(part.num_rows), counts)
            take = pa.array(text)
            begin = words.first[text] + flat.field("start").to_numpy()
            sizes = flat.field("windows").to_numpy() + size - 1
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(take), part.column("text_key").take(take),
                    *(flat.field(name) for name in ("least", "times", "start", "windows", "large")),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes[at])),
                ],
                schema.names,
            )

    return rows.mapInArrow(scan, schema)


def by_automaton(spans: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, start and end of the repeated windows of each span."""
    schema = schema_of(spans.select("doc_id", "text_key"), "start int, end int")
    names = schema.names

    def judge(group: list[dict]) -> Iterator[dict]:
        automaton = Automaton()
        for row in group:
            automaton.add(row["words"], row["times"])
        automaton.sum_up()
        for row in group:
            for at in automaton.repeated(row["words"], size) if row["times"] == 1 else ():
                start = row["start"] + at
                yield {"doc_id": row["doc_id"], "text_key": row["text_key"], "start": start, "end": start + size}

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(n).type for n in names[:2]] + [pa.int32()] * 2
            found = []
            for row in batch.to_pylist():
                if group and group[0]["least"] != row["least"]:
                    found += judge(group)
                    group = []
                group.append(row)
            yield pa.RecordBatch.from_pylist(found, pa.schema(list(zip(names, kinds))))
        if group:
            yield pa.RecordBatch.from_pylist(list(judge(group)), pa.schema(list(zip(names, kinds))))

    sorted_spans = spans.repartition("least").sortWithinPartitions("least")
    return sorted_spans.mapInArrow(stream, schema)


def by_count(spans: DataFrame, size: int) -> DataFrame:
    """The same for spans of minimizers with too many of them."""
    schema = schema_of(spans.select("doc_id", "text_key", "times"), "start int, a long, b long")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            hashes = lists.values.to_numpy().view(np.uint64)
            counts = np.diff(bounds) - size + 1
            before = np.concatenate(([0], np.cumsum(counts)))
            offset = np.arange(before[-1]) - np.repeat(before[:-1], counts)
            at = offset + np.repeat(bounds[:-1], counts)
            row = np.repeat(np.arange(batch.num_rows), counts)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take), batch.column("text_key").take(take), batch.column("times").take(take),
                    pa.array((offset + batch.column("start").to_numpy()[row]).astype(np.int32)),
                    pa.array(mixed(run_hashes(hashes, at, at + size, WORD_BASE), 1).view(np.int64)),
                    pa.array(mixed(run_hashes(mixed(hashes, 2), at, at + size, OTHER_BASE), 2).view(np.int64)),
                ],
                schema.names,
            )

    each = spans.mapInArrow(windows, schema)
    often = each.groupBy("a", "b").agg(F.sum("times").alias("all")).filter("all > 1").select("a", "b")
    # Written, so that Spark can split the places of a hot window in the join.
    often = write_shared(often, "repeated-windows").frame
    found = each.filter("times = 1").join(often, ["a", "b"])
    return found.select("doc_id", "text_key", "start", (F.col("start") + size).alias("end"))


def merged(ranges: DataFrame) -> DataFrame:
    """For each document the words to remove, as ranges that do not touch."""
    # Fewer rows first: of ranges with the same start the longest.
    ranges = ranges.groupBy("doc_id", "text_key", "start").agg(F.max("end").alias("end"))
    document = Window.partitionBy("doc_id", "text_key").orderBy("start")
    reach = F.max("end").over(document.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")
    runs = ranges.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(document))
    joined = runs.groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))


def without(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """n_words, n_removed and the kept words of each document."""
    named = ranges.withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    rows = docs.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    rows = rows.select(
        "doc_id", "text_key", "text",
        F.coalesce(F.transform("ranges", lambda r: r["start"]), F.array().cast("array<int>")).alias("starts"),
        F.coalesce(F.transform("ranges", lambda r: r["end"]), F.array().cast("array<int>")).alias("ends"),
    )
    schema = schema_of(docs.select("doc_id", "text_key"), "n_words long, n_removed long, kept string")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            words = words_of(data, bounds, UNSPACED)
            change = np.zeros(len(words.starts) + 1, np.int32)
            lists = part.column("starts")
            text = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            np.add.at(change, words.first[text] + lists.flatten().to_numpy(), 1)
            np.add.at(change, words.first[text] + part.column("ends").flatten().to_numpy(), -1)
            stay = np.cumsum(change[:-1]) == 0
            kept = Words(
                data, words.starts[stay], words.ends[stay],
                np.concatenate(([0], np.cumsum(stay)))[words.first],
            )
            joined, begins = spaced(kept)
            # Without the space after the last word of each text.
            last = begins[kept.first[1:][kept.counts() > 0]] - 1
            size = np.diff(begins[kept.first])
            joined = np.delete(joined, last)
            offsets = np.concatenate(([0], np.cumsum(np.maximum(size - 1, 0)))).astype(np.int32)
            texts = pa.StringArray.from_buffers(part.num_rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(joined.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("text_key"), pa.array(words.counts().astype(np.int64)),
                    pa.array((words.counts() - kept.counts()).astype(np.int64)), texts,
                ],
                schema.names,
            )

    return rows.mapInArrow(scan, schema)


def substring_dedup(docs: DataFrame, size: int = 35, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Remove every word of each window of ``size`` words that starts elsewhere too.

    Words are separated by ASCII white space and left as they are. All places
    of a repeated window lose it, the first included, in the same document or
    another; windows are those of the input. Returns a row for each row of
    ``docs``: doc_id, text_key, n_words, n_removed and kept, the kept words
    joined by one space.

    Null and empty texts and texts of fewer words than a window lose nothing; a
    null text keeps the empty text. Rows are documents: a repeated row repeats
    all its windows. Null doc_ids are told apart by their texts. An empty table
    gives no rows; other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    with scratch_tables(docs.sparkSession) as keep:
        spans = write_scanned(span_table(rows, size), "spans")
        times = F.count(F.lit(1)) + F.max(F.col("many").cast("int"))
        often = spans.frame.groupBy("least").agg(times.alias("n")).filter("n > 1").select("least")
        # Written, here and below, so that Spark can split a hot minimizer in the joins.
        often = write_shared(often, "repeated-minimizers").frame
        found = write_shared(spans.frame.join(often, "least"), "repeated-spans").frame
        spans.drop()
        place = F.struct("doc_id", "text_key", "start", "windows")
        different = found.groupBy("least", "many", "a", "b").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("at"))
        different = write_shared(different.select("least", "many", "a", "b", "times", "at.*"), "different-spans").frame
        # Spans that come more than once are repeated as a whole.
        whole = different.filter("times > 1").select("least", "a", "b")
        ranges = found.join(whole, ["least", "a", "b"]).select(
            "doc_id", "text_key", "start", (F.col("start") + F.col("windows") + (size - 1)).alias("end")
        )
        width = F.sum(F.col("windows") + (size - 1))
        several = (
            different.groupBy("least").agg(times.alias("n"), width.alias("width")).filter("n > 1")
            .select("least", (F.col("width") > AUTOMATON_WORDS).alias("large"))
        )
        several = write_shared(several, "minimizers-of-several").frame
        judged = with_words(rows, different.drop("many").join(several, "least"), size)
        judged = write_scanned(judged, "span-words").frame
        ranges = ranges.unionByName(by_automaton(judged.filter("not large"), size)).unionByName(
            by_count(judged.filter("large"), size)
        )
        words = write_shared(merged(ranges), "repeated-words")
        keep(words.path)
    return without(rows, words.frame)
