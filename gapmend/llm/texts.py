"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts are cut into words without a Python object for each word: a table says
which bytes belong to words, and words and runs of words are hashed with
polynomials modulo 2^64, whose prefix sums give the hash of any run.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from gapmend.shared import Written, session_conf, write_shared

# Bytes of text that are held as arrays at once; a longer text is taken alone.
CHUNK_BYTES = 1 << 18

BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
PRIME = 2**31 - 1
PRIME_BASE = 1_000_003_007 % PRIME
SPACES = b" \t\n\x0b\x0c\r"


def byte_table(inside: Callable[[int], bool]) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


# Bytes of words: all but white space; ASCII letters and digits and all else
# that is not ASCII.
UNSPACED = byte_table(lambda b: b not in SPACES)
ALPHANUMERIC = byte_table(lambda b: b >= 128 or chr(b).isalnum())
# Bytes with A-Z in lower case.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit hashes; each seed gives another hash."""
    h = h + np.uint64((seed * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % 2**64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA3B195354A39B70D)
    h ^= h >> np.uint64(32)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_known_powers: dict[int, np.ndarray] = {}
_prime_tables: dict[int, np.ndarray] = {}


def known_powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers 0 to n of ``base``, kept between calls up to a chunk's size."""
    have = _known_powers.get(int(base))
    if have is None or len(have) <= n:
        have = powers(base, n)
        if n <= 2 * CHUNK_BYTES:
            have = _known_powers[int(base)] = powers(base, 2 * CHUNK_BYTES)
    return have[: n + 1]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """The hash of each run ``values[start:end]``; equal runs have equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * known_powers(base, n)[:n], out=sums[1:])
    inverse = np.uint64(pow(int(base), -1, 2**64))
    return (sums[ends] - sums[starts]) * known_powers(inverse, n)[starts]


def prime_powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to n of ``base`` modulo ``PRIME``."""
    out, done = np.ones(n + 1, np.uint64), 1
    while done <= n:
        more = min(done, n + 1 - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, PRIME)) % np.uint64(PRIME)
        done += more
    return out


def prime_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As :func:`run_hashes`, modulo a prime and so in 31 bits."""
    n, prime = len(values), np.uint64(PRIME)
    bases = PRIME_BASE, pow(PRIME_BASE, -1, PRIME)
    rising, falling = (_prime_tables.get(b) for b in bases)
    if rising is None or len(rising) <= n:
        rising, falling = (prime_powers(b, max(n, 2 * CHUNK_BYTES)) for b in bases)
        if n <= 2 * CHUNK_BYTES:
            _prime_tables.update(zip(bases, (rising, falling)))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * rising[:n] % prime, out=sums[1:])
    return (sums[ends] - sums[starts]) % prime * falling[starts] % prime


@dataclass
class Words:
    """The words of some texts: byte range and text of each, in order."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # The words of text t are first[t] to first[t + 1].
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """Words whose bytes differ in a pattern that a polynomial modulo 2^64
        does not see (Thue-Morse) are told apart by one modulo a prime."""
        values = self.data.astype(np.uint64) + np.uint64(1)
        first = run_hashes(values, self.starts, self.ends, BYTE_BASE)
        return mixed(first + mixed(prime_hashes(values, self.starts, self.ends), 1))

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and where each value begins; nulls are empty."""
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Words:
    """Words never reach over the end of a text."""
    inside = table[data]
    n = len(data)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, bounds))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches of up to ``CHUNK_BYTES``, with bytes and bounds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = buffers(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            part = bounds[row : end + 1]
            yield batch.slice(row, end - row), data[part[0] : part[-1]], part - part[0]
            row = end


def write_scanned(df: DataFrame, label: str) -> Written:
    """Write what a Python function makes of texts, which then come to it in
    batches of a few megabytes, however long they are."""
    limits = {"maxRecordsPerBatch": "1000", "maxBytesPerBatch": str(8 << 20)}
    with session_conf(df.sparkSession, {f"spark.sql.execution.arrow.{k}": v for k, v in limits.items()}):
        return write_shared(df, label)


def fields(record: Any) -> tuple:
    """The fields of a dataclass instance, for a broadcast: its class would be
    looked up by name on executors, which need not have this package."""
    return tuple(vars(record).values())


def kept_in_process(name: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in each Python process. Functions that
    run in tasks are sent anew with each of them, so what they keep is kept
    outside of them, where nothing is sent along."""
    store = sys.modules.setdefault("gapmend_kept", types.ModuleType("gapmend_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def text_key(text: str | Column = "text") -> Column:
    """A 64-bit hash that tells the texts of one doc_id apart; null has its own."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.lit("key"), column)


def schema_of(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` and the columns of a DDL string."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)
