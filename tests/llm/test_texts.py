import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from gapmend.llm import texts
from gapmend.llm.texts import (
    ALPHANUMERIC, BYTE_BASE, LOWER, UNSPACED, WORD_BASE, buffers, chunks, run_hashes, words_of,
)
from gapmend.llm.simhash import spaced
from gapmend.llm.substring_dedup import sliding_least
from tests.llm.cases import ODD_TEXTS, item_words, unspaced

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 \t\n\x0b\x0c\r é日.x", max_size=30)), max_size=8)


def split(strings, table, lower=False):
    data, bounds = buffers(pa.array(strings, pa.string()))
    words = words_of(LOWER[data] if lower else data, bounds, table)
    flat = [words.bytes_of(i).decode() for i in range(len(words.starts))]
    return [flat[a:b] for a, b in zip(words.first, words.first[1:])], words


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(strings):
    assert split(strings, UNSPACED)[0] == [unspaced(t) for t in strings]
    assert split(strings, ALPHANUMERIC, True)[0] == [item_words(t) for t in strings]


def test_odd_texts_in_parts_of_a_column():
    column = pa.array(ODD_TEXTS, pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ODD_TEXTS))), column], ["id", "text"])
    got = {}
    for size in (1, 1000, 10**7):
        texts.CHUNK_BYTES, before = size, texts.CHUNK_BYTES
        try:
            for part, data, bounds in chunks([batch.slice(3), batch.slice(0, 3), batch.slice(0, 0)]):
                words = words_of(data, bounds, UNSPACED)
                for row, name in enumerate(part.column("id").to_pylist()):
                    got[name] = [words.bytes_of(i).decode() for i in range(words.first[row], words.first[row + 1])]
        finally:
            texts.CHUNK_BYTES = before
        assert got == {i: unspaced(t) for i, t in enumerate(ODD_TEXTS)}


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(strings):
    found, words = split(strings, UNSPACED)
    flat = [w for own in found for w in own]
    hashes = words.hashes().tolist()
    assert len(dict(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_hashes_of_runs():
    values = np.arange(50, dtype=np.uint64) % np.uint64(7)
    at = np.arange(40)
    found = run_hashes(values, at, at + 10, WORD_BASE)
    assert all((found[i] == found[j]) == (i % 7 == j % 7) for i in range(40) for j in range(40))
    assert run_hashes(values, at, at, BYTE_BASE).tolist() == [0] * 40


def test_words_with_one_space_after_each():
    _, words = split(["a  bb\n", None, "ccc d"], UNSPACED)
    data, begins = spaced(words)
    assert data.tobytes() == b"a bb ccc d " and begins.tolist() == [0, 2, 5, 9, 11]
    assert spaced(split([None], UNSPACED)[1])[0].tobytes() == b""


def test_smallest_of_a_sliding_window():
    values = np.random.default_rng(1).integers(0, 100, 90)
    for size in (1, 2, 3, 7, 28, 90):
        assert sliding_least(values, size).tolist() == [values[i : i + size].min() for i in range(91 - size)]
