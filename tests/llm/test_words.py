import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from peerlens.llm.words import distinct_windows, texts_of, windows
from tests.llm.conftest import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x85é日 z", max_size=40)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_windows_agree_with_plain_python(given_texts, block):
    column = pa.array(given_texts, pa.string())
    found = [None] * len(given_texts)
    seen = {}
    for texts in texts_of(column, block_bytes=block):
        hashes = texts.word_hash()
        h, first = distinct_windows(texts, 3)
        for row in range(texts.rows):
            a, b = texts.first[row], texts.first[row + 1]
            cut = [texts.data[s:e].tobytes() for s, e in zip(texts.starts[a:b], texts.ends[a:b])]
            found[texts.row + row] = cut
            for word, x in zip(cut, hashes[a:b]):
                assert seen.setdefault(word, x) == x
            grams = {tuple(cut[i : i + 3]) for i in range(len(cut) - 2)} if len(cut) >= 3 else {tuple(cut)} - {()}
            assert first[row + 1] - first[row] == len(grams)
    assert found == [words(t) for t in given_texts]
    assert len(set(map(int, seen.values()))) == len(seen)


def test_short_texts_have_one_window():
    first = np.array([0, 2, 2, 5])
    h, owner = windows(np.arange(5, dtype=np.uint64), first, 5)
    assert sorted(owner.tolist()) == [0, 2]


def test_slices_of_arrays_start_where_they_should():
    column = pa.array(["a b", "c", "d e f"]).slice(1)
    assert [t.counts().tolist() for t in texts_of(column)] == [[1, 3]]
