import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from blockweave.llm import ragged

TEXT = st.one_of(st.none(), st.text(alphabet="aB \n\té中😀\x1c ", max_size=30))


def split(text):
    out = [""]
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=12), st.integers(1, 60), st.integers(0, 3))
def test_words_and_shingles(texts, limit, skip):
    batch = pa.record_batch({"t": pa.array([None] * skip + texts, pa.string())}).slice(skip)
    sizes, sets = [], []
    for _, flat, off in ragged.chunks(batch, "t", limit):
        hashes, rows = ragged.word_hashes(flat, off)
        sizes += np.diff(rows).tolist()
        value, cuts = ragged.shingle_sets(flat, off, 2)
        sets += [value[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
    assert sizes == [len(split(t)) for t in texts]
    key = lambda w: tuple(x.translate({66: 98}) for x in w)
    for t, s in zip(texts, sets):
        w = split(t)
        want = {key(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {key(w)} if w else set()
        assert len(s) == len(want)
    for a, x in zip(texts, sets):
        for b, y in zip(texts, sets):
            if [key([w])[0] for w in split(a)] == [key([w])[0] for w in split(b)]:
                assert x == y


def test_equal_bytes_have_equal_hashes_anywhere():
    data = np.frombuffer(b"abcabcab" * 100, np.uint8)
    prefix = ragged.prefix_hash(data)
    at = np.arange(0, 700, 8)
    assert len(set(ragged.range_hash(prefix, at, at + 50).tolist())) == 1
    assert len(set(ragged.range_hash(prefix, np.arange(8), np.arange(8) + 50).tolist())) == 8  # abcabcab has no shorter period
