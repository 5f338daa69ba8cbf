"""The vectorised word scanner and piece splitter against plain Python."""

import random
import re
import string

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from dialstat.llm import bytescan as B
from dialstat.llm.pretokens import SETTLED, KeyNumbers, PieceTable, code_points, joined_lines, seal_odd_rows

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TEXTS = st.lists(st.text(alphabet="aBcé ß\t\n\x0b\x85\x1f'-.0日", max_size=40), max_size=8)


def split(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_hashes(texts, limit):
    for is_word, pattern in ((B.SPACED, r"[^\x20\x09-\x0D]+"), (B.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        rows, hashes = [], {}
        for lo, hi, raw, bounds in B.chunks(pa.array(texts, pa.string()), limit):
            low = B.LOWER[raw]
            starts, ends, at = B.word_spans(low, bounds, is_word)
            values = B.span_hashes(low, starts, ends)
            for a, b in zip(at, at[1:]):
                rows.append([low[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])])
            for s, e, h in zip(starts, ends, values.tolist()):
                assert hashes.setdefault(low[s:e].tobytes(), h) == h
        assert rows == [split(t, pattern) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_null_texts_and_slices():
    column = pa.array(["skip", None, "a b", ""], pa.string()).slice(1)
    (piece,) = B.chunks(column)
    assert piece[:2] == (0, 3) and piece[3].tolist() == [0, 0, 3, 3]
    assert list(B.chunks(pa.array([], pa.string()))) == []


def test_gram_hashes_depend_on_order():
    words = np.array([1, 2, 3, 1, 2, 3, 2, 1], dtype=np.uint64)
    grams = B.gram_hashes(words, 3)
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 5


def test_piece_numbers_survive_batches():
    from dialstat.llm.pretokens import split_blank_prefixed

    table, names = PieceTable(), []
    rng = random.Random(4)
    for _ in range(5):
        texts = ["".join(rng.choice("ab' \ns1") for _ in range(rng.randrange(30))) for _ in range(9)]
        points, bounds = code_points(texts)
        assert seal_odd_rows(points, bounds, [False] * 9, SETTLED).all()
        begin, end = split_blank_prefixed(points)
        numbers, new = table.number(points, begin, end)
        names += [joined_lines(points, begin[[k]], end[[k]])[0][:-1] for k in new]
        joined = "\x00".join(texts) + "\x00"
        assert [names[n] for n in numbers] == [joined[a:b] for a, b in zip(begin, end)]
    assert len(set(names)) == len(names)
    assert joined_lines(np.zeros(0, np.uint32), np.zeros(0, int), np.zeros(0, int))[0] == ""


def test_key_numbers_grow_and_keep_their_numbers():
    rng, table, known = np.random.default_rng(1), KeyNumbers(bits=3), {}
    for _ in range(40):
        keys = np.unique(np.concatenate([rng.integers(1, 2**64, 50, dtype=np.uint64), rng.integers(1, 30, 5, dtype=np.uint64)]))
        found = table.find(keys)
        assert found.tolist() == [known.get(k, -1) for k in keys.tolist()]
        new = keys[found < 0]
        known.update(zip(new.tolist(), table.add(new).tolist()))
    assert sorted(known.values()) == list(range(len(known))) and table.size == len(known)
