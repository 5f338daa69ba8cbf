"""BPE merge rounds and token files against the tokenizers library, and random access."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from dialstat.llm import bpe, token_files as T
from dialstat.llm.staging import stage_path
from odd import odd_documents, rows_of

ALPHABET = "aabcdeefghilmnoprstuvwxyzABCDEİÉéèñßüµªº²½0123456789   \n\n\t\r\x85\xa0\x1c\x1f\x0b'''\"\"..,,!?-_()[]{}#€Σς日本語𝔘🎉éǅ́̀\x00"
FIXED = ["", "a", " ", "aaaaaaa", "it's 'stuff  'll we've  \"'s' ''s x''t", " 's a  's\n's", "Hello<|endoftext|> World <|startoftext|>x", "x" * 5000, "ΑΣ ΣΑΣ", "don't\n've 've\n'd", "ab12 3²½ 4", "İstanbul"]


PLANE = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]


def random_texts(seed, count=1500):
    rng = random.Random(seed)
    out = list(FIXED)
    for k in range(count):
        block = rng.randrange(0, len(PLANE) - 256)
        scripts = [PLANE[block : block + 256] + [" "] * 40, rng.choices(PLANE, k=30) + [" ", "'", "s", "\n"]]
        letters = rng.choice([ALPHABET, "ab's tdmrevl 1.\n  ", *scripts])
        out.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))))
    return out


def test_word_ids_and_tokens_match_the_library():
    path = P.path("word_bpe_49k.json")
    library, coder = Tokenizer.from_file(path), bpe.WordEncoder(open(path, encoding="utf-8").read())
    texts = random_texts(1)
    for lo in range(0, len(texts), 400):
        part = texts[lo : lo + 400]
        ids, cuts = coder.encode(part)
        for text, a, b in zip(part, cuts, cuts[1:]):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids[a:b].tolist() == want
            assert coder.decode(ids[a:b]) == library.decode(want, skip_special_tokens=False)


def test_most_scripts_need_no_library():
    from dialstat.llm.pretokens import COMPOSED, SETTLED, code_points, seal_odd_rows

    texts = ["Привет, мир", "你好,世界", "こんにちは", "αβγ", "สวัสดี", "שלום", "مرحبا", "Å", "é", "e\u0301", "𝔘"]
    points, bounds = code_points(texts)
    assert seal_odd_rows(points.copy(), bounds, [False] * 11, SETTLED).tolist() == [True] * 10 + [False]
    composed = seal_odd_rows(points, bounds, [False] * 11, COMPOSED).tolist()
    assert composed[:4] == [True] * 4 and composed[5:7] == [True] * 2 and composed[8:] == [True, False, False]


def test_kept_words_start_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    path = P.path("word_bpe_49k.json")
    library, coder = Tokenizer.from_file(path), bpe.WordEncoder(open(path, encoding="utf-8").read())
    for text in random_texts(2, 60):
        assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_merge_list_out_of_order_is_refused():
    from dialstat.llm.pretokens import byte_characters

    shown = byte_characters()
    vocab = {c: i for i, c in enumerate(shown)} | {"ab": 256, "abc": 257}
    with pytest.raises(ValueError):
        bpe.MergeTable({"vocab": vocab, "merges": [["ab", "c"], ["a", "b"]]})


def test_piece_ids_match_the_library():
    path = P.path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), T.TextEncoder(open(path, encoding="utf-8").read())
    texts = random_texts(3)
    for lo in range(0, len(texts), 400):
        ids, counts = coder.encode(texts[lo : lo + 400])
        for text, own in zip(texts[lo : lo + 400], np.split(ids, np.cumsum(counts)[:-1])):
            assert own.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("top", [1, 200, 70_000, 2**32])
def test_any_token_of_a_container(top):
    rng = np.random.default_rng(top)
    ids = (rng.random(3000) ** 4 * top).astype(np.uint32)
    box = T.Container(memoryview(T.pack_container(3, 9, [4, None], np.array([2000, 1000]), ids)))
    assert (box.part, box.first, box.doc_ids, box.counts.tolist()) == (3, 9, [4, None], [2000, 1000])
    assert [box.token(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
    for a, b in [(0, 3000), (0, 0), (511, 513), (2000, 3000), (2999, 3000), (3000, 3000)]:
        assert box.tokens_between(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        T.Container(memoryview(T.pack_container(3, 9, [4], np.array([5]), ids[:5])[:-1]))


def test_odd_rows_bpe(spark, odd, nothing):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for row in odd_documents():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((row[0], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r.values()) for r in rows_of(bpe.bpe_digests(odd, path))]
    assert sorted(got, key=str) == sorted(want, key=str)
    full = {r["decoded"]: r["ids"] for r in rows_of(bpe.bpe_encode(odd, path))}
    assert full[""] == [] and all(len(v) == len(k.split(" ")) for k, v in full.items() if k)
    assert bpe.bpe_digests(nothing, path).count() == 0 and bpe.bpe_encode(nothing, path).count() == 0


@pytest.mark.parametrize("container_tokens", [1 << 20, 500])
def test_odd_rows_files(spark, odd, nothing, container_tokens):
    path = P.path("byte_bpe_50k.json")
    library, out = Tokenizer.from_file(path), stage_path(spark, "files")
    T.write_token_files(odd, out, path, container_tokens=container_tokens)
    got = rows_of(T.read_token_files(spark, out))
    rows = sorted(odd_documents(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, zlib.crc32((r[1] or "").encode())))
    start, want = 0, []
    for row in rows:
        ids = [*library.encode(row[1] or "", add_special_tokens=False).ids, 0]
        want.append((row[0], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r.values()) for r in got), key=lambda r: r[1]) == want
    empty = stage_path(spark, "files")
    T.write_token_files(nothing, empty, path)
    assert T.read_token_files(spark, empty).count() == 0
