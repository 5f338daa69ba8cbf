"""A documents table of odd rows, shared by the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, key long, row long, label string, n long, words string"


def words(count, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randrange(400)) for _ in range(count))


def odd_documents():
    long_text = words(30_000, 1)
    base = words(300, 2)
    texts = [
        (1, base, "en", "a"),
        (2, base + " one more", "en", "a"),  # a near copy
        (3, base, "en", "a"),  # an exact copy
        (4, None, "en", None),
        (5, "", None, "a"),
        (6, " \t\n\r\x0b\x0c ", "de", "b"),
        (7, "word", "de", "b"),
        (8, "two words", "de", "b"),
        (9, "12 34 !? 56", "fr", "b"),
        (10, long_text, "en", "a"),
        (11, "x" * 200_000, "en", "a"),  # one very long word
        (12, "Ünïcödé Straße 日本語 テキスト 😀 é " * 20, "ja", None),
        (13, "<|endoftext|> and <|startoftext|> in a text", "en", "a"),
        (14, "same line\nsame line\n\nsame line\r\n" * 30, "en", "a"),
        (None, words(80, 3), "en", "a"),
        (None, None, None, None),
        (15, words(80, 4), "en", "a"),
        (15, words(80, 4), "en", "a"),  # a repeated row
        (15, words(80, 5), "en", "a"),  # the id again, with another text
        (16, "a\x00b\x1fc d\x85e f\xa0g", "en", "a"),
    ]
    return [(i, t, l, s, None if t is None else len(t), "n", 0, 7, "l", 1, "w") for i, t, l, s in texts]


def rows_of(df):
    return [r.asDict() for r in df.collect()]
