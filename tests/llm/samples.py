"""Awkward documents that every operator must take: nulls, empty and very long texts, repeated rows, clashing columns."""

import random

CLASHES = ["row", "fp", "score", "kept", "n_words", "fingerprint", "text_key", "bucket", "ids", "key", "spans", "failed"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def long_text(words=30_000, seed=5):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(words))


TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"), (None, "a text without an id"),
    (None, None), (7, long_text()), (8, "x" * 50_000), (9, long_text(400, 1)), (10, long_text(400, 1)),
    (11, "".join(c.upper() if c.isascii() else c for c in long_text(400, 1))), (12, "Bé\u00a0 naïve 中文 😀 <|endoftext|> 'll  end\r\n\r\n x"), (13, "word " * 500), (14, "one two three"),
]


def awkward(spark, texts=TEXTS):
    rows = [(i, t, "en", "s", None if t is None else len(t), *CLASHES) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def twins(size):
    """Two words that polynomial hashes modulo 2**64 can't tell apart, whatever the base: by the parity of set bits."""
    first = "".join("ab"[k.bit_count() & 1] for k in range(size))
    return [first, first.translate(str.maketrans("ab", "ba"))]
