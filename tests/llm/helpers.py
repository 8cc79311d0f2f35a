"""Fixtures that hold the hard cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, block string, key string, cls string, n int, rest string, id string"
EMPTY_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def vocabulary(rng: random.Random, n: int = 400) -> list[str]:
    return ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 8))) for _ in range(n)]


def sentence(rng: random.Random, words: list[str], n: int) -> str:
    return "".join(w + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for w in rng.choices(words, k=n))


def hard_docs(spark, seed: int = 3, base: int = 40):
    """(DataFrame, rows as (doc_id, text))."""
    rng = random.Random(seed)
    words = vocabulary(rng)
    texts: list[str | None] = [sentence(rng, words, rng.randint(1, 300)) for _ in range(base)]
    passage = sentence(rng, words, 60)
    texts += [f"{sentence(rng, words, 50)} {passage} {sentence(rng, words, 50)}" for _ in range(6)]  # a shared passage
    original = sentence(rng, words, 200).split()
    for _ in range(30):  # copies with a changed word
        copy = list(original)
        copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(original)] * 30  # exact copies
    texts += [None, None, "", "", " \n\t ", "x", "X", "one two three", "ONE two three", "one two three four", "1234 5678", "a " * 400, "\x00 ▁ ﻿ a b 　",
              "<|endoftext|> <s> </s>", "😀 ①ﬁ é " * 5, "w" * 5000, sentence(rng, words, 12_000), "the same line\n" * 30]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[50], (None, "no id here at all but words"), (None, None)]  # repeated rows, null ids
    full = [(i, t, None if (i or 0) % 7 == 3 else ["aa", "bb"][(i or 0) % 2], None if (i or 0) % 5 == 4 else f"s{(i or 0) % 3}", None, i, "b", None, "c", 1, "r", None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3), rows


def empty_docs(spark):
    return spark.createDataFrame([], EMPTY_SCHEMA)


def bag(rows) -> list:
    return sorted(rows, key=repr)
