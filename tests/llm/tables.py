"""Small tables that hold the hard cases: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, words string, key string, marks int"
WORDS = "the and of river harbour winter boats market people storm road bean soil night window door light".split()


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n))


def documents(spark, texts, first_id=1, lang="en"):
    """A documents table with extra columns whose names clash with internal ones."""
    rows = [
        (first_id + i, t, lang, "s", None if t is None else len(t), 7, "w", "k", 3) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def hard_texts() -> list[str | None]:
    passage = prose(1, 80)
    return [
        None, "", " \n\t ", "word", "two words", "a b c d", prose(2, 60), prose(2, 60), passage,
        prose(3, 30) + " " + passage, passage + " " + prose(4, 30), "x" * 900, "ab " * 400, "\x1c\x85\xa0 ſ K É ß 日本 ́e",
        "Chaux. " * 120, "line one here\nline two here\nline one here\n\n", prose(5, 5000), "<|endoftext|> it's <|endoftext|>",
        "É" * 150, prose(6, 90) + " tail", prose(6, 90) + " end",
    ]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
