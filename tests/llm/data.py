"""A small table of awkward documents, shared by the tests of the operators."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words long, kept string, shard int, starts string, lines string, epoch string, runs string"
)


def documents() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows; clashing extra columns."""
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdeéñß", k=dice.randint(1, 7))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(dice.choices(words, k=n))

    passage = "\n".join(prose(8) for _ in range(4))
    base = prose(120)
    texts = [None, "", " \t\n ", "\n\n\n\n", "one", "a b c d", prose(9), prose(10), prose(2000)]
    texts += [prose(dice.randint(5, 80)) + "\n" + passage + "\n" + prose(7) for _ in range(6)]
    texts += [base, base.upper(), base + " tail", base, base.replace(" ", "  ")]
    texts += ["\n".join(["same line here"] * 9), "a b c d e f " * 30, "x" * 5000, "😀 ça va bien " * 12]
    texts += [prose(60).replace(" ", " # ", 30), "A\nB\nC\nA\nB\nC\nD", passage, passage]
    texts += [prose(dice.randint(1, 60)) for _ in range(25)]
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 7 == 3 else f"src{min(i % 5, 2)}"
        rows.append((i * 3, text, "en", source, None if i % 11 == 5 else len(text or "")) + (i, "x", 7, "s", None, "e", None))
    rows += [rows[10], rows[10], rows[0], (None, base) + (None,) * 10]
    rows += [(None, None, None, "src9", 0, 1, "", 1, "", "", "", "")] * 2
    return rows


def frame(spark, rows=None):
    """``rows``, filled up with nulls, or the table above."""
    width = SCHEMA.count(",") + 1
    given = documents() if rows is None else rows
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in given], SCHEMA)
