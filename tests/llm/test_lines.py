from __future__ import annotations

import re
from collections import Counter

from tests.llm.data import documents, frame
from tidemark.llm import lines
from tidemark.llm.jobs import LINES_SQL


def plain(rows):
    def key(row):
        return (row[0] is None, row[0] or 0, row[1])

    seen, out = {}, {}
    split = {(r[0], r[1]): (r[1] or "").split("\n") if r[1] is not None else [] for r in rows}
    for (doc, text), ls in split.items():
        for i in range(len(ls) - 2):
            w = tuple(ls[i : i + 3])
            if re.search(r"[^\x20\x09-\x0D]", "".join(w)):
                seen.setdefault(w, []).append(((doc is None, doc or 0), doc, text, i))
    gone = {}
    for places in seen.values():
        # Texts under one id are ordered by hash in the operator; the fixture has none.
        places.sort(key=lambda p: (p[0], p[2], p[3]))
        for _, doc, text, i in places[1:]:
            gone.setdefault((doc, text), set()).update((i, i + 1, i + 2))
    for k, ls in split.items():
        g = gone.get(k, set())
        text = "\n".join(x for i, x in enumerate(ls) if i not in g) if g else k[1]
        out[k] = (k[0], text, len(ls), len(g))
    return Counter(out[(r[0], r[1])] for r in rows)


def test_awkward_rows(spark):
    assert Counter(map(tuple, lines.line_digest(frame(spark)).collect())) == plain(documents())


def test_given_columns_come_back(spark):
    cleaned = lines.drop_repeated_lines(frame(spark))
    assert cleaned.columns == frame(spark).columns
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in cleaned.collect())


def test_empty_table(spark):
    assert lines.line_digest(frame(spark, [])).collect() == []


def test_sql_is_whole():
    assert "LIMIT" not in LINES_SQL.upper()
