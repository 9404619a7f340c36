from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from tests.llm.data import documents, frame
from tidemark.llm import search

ITEMS = "item_id long, text string, doc_id long, rank string"


def plain(rows, items, k=10):
    def cut(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[0-9a-z\u0080-\U0010ffff]+", low)

    docs = [(r[0], Counter(cut(r[1]))) for r in rows]
    sizes = [sum(c.values()) for _, c in docs]
    N, L = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in {(i[0], i[1]) for i in items}:
        scored = []
        for (doc_id, counts), n in zip(docs, sizes):
            m = 10 + (90 * n * N) // L if L else 0
            score = 0
            for t in set(cut(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return Counter(out)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def stated():
    texts = [r[1] for r in documents()]
    longest = max((t for t in texts if t), key=len)
    out = [(i, t, 1, "r") for i, t in enumerate(texts)]
    out += [(1, texts[9], 2, None), (1, "other text, same id", 2, None), (None, "ÇA va bien", 3, None)]
    return out + [(900, "nothing-of this_sort", 0, ""), (901, longest * 3, 0, ""), (4, "one", 1, "r")] * 2


@pytest.mark.parametrize("limit", [search.BLOCK_TERMS, 100])
def test_awkward_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(search, "BLOCK_TERMS", limit)
    monkeypatch.setattr(search, "_SCORES_AT_ONCE", 64)
    got = search.ranked_search(frame(spark), items(spark, stated())).collect()
    assert Counter(map(tuple, got)) == plain(documents(), stated())


def test_large_class_keeps_its_lowest_ids(spark):
    rows = [(1000 - i, "same few words", *[None] * 8) for i in range(400)]
    rows += [(2000 + i, "words of another text", *[None] * 8) for i in range(30)]
    wanted = [(1, "few words", 0, ""), (2, "another", 0, "")]
    got = search.ranked_search(frame(spark, rows), items(spark, wanted)).collect()
    assert Counter(map(tuple, got)) == plain(rows, wanted)


def test_long_texts_are_counted_by_pieces(monkeypatch):
    text = ("Ab cd-éf 12 " * 500).encode().lower() + b"x" * 3000
    whole = search.term_counts(text)
    monkeypatch.setattr(search, "_PIECE", 7)
    assert search.term_counts(text) == whole


def test_many_terms_stay_exact():
    best = search._Best(2, 3)
    import numpy as np

    scores = np.array([[5, 1 << 60], [5, (1 << 60) + 1], [7, 0], [5, 3]])
    best.add(scores, np.array([4, 3, 2, 1]), np.arange(4))
    item, score, order, _ = best.settle()
    assert list(zip(item, score, order)) == [(0, 7, 2), (0, 5, 1), (0, 5, 3), (1, (1 << 60) + 1, 3), (1, 1 << 60, 4), (1, 3, 1)]


def test_empty_tables(spark):
    none = frame(spark, [])
    assert search.ranked_search(none, items(spark, stated())).collect() == []
    assert search.ranked_search(frame(spark), items(spark, [])).collect() == []
    assert search.ranked_search(frame(spark), items(spark, [(1, None, 0, ""), (2, "", 0, "")])).collect() == []


def test_sql_states_the_same(spark):
    folder = "/root/testdata/sf0.001"
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = base.execute(search.SEARCH_SQL).fetchall()
    got = search.search_digest(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    ).collect()
    assert Counter(map(tuple, got)) == Counter(want) and want
