from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hashing

SCHEMA = "vec_id long, embedding array<float>, label int, code string, class_id int"


def plain(rows, k=10):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for q in usable:
        if q % 100 == 0:
            scored = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q)
            out[q] = [(i, s) for s, i in scored[:k]]
    return out


def answers(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(found, expected):
    assert found.keys() == expected.keys()
    for q, rows in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in rows]
        assert np.allclose([s for _, s in found[q]], [s for _, s in rows], atol=1e-12)


def test_awkward_rows(spark):
    dice = np.random.default_rng(2)
    rows = [(i, dice.normal(size=8).tolist()) for i in range(0, 400, 4)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # copies of the first
    rows += [(7, None), (8, []), (200, [0.0] * 8), (9, [None] * 8), (300, [float("nan")] * 8), (None, rows[3][1])]
    rows += [rows[5], rows[5], (2000, [float("inf")] + [1.0] * 7)]
    rows = [r if r[0] not in (200, 300) or sum(map(bool, r[1])) == 0 or r[1][0] != r[1][0] else (r[0] + 1, r[1]) for r in rows]
    rows = [(*r, 1, "x", 2) for r in rows]
    same(answers(hashing.neighbour_digest(spark.createDataFrame(rows, SCHEMA))), plain(rows))


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_rows(spark, n):
    rows = [(100 * i, [float(i + 1), 2.0, 1.0], 0, "", 0) for i in range(n)]
    found = answers(hashing.neighbour_digest(spark.createDataFrame(rows, SCHEMA)))
    same(found, {q: v for q, v in plain(rows).items() if v})


def test_every_code_within_the_radius_is_found(spark, monkeypatch):
    monkeypatch.setattr(hashing, "ENTRIES", 50)
    monkeypatch.setattr(hashing, "PROBES", 4)
    dice = np.random.default_rng(4)
    base = dice.integers(0, 256, (6, 4), dtype=np.uint8)
    codes = base[dice.integers(0, 6, 500)] ^ np.packbits(dice.random((500, 32)) < 0.15, axis=1)
    radii = dice.integers(0, 18, 40)
    index = spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in enumerate(codes)], "class_id long, code binary")
    queries = spark.createDataFrame(
        [(i, bytearray(codes[i].tobytes()), int(r)) for i, r in enumerate(radii)], "query_id long, code binary, radius int"
    )
    found = [tuple(r) for r in hashing.probed(index, queries, 4).collect()]
    bits = np.unpackbits(codes[:40][:, None] ^ codes[None], axis=2).sum(2)
    assert sorted(found) == sorted(map(tuple, np.argwhere(bits <= radii[:, None]).tolist()))


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in table.collect()]
    found, expected = answers(hashing.nearest(table, F.col("vec_id") % 20 == 0)), plain([(i * 100 if i % 20 == 0 else i * 100 + 1, v) for i, v in rows])
    hits = sum(len({i for i, _ in v} & {i // 100 for i, _ in expected[q * 100]}) for q, v in found.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_recall_on_many_rows(spark, tmp_path):
    """On 100,000 rows of the given covariance, where a fixed number of found codes loses neighbours."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    given = np.array([r["embedding"] for r in given], np.float64)
    dice = np.random.default_rng(6)
    rows = dice.multivariate_normal(given.mean(axis=0), np.cov(given.T), 100_000).astype(np.float32)
    pd.DataFrame({"vec_id": np.arange(len(rows)), "embedding": list(rows)}).to_parquet(tmp_path / "rows.parquet")
    table = spark.read.parquet(str(tmp_path / "rows.parquet"))
    found = answers(hashing.nearest(table, F.col("vec_id") % 250 == 0))
    assert len(found) == 400
    rows = rows.astype(np.float64)
    hits = []
    for q, listed in found.items():
        squares = ((rows - rows[q]) ** 2).sum(1)
        squares[q] = np.inf
        hits.append(len({i for i, _ in listed} & set(np.argsort(squares)[:10].tolist())) / 10)
    assert np.mean(hits) >= 0.9, np.mean(hits)
