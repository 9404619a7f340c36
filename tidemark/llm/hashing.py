"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: on a bounded sample (``SAMPLE`` vectors, those of smallest hash) principal axes are taken
and ``ROTATIONS`` rotations learned (iterative quantisation, from different starts); a code has
the signs of all rotated vectors. Every row is coded and indexed.

Index: a code is cut into bytes, each indexed in a table of its own. Codes within r bits agree
with the query, in one of m tables, up to r div m bits (tables after the first r mod m, one bit
less), so probing all bytes that near in each table finds every code within r. Probes and
entries meet by (table, high half of the byte), cut into blocks of bounded size, and are compared
there with the whole code; a pair that several tables find is kept by the first. What is found is
ranked by exact distance on the original vectors. Queries that find fewer than k are searched again
without a bound.

Radius: up to ``CALIBRATED`` of the queries are answered exactly, by a scan of all rows that passes
on those within the k-th distance to the sample only. A query's r is where the sample holds the
share of codes that reaches ``RECALL`` of these answers, and no less than the share of ``FOUND``.

Equal vectors are indexed once, with their k + 1 smallest ids, all that an answer can need.
Null ids, and vectors null, zero, of null or non-finite components, or of another length than
most, take no part. Repeated rows count once; other columns are not read. Empty in, empty out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lowest, written

SAMPLE = 20_000
AXES = 64
ROTATIONS = 4
FOUND = 800
CALIBRATED = 256
RECALL = 0.95  # of the calibrating queries together; 0.9 is wanted of all
LEAST_IN_SAMPLE = 50
ENTRIES = 50_000  # of a block
PROBES = 4_096
_PAIRS = 1 << 21  # compared at a time
_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array of double) of the distinct rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select("vec_id", vector.alias("vector"))
        .where(~bad & F.exists("vector", lambda x: x != 0))
    )
    rows = written(rows.distinct(), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


class Coder:
    """Mean, axes and rotations, fitted on the sample."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        dice = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        axes = np.linalg.svd(centred.T @ centred)[0][:, :AXES]
        flat = centred @ axes
        turns = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(dice.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(20):
                u, _, v = np.linalg.svd(np.sign(flat @ turn).T @ flat)
                turn = (u @ v).T
            turns.append(turn)
        self.turned = axes @ np.concatenate(turns, axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits((vectors - self.mean) @ self.turned > 0, axis=1)


def _code(coder: Coder, vector: Column) -> Column:
    @F.pandas_udf("binary")
    def code(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        return pd.Series([row.tobytes() for row in coder.codes(np.stack(vectors.to_numpy()))])

    return code(vector)


def _squares(asked: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all pairs, and what rounding may add to each."""
    sums = (asked**2).sum(1)[:, None] + (rows**2).sum(1)
    return np.maximum(sums - 2 * asked @ rows.T, 0), 1e-9 * sums


def calibrated_place(coder: Coder, sample: pd.DataFrame, classes: DataFrame, asked: DataFrame, k: int) -> int:
    """The place in the sample, by bits from a query, that holds ``RECALL`` of true neighbours."""
    asked = asked.withColumn("class_id", F.xxhash64("vector")).withColumn("at", F.xxhash64("query_id"))
    few = lowest(asked, "at", asked.count(), CALIBRATED).orderBy("at", "query_id").limit(CALIBRATED)
    chosen = few.select("class_id", "vector").collect()
    if not chosen:
        return 0
    own = np.array([r["class_id"] for r in chosen])
    vectors = np.array([r["vector"] for r in chosen], np.float64)
    codes = coder.codes(vectors)
    inside = np.stack(sample["vector"].to_numpy())
    squares, spare = _squares(vectors, inside)
    squares = np.where(own[:, None] == sample["class_id"].to_numpy(), np.inf, squares + spare)
    # The k-th distance to the sample is no less than that to all rows.
    bound = np.partition(squares, k - 1, axis=1)[:, k - 1] if len(inside) > k else np.full(len(own), np.inf)

    def near(batches):
        for rows in batches:
            if len(rows):
                have = np.stack(rows["vector"].to_numpy())
                ids = rows["class_id"].to_numpy()
                squares, spare = _squares(vectors, have)
                q, e = np.nonzero((squares - spare <= bound[:, None]) & (own[:, None] != ids))
                bits = _ONES[codes[q] ^ coder.codes(have)[e]].sum(1, dtype=np.int32)
                yield pd.DataFrame({"query": q, "class_id": ids[e], "square": squares[q, e], "bits": bits})

    found = classes.select("class_id", "vector").mapInPandas(near, "query int, class_id long, square double, bits int")
    order = Window.partitionBy("query").orderBy("square", "class_id")
    true = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    known = coder.codes(inside)
    steps = [np.sort(_ONES[known ^ c].sum(1, dtype=np.int32)) for c in codes]
    places = sorted(int(np.searchsorted(steps[r["query"]], r["bits"])) for r in true.select("query", "bits").collect())
    return places[math.ceil(RECALL * len(places)) - 1] if places else 0


def _radius(known: np.ndarray, place: int, code: Column) -> Column:
    @F.pandas_udf("int")
    def radius(codes: pd.Series) -> pd.Series:
        if place >= len(known):  # few vectors: all of them
            return pd.Series([8 * known.shape[1]] * len(codes))
        own = (np.frombuffer(c, np.uint8) for c in codes)
        return pd.Series([int(np.partition(_ONES[known ^ c].sum(1, dtype=np.int32), place)[place]) for c in own])

    return radius(code)


def _byte(code: str, at: Column) -> Column:
    return F.conv(F.hex(F.substring(F.col(code), at + 1, F.lit(1))), 16, 10).cast("int")


def _near(radius: np.ndarray, table: int, tables: int) -> np.ndarray:
    """Bits that codes within ``radius`` may differ by in this table; -1: not probed."""
    return radius // tables - (table > radius % tables)


def _matcher(tables: int):
    def match(key: tuple, entries: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        table = key[0]
        out = [np.empty((0, 2), np.int64)]
        if len(entries) and len(probes):
            have = np.frombuffer(b"".join(entries["code"]), np.uint8).reshape(-1, tables)
            want = np.frombuffer(b"".join(probes["code"]), np.uint8).reshape(-1, tables)
            radius = probes["radius"].to_numpy()
            near = _near(radius, table, tables)
            for value in np.unique(have[:, table]):
                inside = np.flatnonzero(have[:, table] == value)
                asking = np.flatnonzero(_ONES[want[:, table] ^ value] <= near)
                step = max(1, _PAIRS // (len(inside) * tables))
                for at in range(0, len(asking), step):
                    some = asking[at : at + step]
                    bits = _ONES[want[some][:, None, :] ^ have[inside][None, :, :]]
                    q, e = np.nonzero(bits.sum(2, dtype=np.int32) <= radius[some][:, None])
                    # Kept by the first table that finds the pair.
                    allowed = np.stack([_near(radius[some[q]], t, tables) for t in range(tables)], axis=1)
                    first = (bits[q, e] <= allowed).argmax(1) == table
                    pair = [probes["query_id"].to_numpy()[some[q[first]]], entries["class_id"].to_numpy()[inside[e[first]]]]
                    out.append(np.stack(pair, axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["query_id", "class_id"])

    return match


def probed(index: DataFrame, queries: DataFrame, tables: int) -> DataFrame:
    """query_id, class_id of every code of ``index`` within the radius of a query."""
    table = F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("table")
    entries = index.select("class_id", "code", table)
    entries = entries.withColumn("half", (_byte("code", F.col("table")) / 16).cast("int"))
    probes = queries.select("query_id", "code", "radius", table)
    probes = probes.withColumn("half", F.explode(F.sequence(F.lit(0), F.lit(15))))
    # The high half of a byte within reach: its own bits differ by no more than allowed.
    reach = F.expr(f"radius DIV {tables} - CAST(table > radius % {tables} AS INT)")
    high = F.bit_count(F.col("half").bitwiseXOR((_byte("code", F.col("table")) / 16).cast("int")))
    probes = probes.where(high <= reach)
    at = ["table", "half"]
    # At most sixteen rows a table: how many blocks its entries and probes are cut into.
    blocks = entries.groupBy(at).agg(F.ceil(F.count("*") / ENTRIES).cast("int").alias("entry_blocks")).join(
        probes.groupBy(at).agg(F.ceil(F.count("*") / PROBES).cast("int").alias("probe_blocks")), at
    )
    blocks = F.broadcast(written(blocks, "blocks"))

    def dealt(rows: DataFrame, own: str, other: str, id_: str) -> DataFrame:
        return rows.join(blocks, at).select(
            *rows.columns,
            F.pmod(F.xxhash64(id_), F.col(own)).cast("int").alias(own[:-1]),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]),
        )

    key = [*at, "entry_block", "probe_block"]
    left = dealt(entries, "entry_blocks", "probe_blocks", "class_id").groupBy(key)
    right = dealt(probes, "probe_blocks", "entry_blocks", "query_id").groupBy(key)
    return left.cogroup(right).applyInPandas(_matcher(tables), "query_id long, class_id long")


def _ranked(found: DataFrame, queries: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    @F.pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="float64")
        return pd.Series(np.sqrt(((np.stack(a.to_numpy()) - np.stack(b.to_numpy())) ** 2).sum(1)))

    scored = (
        found.join(queries.select("query_id", F.col("vector").alias("asked")), "query_id")
        .join(classes.select("class_id", "vector", "ids"), "class_id")
        .select("query_id", "ids", distance("asked", "vector").alias("score"))
    )
    each = scored.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each row that ``is_query`` selects."""
    rows = usable(vectors)
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = written(
        few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.xxhash64("vector").alias("class_id"), "vector", "ids"),
        "vector-classes",
    )
    n = classes.count()
    few = lowest(classes.withColumn("at", F.xxhash64("class_id")), "at", n, SAMPLE)
    found_rows = few.orderBy("at", "class_id").limit(SAMPLE).select("class_id", "vector").collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not found_rows:
        return vectors.sparkSession.createDataFrame([], empty)
    sample = np.array([r["vector"] for r in found_rows])
    coder = Coder(sample)
    tables = coder.codes(sample[:1]).shape[1]
    index = written(classes.select("class_id", _code(coder, F.col("vector")).alias("code")), "codes")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    asked = asked.withColumn("code", _code(coder, F.col("vector")))
    asked = written(asked, "asked")
    drawn = pd.DataFrame({"class_id": [r["class_id"] for r in found_rows], "vector": list(sample)})
    place = max(
        LEAST_IN_SAMPLE, math.ceil(FOUND / n * len(sample)), calibrated_place(coder, drawn, classes, asked, k)
    )
    queries = written(asked.withColumn("radius", _radius(coder.codes(sample), place, F.col("code"))), "queries")
    result = written(_ranked(probed(index, queries, tables), queries, classes, k), "nearest")
    # Queries short of k, if there are more rows to find: again, without a bound.
    wanted = min(k, rows.count() - 1)
    full = result.groupBy("query_id").count().where(F.col("count") >= wanted)
    short = written(queries.join(full, "query_id", "left_anti").withColumn("radius", F.lit(8 * tables)), "short")
    if not short.isEmpty():
        rest = _ranked(probed(index, short, tables), short, classes, k)
        result = result.join(short, "query_id", "left_anti").unionByName(rest)
    return result.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def neighbour_digest(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(embeddings, F.col("vec_id") % 100 == 0)
