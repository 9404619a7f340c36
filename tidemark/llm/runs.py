"""Periodic runs of words: stretches that repeat a root of words, found by suffix trees.

A run is a stretch of words with smallest period q, at least ``least`` words and ``times``
periods long, that neither neighbouring word extends. Per text:

1. A sieve. In a run of 24 words and three periods every group of eight consecutive words
   occurs again q words away (if q <= 8, 2q + 8 <= 24 words hold both; if q > 8, 2q + 8 <
   3q do). So only stretches of words whose every group of eight repeats in the text can
   hold a run. Groups are compared by 64-bit hashes: a collision keeps a stretch too many.
2. Ukkonen's suffix trees of the stretch and of its reversal. The Euler tour of a tree
   holds string depths; the least depth between two leaves is that of their lowest common
   ancestor, the longest common extension of two places. Least depths come from blocks
   and a sparse table over them, in constant time and linear memory.
3. Lyndon roots. The longest Lyndon word at a place ends at the next smaller suffix; for
   the order of words and for its reverse, these are all roots of runs there can be. Each
   candidate root is extended to the right by the tree and to the left by the reversal's.

A word is dropped from the collapsed text if a run contains it after that run's first
period. Words are separated by ``[\\x20\\x09-\\x0D]+`` and compared exactly. Null and empty
texts have no words and no runs. Repeated rows and other columns are handed through. One
text is worked on by one task, in memory in proportion to its longest repeating stretch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import words

LEAST = 24
TIMES = 3
_GROUP = 8
_BLOCK = 16

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS_ARROW = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


class SuffixTree:
    """Ukkonen's suffix tree of ``text`` (numbers above 0) and the end mark 0.

    ``parent``, ``start`` and ``end`` give each node's edge as a slice of the marked text;
    the leaf of the suffix at place i is ``leaves[i]``.
    """

    def __init__(self, text: list[int]):
        self.text = text = [*text, 0]
        size, n = max(text) + 1, len(text)
        child: dict[int, int] = {}
        start, end, link, parent, leaves = [0], [0], [0], [0], []
        node = edge = length = waiting = 0
        for place, word in enumerate(text):
            waiting += 1
            fresh = 0
            while waiting:
                if not length:
                    edge = place
                at = node * size + text[edge]
                below = child.get(at)
                if below is None:
                    child[at] = len(start)
                    leaves.append(len(start))
                    start.append(place), end.append(n), link.append(0), parent.append(node)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    span = end[below] - start[below]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    middle = start[below] + length
                    if text[middle] == word:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    split = len(start)
                    child[at] = split
                    start.append(start[below]), end.append(middle), link.append(0), parent.append(node)
                    child[split * size + word] = split + 1
                    leaves.append(split + 1)
                    start.append(place), end.append(n), link.append(0), parent.append(split)
                    start[below], parent[below] = middle, split
                    child[split * size + text[middle]] = below
                    if fresh:
                        link[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = place - waiting + 1
        self.start, self.end = np.array(start), np.array(end)
        self.parent, self.leaves = np.array(parent), np.array(leaves)

    def _children(self, key: np.ndarray) -> tuple[list[int], list[int]]:
        """All nodes but the root by (parent, ``key`` of the first word), and where a parent's begin."""
        nodes = np.arange(1, len(self.start))
        nodes = nodes[np.lexsort((key[np.array(self.text)[self.start[1:]]], self.parent[1:]))]
        begins = np.searchsorted(self.parent[nodes], np.arange(len(self.start) + 1))
        return nodes.tolist(), begins.tolist()

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """String depths along the Euler tour, and the place in it of each suffix's leaf."""
        nodes, begins = self._children(np.arange(max(self.text) + 1))
        span = (self.end - self.start).tolist()
        depth, first, depths = [0] * len(span), [0] * len(span), []
        todo = [0]
        while todo:
            node = todo.pop()
            if node < 0:
                depths.append(depth[~node])
                continue
            first[node] = len(depths)
            here = depth[node]
            depths.append(here)
            for below in reversed(nodes[begins[node] : begins[node + 1]]):
                depth[below] = here + span[below]
                todo.append(~node)
                todo.append(below)
        return np.array(depths, dtype=np.int32), np.array(first)[self.leaves]

    def ranks(self, key: np.ndarray) -> list[int]:
        """The place of each suffix in the order where words compare by ``key``."""
        nodes, begins = self._children(key)
        rank, order = [-1] * len(self.start), 0
        todo = [0]
        while todo:
            node = todo.pop()
            low, high = begins[node], begins[node + 1]
            if low == high:
                rank[node] = order
                order += 1
            else:
                todo.extend(reversed(nodes[low:high]))
        return np.array(rank)[self.leaves].tolist()


def least_between(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives the least of ``values`` from place ``low`` to ``high``, both included."""
    blocks = -(-len(values) // _BLOCK)
    padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, _BLOCK)
    to_here = np.minimum.accumulate(grid, axis=1).ravel()
    from_here = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    levels = [grid.min(axis=1)]
    while 2 << (len(levels) - 1) <= blocks:
        half, above = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(above[:-half], above[half:]))
    width = max(len(level) for level in levels)
    table = np.stack([np.pad(level, (0, width - len(level))) for level in levels])

    def least(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        first, last = low // _BLOCK, high // _BLOCK
        out = np.minimum(from_here[low], to_here[high])
        inner = last - first - 1
        many = np.flatnonzero(inner > 0)
        if len(many):
            level = np.frexp(inner[many])[1] - 1
            out[many] = np.minimum(
                out[many],
                np.minimum(
                    table[level, first[many] + 1], table[level, last[many] - (1 << level)]
                ),
            )
        same = np.flatnonzero(first == last)
        if len(same):
            start, stop = low[same], high[same]
            found = padded[start].copy()
            for step in range(1, _BLOCK):
                np.minimum(found, padded[np.minimum(start + step, stop)], out=found)
            out[same] = found
        return out

    return least


def common_extension(tree: SuffixTree) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """How many words from two places on are equal, for arrays of places."""
    depths, leaf = tree.tour()
    least = least_between(depths)

    def extension(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        a, b = leaf[one], leaf[other]
        return least(np.minimum(a, b), np.maximum(a, b))

    return extension


def next_smaller(rank: list[int]) -> list[int]:
    """For every place the next one of a smaller rank."""
    out, open_ = [len(rank)] * len(rank), []
    for place, value in enumerate(rank):
        while open_ and rank[open_[-1]] > value:
            out[open_.pop()] = place
        open_.append(place)
    return out


def stretch_runs(text: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers above 0."""
    n = len(text)
    tree = SuffixTree(text)
    upward = np.arange(max(text) + 1)
    downward = np.where(upward > 0, len(upward) - upward, 0)
    roots = [np.array(next_smaller(tree.ranks(key))[:n]) for key in (upward, downward)]
    ahead = common_extension(tree)
    del tree
    behind = common_extension(SuffixTree(text[::-1]))
    place = np.arange(n)
    found: set[tuple[int, int, int]] = set()
    for stop in roots:
        period = stop - place
        root = np.flatnonzero(period * times <= n)
        begin, stop, period = place[root], stop[root], period[root]
        right = ahead(begin, stop)
        left = behind(n - begin, n - stop)
        length = left + period + right
        kept = np.flatnonzero((length >= least) & (length >= times * period))
        found.update(
            zip((begin - left)[kept].tolist(), length[kept].tolist(), period[kept].tolist())
        )
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the stretches in which every group of eight words repeats in the text."""
    n = len(ids) - _GROUP + 1
    if n < 2:
        return []
    hashed = np.zeros(n, dtype=np.uint64)
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for k in range(_GROUP):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    order = np.argsort(hashed)
    ordered = hashed[order]
    twin = np.zeros(n + 2, dtype=bool)
    equal = ordered[1:] == ordered[:-1]
    twin[order[1:][equal] + 1] = True
    twin[order[:-1][equal] + 1] = True
    turns = np.flatnonzero(twin[1:] != twin[:-1])
    return [(b, e + _GROUP - 1) for b, e in zip(turns[::2].tolist(), turns[1::2].tolist())]


def word_runs(given: list[bytes], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start, then period."""
    if len(given) < least:
        return []
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in given]
    out = []
    for begin, end in stretches(np.array(ids)):
        if end - begin >= least:
            again: dict[int, int] = {}
            text = [again.setdefault(word, len(again) + 1) for word in ids[begin:end]]
            out += [(begin + s, length, p) for s, length, p in stretch_runs(text, least, times)]
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed_words(given: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return given
    turns = np.zeros(len(given) + 1, dtype=np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(turns[:-1]) == 0).tolist()
    return [given[i] for i in kept]


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period by start) and ``collapsed``, in ``__runs``.

    ``least`` and ``times`` may not be below 24 and 3, for which the sieve is exact.
    """
    if least < LEAST or times < TIMES:
        raise ValueError(f"runs of fewer than {LEAST} words or {TIMES} periods are not found")
    rest = [name for name in docs.columns if name != text]
    packed = docs.select(
        (F.struct(*rest) if rest else F.lit(0)).alias("__rest"), F.col(text).alias("__text")
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for value in batch.column(1).cast(pa.binary()):
                given = (value.as_py() or b"").split()
                here = word_runs(given, least, times)
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in here])
                kept.append(b" ".join(collapsed_words(given, here)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(runs, _RUNS_ARROW),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["__rest", "__text", "runs", "collapsed"],
            )

    added = StructType.fromDDL(f"runs {_RUNS}, collapsed string")
    schema = StructType([*packed.schema.fields, *added.fields])
    out = packed.mapInArrow(found, schema)
    return out.select(
        *[
            F.col("__text").alias(name) if name == text else F.col("__rest").getField(name).alias(name)
            for name in docs.columns
        ],
        F.struct("runs", "collapsed").alias("__runs"),
    )


def with_planted_period(documents: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten (by its id) the words from a place on repeat.

    With h the CRC-32 of the decimal id and g = h div 10: if h is a multiple of ten, word i
    from place a = g mod n on is the word at a + (i - a) mod p, p = 1 + (n - a) div
    (3 + g mod 8). Rows without id are left as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = documents.select("doc_id", "text", h.alias("__h"))
    given = words(F.col("text"))
    n = F.size(given).cast("long")

    def planted(a: Column, g: Column) -> Column:
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        root = F.slice(given, (a + 1).cast("int"), p.cast("int"))
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(root, times)), F.lit(1), (n - a).cast("int"))
        return F.array_join(F.concat(F.slice(given, F.lit(1), a.cast("int")), tail), " ")

    g = F.floor(F.col("__h") / 10)
    text = F.when(
        (F.pmod("__h", F.lit(10)) == 0) & (n > 0),
        planted(F.pmod(g, n), g),
    ).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def runs_digest(documents: DataFrame) -> DataFrame:
    """The runs of every document as numbers and hashes."""
    out = periodic_runs(with_planted_period(documents)).select("doc_id", "__runs.*")
    # Exponents of two runs are compared exactly, as products of long numbers.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda top, run: F.when(run.length * top.period > top.length * run.period, run).otherwise(top),
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    out = out.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
