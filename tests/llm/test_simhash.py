from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.data import documents, frame
from tidemark.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    n = max(1, len(words) - 3)
    shingles = [" ".join(words[i : i + 4]) for i in range(n)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def check(rows, result):
    fps = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(fps)
    smallest = {}
    for row, fp in zip(rows, fps):
        if row[0] is not None:
            smallest[roots[fp]] = min(row[0], smallest.get(roots[fp], row[0]))
    expected = Counter((r[0], f"{f:016x}", smallest.get(roots[f])) for r, f in zip(rows, fps))
    assert Counter(map(tuple, result.collect())) == expected


def test_awkward_rows(spark):
    check(documents(), simhash.simhash_digest(frame(spark)))


def test_empty_table(spark):
    assert simhash.simhash_digest(frame(spark, [])).collect() == []
    assert simhash.keep_first(frame(spark, [])).collect() == []


def test_near_copies(spark):
    dice = random.Random(1)
    base = [f"w{dice.randrange(500)}" for _ in range(400)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(i % 4):
            text[dice.randrange(len(text))] = f"v{dice.randrange(9)}"
        rows.append((i, " ".join(text)) + (None,) * 8)
    check(rows, simhash.simhash_digest(frame(spark, rows)))


@pytest.mark.parametrize("limit", [20_000, 7])
def test_every_pair_within_four_bits_is_connected(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "CELL_LIMIT", limit)
    monkeypatch.setattr(simhash, "SHORT_RUN", 4)
    dice = random.Random(3)
    fps = {0, 2**64 - 1, dice.getrandbits(64)}
    while len(fps) < 400:
        fp = dice.choice(sorted(fps))
        for _ in range(dice.choice([1, 3, 4, 4, 5, 7])):
            fp ^= 1 << dice.randrange(64)
        fps.add(fp)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    groups = {}
    for f, (s,) in zip(fps, signed):
        groups.setdefault(roots.get(s, s), set()).add(f)
    expected = {}
    for f, root in plain_components(list(fps)).items():
        expected.setdefault(root, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_one_document_of_each_group_stays(spark):
    rows = documents()
    kept = simhash.keep_first(frame(spark))
    assert kept.columns == frame(spark).columns
    roots = plain_components([plain_fingerprint(r[1]) for r in rows])
    components = {roots[plain_fingerprint(r[1])] for r in rows}
    found = [roots[plain_fingerprint(r["text"])] for r in kept.collect()]
    assert sorted(found) == sorted(components)
