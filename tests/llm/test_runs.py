from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.data import documents, frame
from tidemark.llm import runs


def plain_runs(text, least=24, times=3):
    """Every maximal stretch of every period; the smallest period of each stretch stays."""
    n, found = len(text), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if text[i] != text[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and text[j] == text[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    given = (text or "").encode().split()
    if doc_id is not None and given:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(given)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            given = [w if i < a else given[a + (i - a) % p] for i, w in enumerate(given)]
    found = plain_runs(given)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(given) if i not in gone)
    return (
        doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_extensions_are_those_of_the_text():
    dice = random.Random(1)
    for _ in range(60):
        text = [dice.randint(1, dice.choice([1, 2, 4])) for _ in range(dice.randint(1, 60))]
        extension = runs.common_extension(runs.SuffixTree(text))
        one, other = np.array([dice.sample(range(len(text) + 1), 2) for _ in range(80)]).T
        for a, b, got in zip(one.tolist(), other.tolist(), extension(one, other).tolist()):
            want = 0
            while max(a, b) + want < len(text) and text[a + want] == text[b + want]:
                want += 1
            assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_brute_force(seed):
    dice = random.Random(seed)
    for _ in range(80):
        text = []
        for _ in range(dice.randint(1, 6)):
            root = [dice.choice("abc"[: dice.randint(1, 3)]) for _ in range(dice.randint(1, 14))]
            part = (root * dice.randint(1, 12))[: dice.randint(1, 70)]
            if dice.random() < 0.3:
                part[dice.randrange(len(part))] = "x"
            text += part
        given = [w.encode() for w in text]
        assert runs.word_runs(given, 24, 3) == plain_runs(given)


def test_nested_and_uniform_runs():
    inner = [b"a", b"b"] * 14 + [b"c"]
    for given in (inner * 4, [b"a"] * 24, [b"a"] * 23, [b"a"] * 3000, [b"a", b"b"] * 12 + [b"a"]):
        assert runs.word_runs(given, 24, 3) == plain_runs(given)


def test_awkward_rows(spark):
    rows = documents()
    rows += [(7000 + i, " ".join(f"w{i}" for i in range(i)), "de", "s", 1, 2, "k", 3, "", "") for i in range(90, 140)]
    want = Counter(plain_digest(r[0], r[1]) for r in rows)
    assert sum(bool(w[1]) for w in want) > 5
    assert Counter(map(tuple, runs.runs_digest(frame(spark, rows)).collect())) == want


def test_given_columns_come_back(spark):
    given = frame(spark).withColumnRenamed("kept", "collapsed")
    out = runs.periodic_runs(given)
    assert out.columns == [*given.columns, "__runs"]
    assert Counter(map(str, out.drop("__runs").collect())) == Counter(map(str, given.collect()))


def test_empty_table(spark):
    assert runs.runs_digest(frame(spark, [])).collect() == []


def test_shorter_runs_are_refused(spark):
    with pytest.raises(ValueError):
        runs.periodic_runs(frame(spark), least=10)
