from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.data import documents, frame
from tidemark.llm import mix
from tidemark.llm.mix import Mix


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in full)
        level = (total - sum(3 * sizes[s] for s in full)) / free
        over = {s for s in names if s not in full and level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def check(rows, result):
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += size(row[1])
    wanted = plain_targets(sizes)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in result) == Counter(
        (r[0], size(r[1]), sizes[r[3]], round(wanted[r[3]], 6)) for r in rows
    )
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in result)
    taken = defaultdict(int)
    for r in result:
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    for (target, _), words in taken.items():
        assert abs(words - target) <= 2 * 64 + 0.01 * target


def test_awkward_rows(spark):
    first = mix.mix_digest(frame(spark)).collect()
    check(documents(), first)
    again = mix.mix_digest(frame(spark).repartition(5)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    check([tuple(r) for r in docs.collect()], mix.mix_digest(docs).collect())


def test_empty_table(spark):
    assert mix.mix_digest(frame(spark, [])).collect() == []
    assert mix.mixed_texts(frame(spark, [])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 100, 1000, 4097])
def test_permutations(n):
    for key in (0, 5, 2**63):
        to = mix.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
        assert sorted(to.tolist()) == list(range(n))


def test_every_epoch_takes_a_block_once(spark):
    sized = mix.with_sizes(frame(spark))
    sources, _ = mix.mixed(sized, Mix(block_words=8))
    slots = mix.slots(sources, Mix(block_words=8)).collect()
    assert len({(r["source_id"], r["epoch"], r["block"]) for r in slots}) == len(slots)
    per_source = Counter(r["source_id"] for r in slots)
    for source in sources.collect():
        assert per_source[source["source_id"]] == source["slots"]


def test_counts_of_shards_keep_both_totals():
    dice = np.random.default_rng(4)
    for have in ([7], [0, 5], [100, 1, 1, 300], list(dice.integers(0, 50, 40)), [10**12, 3 * 10**12, 5]):
        total = int(sum(have))
        sizes = np.array([total // 4 + (i < total % 4) for i in range(4)])
        counts = mix.drawn(sizes, np.array(have), [1])
        assert (counts >= 0).all() and (counts.sum(0) == sizes).all() and (counts.sum(1) == have).all()
    counts = np.array([mix.drawn([500] * 8, [3000, 900, 100], [seed])[:, 0] for seed in range(400)])
    assert np.abs(counts.mean(0) - [375, 112.5, 12.5]).max() < 3  # each shard is drawn by the targets
    assert counts.std(0).min() > 2


@pytest.mark.parametrize("in_range", [1000, 1])
def test_blocks_of_shards(spark, monkeypatch, in_range):
    """Shards are whole, of equal size and of mixed sources; blocks hold the words of their source."""
    monkeypatch.setattr(mix, "_RANGE", in_range)
    how = Mix(block_words=8, shards=5)
    docs = frame(spark)
    blocks = mix.packed_blocks(docs, how).collect()
    sizes = Counter(r["shard"] for r in blocks)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in blocks} == {(s, i) for s, n in sizes.items() for i in range(n)}
    assert len(blocks) == sum(sizes.values())
    assert {size(r["text"]) for r in blocks} <= set(range(1, 9))
    given = defaultdict(Counter)
    for row in documents():
        given[row[3]].update(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    taken = defaultdict(Counter)
    for r in blocks:
        taken[r["source"], r["epoch"]].update(r["text"].split(" "))
    assert all(not words - given[source] for (source, _), words in taken.items())
    digest = mix.mix_digest(docs, how).collect()
    assert sum(r["taken"] for r in digest) == sum(size(r["text"]) for r in blocks)
    last = {r["source"] for r in blocks if r["slot"] >= sizes[r["shard"]] // 2}
    assert len(last) > 1
    again = mix.packed_blocks(docs.repartition(3), how).collect()
    assert sorted(map(str, again)) == sorted(map(str, blocks))


def test_slots_are_made_by_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(mix, "_TASK", 100)
    monkeypatch.setattr(mix, "_CHUNK", 10)
    sources, _ = mix.mixed(mix.with_sizes(frame(spark)), Mix(block_words=2))
    made = mix.slots(sources, Mix(block_words=2))
    total = sum(r["slots"] for r in sources.collect())
    assert total > 1000 and made.rdd.getNumPartitions() == -(-total // 100)


def test_no_blocks_of_no_documents(spark):
    assert mix.packed_blocks(frame(spark, [])).collect() == []


def test_texts_are_the_words_taken(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] not in (30, 0)]
    docs = frame(spark, rows)
    texts = mix.mixed_texts(docs)
    assert texts.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in mix.mix_digest(docs).collect()}
    found = Counter()
    given = {r[0]: r[1] for r in rows}
    for r in texts.collect():
        found[r["doc_id"]] += size(r["text"])
        assert not Counter(r["text"].split()) - Counter(given[r["doc_id"]].split())
    assert found == Counter({k: n for k, n in taken.items() if n})
