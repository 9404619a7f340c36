from __future__ import annotations

import re
from collections import Counter


from tests.llm.data import documents, frame
from tidemark.llm import quality
from tidemark.llm.quality import Rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), len(lines),
    )


def test_awkward_rows(spark):
    result = quality.quality_digest(frame(spark)).collect()
    expected = Counter()
    for row in documents():
        n = plain_counts(row[1])
        expected[(row[0], *n[:5], n[0] < 10 or 100 * n[4] > 20 * n[0])] += 1
    assert Counter(tuple(r)[:7] for r in result) == expected
    assert not any(r["kept"] and r["base_failed"] for r in result)


def test_empty_table(spark):
    assert quality.quality_digest(frame(spark, [])).collect() == []
    assert quality.keep_good(frame(spark, [])).collect() == []


def test_strict_host_loses_what_fails_and_keeps_clean_documents(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    marked = clean.replace(" word5", " # word5")  # 11 symbols in 71 words
    rows = []
    for i in range(300):
        host = "bad" if i < 60 else f"good{i % 4}"
        fails = i < 50 if host == "bad" else i % 60 == 7
        rows.append((i, marked if fails else clean, "en", host, 1) + (None,) * 5)
    kept = {r["doc_id"] for r in quality.keep_good(frame(spark, rows)).collect()}
    assert kept == set(range(50, 300))


def test_rates_shrink_towards_the_mean(spark):
    rows = [(h, n, f) for h, n, f in (("a", 1, 1), ("b", 100, 50), ("c", 100, 2), ("d", 100, 1))]
    measured = spark.createDataFrame(
        [(h, 100, 500, 90 if i < f else 0, 0, 0, 1) for h, n, f in rows for i in range(n)],
        "source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_lines long",
    )
    rates = {r["host"]: r["rate_symbols"] for r in quality.host_verdicts(measured, "source").collect()}
    assert 54 / 301 < rates["a"] < 1 and 0.45 < rates["b"] < 0.5
    assert rates["a"] < 0.9  # one failing document of one says little


def test_only_native_nodes(spark):
    plan = quality.quality_digest(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_are_columns():
    assert set(Rules().soft()) == {"symbols", "lines", "length"}
