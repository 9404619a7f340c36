from __future__ import annotations

import random
import re
import string
import tracemalloc
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tidemark.llm import private
from tidemark.llm.common import lowest

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")

HARD = [
    "a@b.com_x@y.de z@ q@r a@b@c.d.e %+@x.y", "x@y.z@u.v", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "0" * 5000 + ".1.2.3",
    "+1 (826) 555-4081 190.137.223.204", "4111 1111 1111 1111 4111-1111-1111-1111", "+12345678 +1-2(3)4567890",
    "²³.4.5.6 @ 7@8", "4111111111111111, 34@mail7.example.com",
]


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p[-400:]) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or private.luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def test_fixed_patterns():
    texts = HARD + [r[1] or "" for r in documents()]
    for text in texts:
        assert private.base_spans(text)[0] == plain(text)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in private.private_digest(docs).collect():
        base = plain(texts[row["doc_id"]])
        spans = [s.split(":") for s in row["spans"].split(",")] if row["spans"] else []
        spans = {(k, int(a), int(b)) for k, a, b in spans}
        assert set(base) <= spans
        assert row["n_card"] == sum(s[0] == "card" for s in base)
        for kind, a, b in spans - set(base):  # what is added passes the kind's check
            assert kind == "email" or private._checked(kind, texts[row["doc_id"]][a:b])


def test_the_model_reads_what_stands_side_by_side(spark):
    texts = private.sample_texts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    weights = private.fit(texts)
    assert weights == private.fit(texts)
    text = "call +1 (826) 555-4081 190.137.223.204 or pay 4111111111111111 5500005555555559 today, version 4.0."
    weights = private.by_feature(weights)
    _, added = private.spans_of(text, weights)
    assert {(k, text[a:b]) for k, a, b in added} == {
        ("phone", "+1 (826) 555-4081"), ("card", "4111111111111111"), ("card", "5500005555555559"),
    }
    _, clean = private.spans_of("In 1999 there were 12 345 of 67890, token 9b0b3c6a43eb78aa99cb, at 10:30.", weights)
    assert clean == []


def brute_best(text, weights):
    """The best sum of scores over all ways to cut a text into outside tokens and spans."""
    tokens = list(private.tokens_of(text, 0, len(text)))
    best = [0.0]
    for j in range(1, len(tokens) + 1):
        ways = [best[j - 1]]
        for i in range(max(0, j - private.LONGEST), j):
            a, b = tokens[i][0], tokens[j - 1][1]
            part = text[a:b]
            if len(part) >= 5 and part[-1].isalnum() and (part[0].isalnum() or part[0] in "+("):
                if "@" in part or sum(c in "0123456789" for c in part) >= 4:
                    seen = private.features(text, a, b)
                    ways += [best[i] + sum(weights.get((k, f), 0.0) for f in seen) for k in private.KINDS]
        best.append(max(ways))
    return best[-1]


def test_dynamic_programming_finds_the_best_segmentation():
    dice = random.Random(4)
    pieces = ["ab", "@", "c.de", "12.34", ".", "56", " ", "+1", "(4)", "-", "é9", "4111 1111", "x@y.z", "²", "7"]
    for _ in range(150):
        text = "".join(dice.choices(pieces, k=dice.randint(1, 25)))
        if not text.strip():
            continue
        seen = {f for a, b in [(0, len(text))] for f in private.features(text, a, b)} | {
            "bias", "luhn=True,True,False", "octets=True", "address=True,False", "spaces=0", "spaces=1", "before=space",
            "before=edge", "after=edge", *[f"digits={n}" for n in range(20)], "first=9", "first=+", "first=a",
        }
        weights = {(k, f): dice.gauss(-0.1, 1) for k in private.KINDS for f in sorted(seen)}
        spans = private.best_spans(text, 0, len(text), private.by_feature(weights))
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
        total = sum(weights.get((k, f), 0.0) for k, a, b in spans for f in private.features(text, a, b))
        assert abs(total - brute_best(text, weights)) < 1e-9


def test_a_long_unbroken_text_needs_little_memory():
    dice = random.Random(2)
    text = "".join(dice.choices(string.ascii_letters + string.digits + "+/", k=150_000)) + "@"
    weights = private.by_feature({(kind, "bias"): -2.0 for kind in private.KINDS} | {("card", "digits=7"): 3.0})
    tracemalloc.start()
    spans = private.best_spans(text, 0, len(text), weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans and peak < 3_000_000


def test_awkward_rows(spark):
    result = private.private_digest(frame(spark)).collect()
    assert len(result) == len(documents())
    assert private.private_digest(frame(spark, [])).collect() == []
    found = frame(spark, [(1, None) + (None,) * 8]).select(private.find_spans(F.col("text"), {}).alias("f"))
    assert found.first()["f"]["spans"] == ""


def test_a_sample_is_of_different_texts_and_bounded_per_input(spark):
    rows = spark.range(400_000).selectExpr("xxhash64(id) AS at").repartition(7)
    low = lowest(rows, "at", 400_000, 1_000)
    assert 1_000 < low.count() < 4_000
    least = low.agg(F.max("at")).first()[0]
    assert rows.where(F.col("at") <= least).count() == low.count()
    assert lowest(rows, "at", 1_500, 1_000).count() == 400_000
    copies = spark.createDataFrame([("call 5551234 now",)] * 50 + [("ip 10.0.0.1",), (None,), ("",)], "text string")
    assert sorted(private.sample_texts(copies)) == ["10.0.0.1", "5551234"]


def test_spans_written_otherwise_are_found_in_texts_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text RLIKE '[0-9@]'")
    texts = sorted({r["text"] for r in docs.select("text").collect()})
    weights = private.by_feature(private.fit(texts[::2]))
    dice = random.Random(5)
    there, right, found = Counter(), Counter(), 0
    for lattice, gold in private.examples(texts[1::2]):
        if not gold:
            continue
        text, spans = private.altered(lattice.text, lattice.start, lattice.end, sorted(gold), dice)
        text = "see " + text + " and so on"
        spans = {(k, a + 4, b + 4) for k, a, b in spans}
        seen = set(map(tuple, sum(private.spans_of(text, weights), [])))
        found += len(seen)
        there.update(k for k, _, _ in spans)
        right.update(k for k, _, _ in spans & seen)
    assert sum(there.values()) > 100
    print({k: (right[k], there[k]) for k in there}, sum(right.values()) / found)
    assert all(right[k] >= 0.9 * there[k] for k in there)
    assert sum(right.values()) >= 0.9 * found


def test_secrets_are_values_of_a_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    weights = private.fit(private.sample_texts(docs))
    given = re.compile(r'token = "([0-9a-fA-F]{20,})"', re.IGNORECASE)
    planted = {(i, *m.span(1)) for i, t in texts.items() for m in given.finditer(t)}
    found = set()
    by_kinds = private.by_feature(weights)
    for i, text in texts.items():
        found |= {(i, a, b) for k, a, b in private.spans_of(text, by_kinds)[1] if k == "secret"}
    assert len(planted) > 100 and found == planted
    dice = random.Random(77)
    right = wrong = missed = 0
    for text, spans in private.secret_regions(400, dice):
        seen = {s for s in private.spans_of(text, by_kinds)[1] if s[0] == "secret"}
        right, wrong, missed = right + len(seen & set(spans)), wrong + len(seen - set(spans)), missed + len(set(spans) - seen)
    print(right, wrong, missed)
    assert right >= 0.9 * (right + missed) and right >= 0.9 * (right + wrong)


def test_names_and_masks():
    assert private._named('my.api_key = "', 14) == "secret"
    assert private._named("Authorization: Bearer ", 22) == "secret"
    assert private._named("monkey: ", 8) == "other"
    assert private._named("token ", 6) == "none"
    assert private._unmasked("a.b [at] c [dot] d, 1[.]2") == "a.b@c.d, 1.2"
    text = "x y.z [at] mail [dot] example [dot] org or now @ 5"
    assert [text[a:b] for a, b in private.regions(text)] == ["y.z [at] mail [dot] example [dot] org", "now @ 5"]
    long = "a" * 200_000 + " @ " + "b1" * 200_000
    assert private.regions(long) == [(0, len(long))]
    for text in ("@", " @ ", "@ @ @", "[at]", "a [at]", "(at) b", "@  x", "1 @ [dot] @"):
        cut = private.regions(text)
        assert all(a < b for a, b in cut) and all(x[1] <= y[0] for x, y in zip(cut, cut[1:]))
