from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tidemark.llm import pieces

WORDS = pieces.vocabulary(pieces.MODEL)
TABLE = {p: (i, s) for p, i, s in zip(WORDS.pieces, WORDS.ids, WORDS.scores)}


def plain(text):
    """Viterbi over the whole text, by the same rule."""
    if not text:
        return None if text is None else []
    text = " " + text
    best = [(0.0, 0, [])]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - WORDS.longest), end):
            found = TABLE.get(text[start:end])
            if found:
                options.append((best[start][0] + found[1], -start, [found[0]]))
            elif end - start == 1:
                spelled = [WORDS.first_byte + b for b in text[start:end].encode()]
                options.append((best[start][0] + WORDS.unknown_score, -start, spelled))
        score, back, ids = max(options)
        best.append((score, back, (-back, ids)))
    out, at = [], len(text)
    while at:
        at, ids = best[at][2]
        out = ids + out
    return out


EXTRA = [
    "  two  spaces\tand\nlines ", "▁literal ▁ mark", "don't e.g. www.example.com (x) [y]!!", "数学 и Привет",
    "34@mail7.example.com +1 (017) 555-7713", "   ", "a" * 300, "\x00\x07",
]


@pytest.mark.parametrize("head", [pieces.HEAD, 40, 0])
def test_awkward_rows(spark, monkeypatch, head):
    monkeypatch.setattr(pieces.frequent, "__defaults__", (head,))
    monkeypatch.setattr(pieces, "CHARS_PER_GROUP", 9000)
    rows = documents() + [(1000 + i, t) + (None,) * 8 for i, t in enumerate(EXTRA)]
    rows = [r for r in rows if len(r[1] or "") < 6000 and "x" * 500 not in (r[1] or "")]
    coded = pieces.encode(frame(spark, rows), keep=["doc_id", "source", "n_words"])
    coded = coded.withColumn("back", pieces.decode(F.col("ids"))).collect()
    assert Counter((r["doc_id"], r["source"], r["n_words"], r["text"]) for r in coded) == Counter(
        (r[0], r[3], r[5], r[1]) for r in rows
    )
    for r in coded:
        assert r["back"] == r["text"]
        assert r["ids"] == plain(r["text"])


def test_a_unit_is_solved_once_however_many_groups_hold_it(spark, monkeypatch):
    given, solved = [], pieces.solved
    monkeypatch.setattr(pieces, "solved", lambda units, words: given.append(units) or solved(units, words))
    monkeypatch.setattr(pieces.frequent, "__defaults__", (0,))
    monkeypatch.setattr(pieces, "CHARS_PER_GROUP", 40)
    texts = [f"shared words of all rows, own word w{i}" for i in range(40)]
    rows = [(i, text, *(None,) * 8) for i, text in enumerate(texts)]
    coded = {r["text"]: r["ids"] for r in pieces.encode(frame(spark, rows), keep=["doc_id"]).collect()}
    assert coded == {text: plain(text) for text in texts}
    times = Counter(r["unit"] for units in given for r in units.collect())
    assert times[" shared"] == 1 and set(times.values()) == {1}


def test_long_runs_are_cut_and_read_back(spark):
    long = "x" * 5000 + " " * 3000 + "é" * 700
    result = pieces.piece_digest(frame(spark, [(1, long) + (None,) * 8])).collect()
    assert result[0]["lossless"] and result[0]["n_pieces"] > 0


def test_empty_table(spark):
    assert pieces.piece_digest(frame(spark, [])).collect() == []


def test_no_piece_crosses_a_unit():
    units = pieces._units(WORDS.pattern)
    for text in EXTRA + list(TABLE):
        if not text.strip(" "):
            continue
        assert "".join(units(text)) == " " + text
    for piece in TABLE:
        assert len(units("q" + piece if not piece.startswith(" ") else piece)) <= 2
        whole = units(piece[1:]) if piece.startswith(" ") and len(piece) > 1 else None
        assert whole is None or len(whole) == 1


def test_ids_of_long_runs_are_those_of_their_cuts(spark):
    """Marks and spaces are cut at LONGEST, other runs at eight times that; each cut has its own best path."""

    def path(unit):
        best = [(0.0, 0, [])]
        for end in range(1, len(unit) + 1):
            options = []
            for start in range(max(0, end - WORDS.longest), end):
                found = TABLE.get(unit[start:end])
                if found:
                    options.append((best[start][0] + found[1], -start, [found[0]]))
                elif end - start == 1:
                    spelled = [WORDS.first_byte + b for b in unit[start:end].encode()]
                    options.append((best[start][0] + WORDS.unknown_score, -start, spelled))
            score, back, ids = max(options)
            best.append((score, back, best[-back][2] + ids))
        return best[-1][2]

    cases = {"-" * 600: [1 + 256, 256, 88], " " * 600: [256, 256, 89], "x" * 2500: [1 + 2048, 452]}
    rows = [(i, text, *(None,) * 8) for i, text in enumerate(cases)]
    coded = {r["text"]: r["ids"] for r in pieces.encode(frame(spark, rows), keep=["doc_id"]).collect()}
    for text, lengths in cases.items():
        whole, cuts = " " + text, []
        for n in lengths:
            cuts.append(whole[:n])
            whole = whole[n:]
        assert not whole and coded[text] == [i for unit in cuts for i in path(unit)]


def test_solving_makes_no_row_for_a_substring_and_no_shuffle(spark):
    units = [" " + w for w in "aaaa aab ababab the\nthere 数学 né ▁x 😀".split(" ")] + ["--", "   "]
    given = spark.createDataFrame([(u, i) for i, u in enumerate(units)], "unit string, times long")
    done = pieces.solved(given, WORDS)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Generate", "Join", "Aggregate", "Exchange"))
    rows = done.collect()
    assert [(r["unit"], r["times"]) for r in rows] == [(u, i) for i, u in enumerate(units)]
    # Only words are what a text is, less the space before it.
    assert all(r["ids"] == plain(r["unit"][1:]) for r in rows if r["unit"].startswith(" "))


def test_best_path_does_not_depend_on_what_is_solved_beside_it():
    table, dice = pieces._Pieces(WORDS), np.random.default_rng(5)
    texts = ["".join(dice.choice(list("aetins é数\n"), n)).replace(" ", "") for n in dice.integers(1, 60, 200)]
    texts = [t for t in texts if t]
    together = pieces._paths(pa.array([" " + t for t in texts]), table, WORDS.first_byte).to_pylist()
    assert together == [plain(t) for t in texts]
    alone = [pieces._paths(pa.array([" " + t]), table, WORDS.first_byte)[0].as_py() for t in texts[:20]]
    assert alone == together[:20]
    assert pieces._paths(pa.array([], pa.string()), table, WORDS.first_byte).to_pylist() == []


def test_tasks_do_not_load_pandas():
    """The Python processes of an executor's tasks share its memory with its heap."""
    code = "import sys; sys.argv.pop(); import tidemark.llm.pieces; sys.exit('pandas' in sys.modules)"
    root = Path(pieces.__file__).parents[2]
    assert subprocess.run([sys.executable, "-c", code, "-"], cwd=root, check=False).returncode == 0


def test_words_are_cut_like_those_of_one_text():
    texts = EXTRA + [None, "", " ", "a", " a", "a ", "a  ", "  a   b ", "x\n y", "é数 é"]
    ends, words = pieces._cut(pa.array(texts, pa.string()))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(ends, ends[1:])] == [pieces._words(t) for t in texts]
    different, find = pa.array(sorted(set(words))), pieces._units(WORDS.pattern)
    place, starts, units = pieces._cutter(WORDS.pattern, WORDS.marks)(different)
    units = units.to_pylist()
    for word, at in zip(different.to_pylist(), place):
        assert units[starts[at] : starts[at + 1]] == (find(word) or [" "])


def test_texts_are_taken_some_bytes_at_once(monkeypatch):
    monkeypatch.setattr(pieces, "_BYTES_AT_ONCE", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 30, None, "y" * 300, "", "z" * 60, "z" * 60])], names=["text"])
    some = [s.column(0).to_pylist() for s in pieces._text_slices(batch)]
    assert [t for s in some for t in s] == batch.column(0).to_pylist() and len(some) > 2
    assert all(sum(len(t or "") for t in s[1:]) <= 100 for s in some)
    assert list(pieces._text_slices(batch.slice(0, 0))) == []
