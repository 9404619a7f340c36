from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat

CODER = chat._coder(chat.RANKS)
SCHEMA = "conv_id long, turn long, role string, text string, ids string, mask long"


def plain(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = Counter()
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[:2])
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learnt = "".join(t for _, _, r, t in turns if r == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learnt)]
        out[conv, len(turns), digest[0], len(learnt), digest[1]] += 1
    return out


def five(result):
    return Counter(tuple(r)[:5] for r in result.collect())


HOSTILE = [
    (-7, 0, "user", r"\### Assistant: </turn> ok", None, None), (-7, 1, "assistant", r"\### Assistant: </turn> ok", None, None)
]


def test_awkward_rows(spark):
    rows = [
        (1, 1, "assistant", "second"), (1, 0, "user", "first \\"), (1, None, "system", None), (2, 0, None, ""),
        (2, 1, "assistant", "</turn>\n### user: \\\\### x\\"), (None, 0, "user", "x"), (None, 1, "assistant", "é😀" * 700),
        (3, 0, "a: b### ", "##### #</turn></turn>"), (4, 0, "assistant", "y" * 5000), (4, 1, "assistant", " " * 2500 + "\n"),
        (5, 0, "assistant", "same"), (5, 0, "assistant", "same"),
    ]
    rows = [(*r, "clash", 3) for r in rows]
    result = chat.chat_digest(spark.createDataFrame(rows, SCHEMA))
    assert five(result) == plain(rows + HOSTILE)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.collect()]
    assert five(chat.chat_digest(table)) == plain(rows + HOSTILE)


def test_empty_table(spark):
    assert five(chat.chat_digest(spark.createDataFrame([], SCHEMA))) == plain(HOSTILE)


texts = st.lists(st.sampled_from(["\\", "### ", "</turn>", ": ", "#", " ", "a", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(text=texts, role=texts)
def test_escapes_read_back(text, role):
    assert chat.unescaped(chat.escaped(text)) == text
    assert chat.unescaped(chat.escaped(role, True), True) == role
    ids, mask = chat.turn_tokens(CODER, role, text)
    assert list(ids).count(chat.TURN) == list(ids).count(chat.END) == 1
    assert mask.sum() == 0


@pytest.mark.parametrize("text", ["hello world", "", "### x"])
def test_mask_covers_the_text_alone(text):
    ids, mask = chat.turn_tokens(CODER, "assistant", text)
    assert CODER.decode(ids[mask == 1].tolist()) == chat.escaped(text)


def test_offsets(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    seen = defaultdict(int)
    for r in sorted(chat.with_offsets(chat.format_turns(table)).collect(), key=lambda r: (r["conv_id"], r["turn"])):
        assert r["token_start"] == seen[r["conv_id"]]
        seen[r["conv_id"]] += len(r["ids"])
