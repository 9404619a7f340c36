"""Chat formatting by tokens: segments coded apart, reserved ids spliced in, masks by prefix sums.

A turn is ``TURN role BODY text END``: three reserved ids around the role's and the text's own
tokens, so nothing in a text can become a mark. Rendered, the ids read ``### ``, ``: `` and
``</turn>`` with a line end; where a text or role holds such a string, a backslash is put before
it (and the backslashes already there, or at the end, are doubled), so the rendered form can be
read back as well. The loss mask of a turn is the running sum of +1 where an assistant's text
starts and -1 where it ends.

One row a turn, so a conversation of any length is never in memory as a whole. Reading back goes
through the turns of a conversation in order, a batch at a time.

Null role or text is empty. Turns are ordered by number (null first), equal ones by their tokens;
repeated rows are turns of their own. Null conv_id is one conversation. Empty in, empty out. Other
columns are not read. Unbroken runs over ``LONGEST`` characters are coded in parts.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of the vocabulary, a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TURN, BODY, END = 50257, 50258, 50259
SHOWN = {TURN: "### ", BODY: ": ", END: "</turn>\n"}
LOSS_ROLE = "assistant"
LONGEST = 1000

_IN_TEXT = r"(\\*)(### |</turn>)"
_IN_ROLE = r"(\\*)(### |</turn>|: )"


def escaped(text: str, role: bool = False) -> str:
    """Reversibly free of the strings that marks are shown as."""
    text = re.sub(r"(\\+)\Z", r"\1\1", text)
    return re.sub(_IN_ROLE if role else _IN_TEXT, r"\1\1\\\2", text)


def unescaped(text: str, role: bool = False) -> str:
    marks = _IN_ROLE if role else _IN_TEXT
    text = re.sub(marks, lambda m: m[1][: len(m[1]) // 2] + m[2], text)
    return re.sub(r"(\\+)\Z", lambda m: m[1][: len(m[1]) // 2], text)


@lru_cache(maxsize=2)
def _coder(ranks: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})


def _coded(coder, text: str) -> list[int]:
    """Tokens of a text; long unbroken runs, which cost their square, in parts."""
    parts = re.split(rf"(\S{{{LONGEST}}}|\s{{{LONGEST}}})", text)
    return [i for part in parts if part for i in coder.encode_ordinary(part)]


def turn_tokens(coder, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one turn."""
    role_ids, text_ids = _coded(coder, escaped(role, True)), _coded(coder, escaped(text))
    segments = [[TURN], role_ids, [BODY], text_ids, [END]]
    starts = np.cumsum([0] + [len(s) for s in segments])
    change = np.zeros(starts[-1] + 1, np.int8)
    if role == LOSS_ROLE:
        change[starts[3]] += 1
        change[starts[4]] -= 1
    return np.concatenate(segments).astype(np.int32), np.cumsum(change[:-1], dtype=np.int8)


def format_turns(conversations: DataFrame, ranks: str = RANKS) -> DataFrame:
    """conv_id, turn, ids, mask (array of 0 and 1) of every row."""

    @F.pandas_udf("ids array<int>, mask array<tinyint>")
    def tokens(role: pd.Series, text: pd.Series) -> pd.DataFrame:
        coder = _coder(ranks)
        rows = [turn_tokens(coder, r or "", t or "") for r, t in zip(role, text, strict=True)]
        return pd.DataFrame({"ids": [r[0] for r in rows], "mask": [r[1] for r in rows]})

    return conversations.select("conv_id", "turn", tokens("role", "text").alias("made")).select(
        "conv_id", "turn", "made.*"
    )


def with_offsets(turns: DataFrame) -> DataFrame:
    """``turns`` with ``token_start``, the tokens of its conversation before each."""
    before = (
        Window.partitionBy("conv_id").orderBy("turn", "ids").rowsBetween(Window.unboundedPreceding, -1)
    )
    return turns.withColumn("token_start", F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)))


class _Reader:
    """What is read back of one conversation."""

    def __init__(self):
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, coder, ids: np.ndarray, mask: np.ndarray) -> None:
        def text(part) -> str:
            return coder.decode_bytes(part.tolist()).decode()

        turn, body, end = (int(np.flatnonzero(ids == mark)[0]) for mark in (TURN, BODY, END))
        role, said = text(ids[turn + 1 : body]), text(ids[body + 1 : end])
        self.turns += 1
        self.chars += len(role) + len(said) + sum(map(len, SHOWN.values()))
        self.all.update(f"{unescaped(role, True)}\n{unescaped(said)}\n".encode())
        learnt = unescaped(text(ids[mask == 1]))
        self.loss_chars += len(learnt)
        self.loss.update(learnt.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def read_back(turns: DataFrame, ranks: str = RANKS) -> DataFrame:
    """One row a conversation, from ids and masks alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, at, reader, done = _coder(ranks), None, None, []

        def out():
            columns = zip(*done, strict=True) if done else [[]] * len(_DIGEST)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _DIGEST_TYPES, strict=True)], names=_DIGEST
            )

        for batch in batches:
            ids, masks = batch.column(1), batch.column(2)
            for i, conv in enumerate(batch.column(0).to_pylist()):
                if reader is None or conv != at:
                    if reader:
                        done.append((at, *reader.row()))
                    at, reader = conv, _Reader()
                reader.add(coder, ids[i].values.to_numpy(), masks[i].values.to_numpy())
            yield out()
            done = []
        if reader:
            done.append((at, *reader.row()))
        yield out()

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "ids")
        .select("conv_id", "ids", "mask")
        .mapInArrow(
            read,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long",
        )
    )


def chat_digest(conversations: DataFrame, ranks: str = RANKS) -> DataFrame:
    """All conversations, and one (-7) whose texts hold the template's own strings."""
    said = r"\### Assistant: </turn> ok"
    hostile = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    given = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    return read_back(format_turns(given.unionByName(hostile), ranks), ranks)
