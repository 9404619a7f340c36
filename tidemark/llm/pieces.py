"""SentencePiece encoding as a relational lattice, and decoding.

A text, with a space before it, is cut into units where no piece of the table can cross:
before spaces, and before a mark that no piece has behind the character there. The best
segmentation of a text is then that of its units (but for the cuts of very long runs, below),
so each distinct unit of the corpus is counted, and solved once:

* the units are dealt out by a hash, and a task takes some thousand at once: their substrings, of
  every length that pieces have, are looked up in the piece table (broadcast; its size is that of
  the vocabulary), by a hash and then by their characters;
* the edges found are folded, place by place for all these units together, into the best path to
  every place (highest sum of scores; of equal ones, the one whose last piece starts first). A
  character that no piece equals is an edge of its UTF-8 bytes, ten below the worst score.

Solved units reach the documents in two ways. The most frequent (``HEAD`` at most, by their
counts over the whole corpus) are broadcast. The rest, mostly words that occur once or twice,
go to groups of documents: a document's group is a hash of it, its rare units are joined with
their ids, go to that group and meet the group's documents, which come compressed. Groups, and
the tasks that solve units, grow in number with the text.

Spaces are coded with the pieces' space mark and read back exactly, also several, leading and
trailing ones; a text's own U+2581 is coded as bytes. Runs of marks or of spaces over ``LONGEST``
characters, and other unbroken runs over eight times that, are cut there, so a unit's lattice is
bounded: a piece that would cross such a cut is lost, and ids may differ there from the best path
of the whole text, though they read back exactly. Null text gives null ids, an empty text none.
Other columns are handed through; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_key, written
from tidemark.sizing import shuffles_removed, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 1 << 18
LONGEST = 256
CHARS_PER_GROUP = 2_000_000
SOLVING_TASKS = 64  # at least; as many as there are groups, if those are more
_HEAD_LENGTH = 32  # characters of a unit of the head, so that its size is bounded
_BYTES_AT_ONCE = 2 << 20  # of texts cut into words, but for one longer text
_BYTES_OUT = 8 << 20  # of texts of a group encoded together
_PLACES_AT_ONCE = 50_000  # of lattices solved together; a unit has at most some 2,300
_BINS = 8  # of counts, by doubling
_LEVEL = 3  # of compression of what is sent to groups
_ROWS_AT_ONCE = 1000  # of texts compressed
_SPACED = re.compile(" ( *[^ ]+| *)")


@dataclass(frozen=True)
class Vocabulary:
    """The pieces (with plain spaces), their ids and scores, and the ids of single bytes."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    first_byte: int
    pattern: str
    marks: str

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @property
    def unknown_score(self) -> float:
        return min(self.scores) - 10.0

    def bytes_of(self) -> dict[int, bytes]:
        known = {i: p.encode() for i, p in zip(self.ids, self.pieces, strict=True)}
        return known | {self.first_byte + b: bytes([b]) for b in range(256)}


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    import sentencepiece

    table = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [
        i
        for i in range(table.get_piece_size())
        if not (table.is_control(i) or table.is_unknown(i) or table.is_byte(i) or table.is_unused(i))
    ]
    pieces = [table.id_to_piece(i).replace("▁", " ") for i in ids]
    if any(" " in p.lstrip(" ") for p in pieces):
        raise ValueError("pieces with a space after other characters are not supported")
    scores = tuple(float(table.get_score(i)) for i in ids)
    first_byte = table.piece_to_id("<0x00>")
    marks = "".join(map(re.escape, _marks(pieces)))
    return Vocabulary(tuple(pieces), tuple(ids), scores, first_byte, unit_pattern(pieces), marks)


def _marks(pieces: list[str]) -> list[str]:
    return sorted({c for p in pieces for c in p if not c.isalnum() and c != " "})


def unit_pattern(pieces: list[str]) -> str:
    """A pattern of units that no piece crosses, but where a run is cut for its length.

    Marks are the characters, no letters or digits, that some piece holds. A unit goes on over a
    mark only behind a character that the mark follows in some piece; it always goes on from a
    mark to what comes after.
    """
    pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
    marks = set(_marks(pieces))
    joined: dict[str, str] = {}  # characters before a mark: the marks that go on behind them
    for mark in sorted(marks):
        before = "".join(re.escape(a) for a in sorted({x[0] for x in pairs if x[1] == mark} - marks - {" "}))
        if before:
            joined[before] = joined.get(before, "") + re.escape(mark)
    some = "".join(map(re.escape, sorted(marks)))
    n = f"{{1,{LONGEST}}}"
    on = "".join(f"|(?<=[{before}])[{behind}]" for before, behind in joined.items())
    word = f"(?:[^ {some}]{n}{on}){{1,8}}"
    return f" {{0,{LONGEST}}}{word}| {{0,{LONGEST}}}[{some}]{n}(?:{word})?| {n}"


def _words(text: str | None) -> list[str]:
    """A text cut at spaces, one of which is left out before each word; none for an empty text."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _SPACED.findall(" " + text)
    return text.split(" ")


def _units(pattern: str):
    """Of a word, or of a whole text: units never go on over a space behind another character."""
    find = re.compile(pattern).findall
    return lambda text: find(" " + text) if text else []


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Some rows after another, whose sizes are ``most`` at most, but for the first of them."""
    part = np.cumsum(sizes, dtype=np.int64) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts, len(part)][1:], strict=True):
        yield batch.slice(start, end - start)


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Some rows after another, by the size of the texts in their first column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy()
    return _slices(batch, sizes, _BYTES_AT_ONCE)


def _cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of some texts, as ``_words`` has them: where those of each text start, and all in a row."""
    lists = pc.split_pattern(texts, " ")
    spaced = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
    slow = pc.fill_null(pc.or_(spaced, pc.equal(texts, "")), True).to_numpy(zero_copy_only=False)
    if slow.any():
        at = np.flatnonzero(slow)
        other = pa.array([_words(t) for t in texts.take(pa.array(at)).to_pylist()], lists.type)
        places = np.arange(len(texts))
        places[at] = len(texts) + np.arange(len(at))
        lists = pa.concat_arrays([lists, other]).take(pa.array(places))
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]), lists.flatten()


def _cutter(pattern: str, marks: str):
    """A function from different words to their units: for each word its place, where its units start, and all units.

    Most words hold no mark and are one unit; only the others are searched for units.
    """
    find, some = re.compile(pattern).findall, f"[ {marks}]"

    def units(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        n = pc.utf8_length(words).to_numpy()
        marked = pc.match_substring_regex(words, some).to_numpy(zero_copy_only=False)
        slow = marked | (n == 0) | (n > LONGEST)
        order = np.argsort(slow, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        plain = words.filter(pa.array(~slow))
        found = [find(" " + w) for w in words.filter(pa.array(slow)).to_pylist()]
        sizes = np.concatenate([np.ones(len(plain), np.int64), np.array([len(f) for f in found], np.int64)])
        flat = pa.array([u for f in found for u in f], pa.string())
        plain = pc.binary_join_element_wise(pa.scalar(" "), plain, "")
        return place, np.concatenate([[0], np.cumsum(sizes)]), pa.concat_arrays([plain, flat])

    return units


def _rows_of(units: pa.Array, known: pa.Array) -> np.ndarray:
    """The row of each of some different units among the known ones (more of them, all different), or -1."""
    at = pc.index_in(known, value_set=units)
    rows = np.full(len(units), -1, np.int64)
    rows[at.drop_null().to_numpy()] = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return rows


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``sizes`` of them."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class _Pieces:
    """The pieces by length: their hashes in order, and with each its characters, id and score."""

    _BASE = 0x9E3779B97F4A7C15  # odd; hashes are modulo 2 ** 64

    def __init__(self, words: Vocabulary):
        self.longest, self.unknown = words.longest, words.unknown_score
        lengths, ids, scores = np.array([len(p) for p in words.pieces]), np.array(words.ids), np.array(words.scores)
        self.of: dict[int, tuple[np.ndarray, ...]] = {}
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            chars = np.frombuffer("".join(words.pieces[i] for i in at).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = sum(chars[:, n - 1 - k] * self.power(k) for k in range(n))
            order = np.argsort(hashes)
            if len(np.unique(hashes)) < len(at):
                raise ValueError("two pieces of one hash")
            at = at[order]
            self.of[n] = hashes[order], chars[order], ids[at].astype(np.int32), scores[at]

    def power(self, k: int) -> np.uint64:
        return np.uint64(pow(self._BASE, k, 1 << 64))

    def edges(self, chars: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that end at each place, the longest first; none: minus infinity, -1.

        Each unit has a place before its first character, so ``places`` counts the characters
        up to a place in its unit.
        """
        scores = np.full((len(chars), self.longest), -np.inf)
        ids = np.full((len(chars), self.longest), -1, np.int32)
        hashes = np.zeros(len(chars), np.uint64)
        for n in range(1, min(self.longest, len(chars)) + 1):
            hashes[n - 1 :] += chars[: len(chars) - n + 1] * self.power(n - 1)
            if n not in self.of:
                continue
            known, spelled, id_, score = self.of[n]
            ends = np.flatnonzero(places >= n)
            at = np.minimum(np.searchsorted(known, hashes[ends]), len(known) - 1)
            same = known[at] == hashes[ends]
            ends, at = ends[same], at[same]
            same = (chars[ends[:, None] + np.arange(1 - n, 1)] == spelled[at]).all(axis=1)
            ends, at = ends[same], at[same]
            scores[ends, self.longest - n], ids[ends, self.longest - n] = score[at], id_[at]
        scores[:, -1] = np.where(ids[:, -1] < 0, self.unknown, scores[:, -1])
        return scores, ids


def _paths(units: pa.Array, pieces: _Pieces, first_byte: int) -> pa.Array:
    """The ids of the best path of every unit."""
    sizes = pc.utf8_length(units).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1  # the place before the first character
    chars = np.zeros(int((sizes + 1).sum()), np.uint64)
    places = _ranges(np.zeros(len(sizes), np.int64), sizes + 1)
    chars[places > 0] = np.frombuffer("".join(units.to_pylist()).encode("utf-32-le"), np.uint32)
    scores, ids = pieces.edges(chars, places)

    best, last = np.zeros(len(chars)), np.zeros(len(chars), np.int64)
    lengths = np.arange(pieces.longest, 0, -1)
    order = np.argsort(-sizes, kind="stable")
    by_size, ordered = starts[order], -sizes[order]
    for place in range(1, int(sizes.max(initial=0)) + 1):
        at = by_size[: np.searchsorted(ordered, -place, side="right")] + place
        sums = best[np.maximum(at[:, None] - lengths, 0)] + scores[at]
        choice = sums.argmax(axis=1)  # the first of equal ones is the longest
        best[at], last[at] = sums[np.arange(len(at)), choice], choice

    used = np.zeros(len(chars), bool)
    at, to = starts + sizes, starts
    while len(at):
        used[at] = True
        at = at - lengths[last[at]]
        at, to = at[at > to], to[at > to]
    used[starts] = False
    used = np.flatnonzero(used)
    found = ids[used, last[used]]

    # Characters that no piece equals become their bytes.
    codes = chars[used].astype(np.int64)
    width = np.where(found < 0, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), 1)
    flat = np.repeat(found, width)
    spelled = "".join(map(chr, codes[found < 0].tolist())).encode()
    flat[flat < 0] = np.frombuffer(spelled, np.uint8).astype(np.int32) + first_byte
    before = np.concatenate([[0], np.cumsum(width)])
    ends = before[np.searchsorted(used, np.append(starts, len(chars)))]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))


def solved(units: DataFrame, words: Vocabulary) -> DataFrame:
    """``units`` (column unit, and others that go with it) with the ids of the best path."""
    table, first_byte = units.sparkSession.sparkContext.broadcast(_Pieces(words)), words.first_byte
    column = units.columns.index("unit")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = pc.add(pc.utf8_length(batch.column(column)), 1)
            for some in _slices(batch, places.to_numpy(), _PLACES_AT_ONCE):
                ids = _paths(some.column(column), table.value, first_byte)
                yield pa.RecordBatch.from_arrays([*some.columns, ids], names=[*some.schema.names, "ids"])

    out = T.StructType([*units.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return units.mapInArrow(solve, out)


def _counts(pattern: str, marks: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cutter(pattern, marks)
        for batch in batches:
            for some in _text_slices(batch):
                _, words = _cut(some.column(0))
                seen = words.value_counts()
                place, starts, units = cut(seen.field("values"))
                times = np.empty(len(place), np.int64)
                times[place] = seen.field("counts").to_numpy()
                rows = pa.table({"unit": units, "n": np.repeat(times, np.diff(starts))})
                rows = rows.group_by("unit", use_threads=False).aggregate([("n", "sum")])
                yield from rows.select(["unit", "n_sum"]).rename_columns(["unit", "n"]).to_batches()

    return count


def counted(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """Every distinct unit of the texts, and how often it occurs."""
    found = texts.mapInArrow(_counts(words.pattern, words.marks), "unit string, n long")
    return found.groupBy("unit").agg(F.sum("n").alias("times"))


def frequent(units: DataFrame, most: int = HEAD) -> DataFrame:
    """Of ``units`` with their ``times``, the ``most`` frequent, or somewhat fewer: all those above one count."""
    bin_ = F.floor(F.log2("times") * _BINS).cast("int")
    known = units.where("times > 1").where(F.length("unit") <= _HEAD_LENGTH).withColumn("bin", bin_)
    least, total = 0, 0
    for row in known.groupBy("bin").count().orderBy(F.desc("bin")).collect():  # under 64 * _BINS rows
        total += row["count"]
        if total > most:
            least = row["bin"] + 1
            break
    return known.where(F.col("bin") >= least).drop("bin")


def _rare(pattern: str, marks: str, head):
    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, (known, _) = _cutter(pattern, marks), head.value
        for batch in batches:
            for some in _text_slices(batch):
                ends, words = _cut(some.column(0))
                words = words.dictionary_encode()
                place, starts, units = cut(words.dictionary)
                units = units.dictionary_encode()
                new = _rows_of(units.dictionary, known) < 0
                unit = units.indices.to_numpy()
                at = np.concatenate([[0], np.cumsum(new[unit])])
                sizes = np.diff(at[starts])  # new units of each word
                unit = unit[new[unit]]
                # Words with new units, once for each group; then their units, once for each group.
                word = place[words.indices.to_numpy()]
                group = np.repeat(some.column(1).to_numpy().astype(np.int64), np.diff(ends))[sizes[word] > 0]
                pairs = np.unique(group * len(sizes) + word[sizes[word] > 0])
                group, word = pairs // len(sizes), pairs % len(sizes)
                group, unit = np.repeat(group, sizes[word]), unit[_ranges(at[starts][word], sizes[word])]
                pairs = np.unique(group * len(new) + unit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pairs // len(new)).astype(np.int32)), units.dictionary.take(pa.array(pairs % len(new)))],
                    names=["group", "unit"],
                )

    return rare


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group, row, text to group, row, compressed text."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=_LEVEL).compress
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            rows = batch.slice(at, _ROWS_AT_ONCE)
            packed = [None if t is None else pack(t.encode()) for t in rows.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(packed, pa.binary())], names=["group", "row", "packed"]
            )


def _compress_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group, unit, ids, ordered by group, to group and its compressed units, some to a row.

    Packed are their number, bytes of each unit, ids of each, then all units and all ids.
    """
    import zstandard

    pack = zstandard.ZstdCompressor(level=_LEVEL).compress
    for batch in batches:
        groups, units, ids = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
        starts = np.flatnonzero(np.diff(groups, prepend=-1)).tolist()
        packed = []
        for start, end in zip(starts, [*starts, len(groups)][1:], strict=True):
            some, of = units.slice(start, end - start), ids.slice(start, end - start)
            sizes = np.array([len(some)]), pc.binary_length(some).to_numpy(), of.value_lengths().to_numpy()
            numbers = b"".join(x.astype(np.int32).tobytes() for x in sizes)
            together = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), "")[0].as_buffer().to_pybytes()
            packed.append(pack(numbers + together + of.flatten().to_numpy().tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups[starts], pa.int32()), pa.array(packed, pa.binary())], names=["group", "packed"]
        )


def _unpacked_units(raw: bytes) -> tuple[pa.Array, pa.Array]:
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    sizes = np.frombuffer(raw, np.int32, 2 * n, 4)
    ends = np.concatenate([[0], np.cumsum(sizes[:n])]).astype(np.int32)
    id_ends = np.concatenate([[0], np.cumsum(sizes[n:])]).astype(np.int32)
    at = 4 * (2 * n + 1)
    units = pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(raw[at : at + ends[-1]]))
    ids = np.frombuffer(raw[at + ends[-1] :], np.int32)
    return units, pa.ListArray.from_arrays(pa.array(id_ends), pa.array(ids))


def _ids_of(texts: pa.Array, cut, known: pa.Array, ids: pa.Array) -> pa.Array:
    """The ids of each text, from those of the units that are known; null for null."""
    ends, words = _cut(texts)
    words = words.dictionary_encode()
    place, starts, units = cut(words.dictionary)
    units = units.dictionary_encode()
    at = _rows_of(units.dictionary, known)
    if (at < 0).any():
        raise KeyError("a unit that was not solved")
    of_units = ids.take(pa.array(at[units.indices.to_numpy()]))
    unit_ends = np.concatenate([[0], np.cumsum(of_units.value_lengths().to_numpy())])
    of_words = pa.ListArray.from_arrays(pa.array(unit_ends[starts].astype(np.int32)), of_units.flatten())
    coded = of_words.take(pa.array(place[words.indices.to_numpy()]))
    word_ends = np.concatenate([[0], np.cumsum(coded.value_lengths().to_numpy())])
    missing = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
    offsets = pa.array(word_ends[ends].astype(np.int32), mask=missing)
    return pa.ListArray.from_arrays(offsets, coded.flatten())


def _assemble(pattern: str, marks: str, head, finish):
    def assemble(documents: pa.Table, solved_units: pa.Table) -> pa.Table:
        """The documents of a group, with the ids of its own units and of the head."""
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        own = [_unpacked_units(unpack(packed.as_py())) for packed in solved_units.column("packed")]
        units, ids = map(pa.concat_arrays, zip(*own, head.value, strict=True))
        cut, rows, out = _cutter(pattern, marks), documents.column("row").combine_chunks(), []

        def done(texts: list) -> None:
            start = sum(batch.num_rows for batch in out)
            some = pa.array(texts, pa.string())
            out.append(finish(rows.slice(start, len(texts)), some, _ids_of(some, cut, units, ids)))

        texts, size = [], 0
        for packed in documents.column("packed"):
            raw = None if packed.as_py() is None else unpack(packed.as_py())
            texts.append(None if raw is None else raw.decode())
            size += len(raw or b"")
            if size > _BYTES_OUT:
                done(texts)
                texts, size = [], 0
        if texts or not out:
            done(texts)
        return pa.Table.from_batches(out)

    return assemble


def _encoded(rows: pa.Array, texts: pa.Array, ids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows, texts, ids], names=["row", "text", "ids"])


def encode(docs: DataFrame, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if none are named) of every row, its text, and its ids."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "text"]
    out = T.StructType().add("text", T.StringType()).add("ids", T.ArrayType(T.IntegerType()))
    return _assembled(docs, model, keep, _encoded, out)


def _assembled(docs: DataFrame, model: str, keep: list[str], finish, made: T.StructType) -> DataFrame:
    """``keep`` and what ``finish`` makes of the rows, texts and ids of a group."""
    spark, words = docs.sparkSession, vocabulary(model)
    texts = docs.where("text IS NOT NULL AND text != ''").select("text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-chars // CHARS_PER_GROUP))

    # Dealt out by unit before their substrings are made, so edges need no shuffle.
    distinct = counted(texts, words).repartition(max(SOLVING_TASKS, groups), "unit")
    with shuffles_removed(spark), small_batches(spark):
        units = written(solved(distinct, words), "units")
    first = frequent(units).select("unit", "ids").toArrow()
    kinds = {"unit": pa.string(), "ids": pa.list_(pa.int32())}
    head = spark.sparkContext.broadcast(tuple(first.column(c).combine_chunks().cast(t) for c, t in kinds.items()))
    del first

    id_ = F.col("doc_id") if "doc_id" in docs.columns else F.lit(0)
    group = F.pmod(F.xxhash64(id_, text_key(F.col("text"))), F.lit(groups)).cast("int").alias("group")
    rare = (
        docs.where("text IS NOT NULL AND text != ''")
        .select("text", group)
        .mapInArrow(_rare(words.pattern, words.marks, head), "group int, unit string")
        .repartition(min(groups, max(SOLVING_TASKS // 4, groups // 32)), "unit")
        .dropDuplicates(["group", "unit"])
    )
    # Few tasks, so that each has several units for a group.
    rare = rare.join(units.select("unit", "ids"), "unit").select("group", "unit", "ids")
    rare = rare.sortWithinPartitions("group").mapInArrow(_compress_units, "group int, packed binary")
    with shuffles_removed(spark), small_batches(spark):
        rare = written(rare, "rare-units").repartition(groups, "group")
    row = F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))
    given = docs.select(group, row.alias("row"), "text")
    row_type = given.schema["row"].dataType
    packed = given.mapInArrow(
        _compress, T.StructType().add("group", T.IntegerType()).add("row", row_type).add("packed", T.BinaryType())
    )
    out = T.StructType([T.StructField("row", row_type), *made.fields])
    # The units are partitioned by group already: only the documents are shuffled here.
    done = packed.groupBy("group").cogroup(rare.groupBy("group")).applyInArrow(
        _assemble(words.pattern, words.marks, head, finish), out
    )
    return done.select(*[F.col("row")[c].alias(c) for c in keep], *made.names)


@lru_cache(maxsize=2)
def _bytes_table(model: str) -> pa.Array:
    spell = vocabulary(model).bytes_of()
    return pa.array([spell.get(i) for i in range(max(spell) + 1)], pa.binary())


def _joined(table: pa.Array, ids: pa.Array) -> pa.Array:
    """The bytes that each row of ids spells, with the space put before a text when it was coded."""
    pieces = table.take(ids.flatten())
    if pieces.null_count:
        raise KeyError("an id that the table lacks")
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(ids.value_lengths(), 0).to_numpy())]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces), b"")


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text of ids; null for null. Ids that the table lacks fail."""

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        spelled = pc.binary_slice(_joined(_bytes_table(model), ids), 1).cast(pa.string())
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), spelled)

    return text(ids)


def _digested(model: str):
    """In place of texts and ids: number and hash of the ids, and whether they read back."""

    def digested(rows: pa.Array, texts: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        import xxhash

        counts, flat = ids.value_lengths(), ids.flatten().to_numpy()
        ends = np.cumsum(pc.fill_null(counts, 0).to_numpy()).tolist()
        hashes = [
            None if n is None else xxhash.xxh64_hexdigest(flat[end - n : end].tobytes())
            for n, end in zip(counts.to_pylist(), ends, strict=True)
        ]
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        given = pc.if_else(pc.equal(texts, ""), texts, spaced).cast(pa.binary())
        same = pc.fill_null(pc.equal(_joined(_bytes_table(model), ids), given), True)
        made = [counts.cast(pa.int64()), pa.array(hashes, pa.string()), same]
        return pa.RecordBatch.from_arrays([rows, *made], names=["row", "n_pieces", "ids_xxh64", "lossless"])

    return digested


def piece_digest(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """Number and hash of the pieces of every document, and whether they read back exactly."""
    out = T.StructType().add("n_pieces", T.LongType()).add("ids_xxh64", T.StringType())
    found = _assembled(documents, model, ["doc_id"], _digested(model), out.add("lossless", T.BooleanType()))
    with small_batches(documents.sparkSession):
        return written(found, "digest")


def encoded_documents(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, lang, source, ids of every document."""
    keep = [c for c in documents.columns if c in ("doc_id", "lang", "source")]
    return encode(documents, model, keep).drop("text")
