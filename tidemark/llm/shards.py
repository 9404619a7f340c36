"""K-d tree shards: cut the corpus by its metadata until every leaf holds the target bytes.

Only DataFrame functions. Each row becomes a few numbers once (size, checksum, one
coordinate per metadata dimension); the tree is then grown level by level over that narrow
table. A node is cut along the dimension that is widest in it (relative to the whole
table) at the weighted quantile that gives each side its share of the leaves. The
quantiles of a level are found together: histograms of a bounded number of bins by node
are summed by Spark, and the bin that holds the cut is divided again until the cut is
within ``tolerance``. The driver sees histograms and cuts only.

A coordinate is the dimension's value, the smallest among the copies of a text, followed by
31 bits of the text's hash, so ties in a dimension can be cut and equal texts stay together.
Texts whose copies weigh more than 1/``GROUPS`` of a leaf (so at most ``GROUPS`` times the
leaves of them), and more than the largest row or a quarter of a leaf, are cut by their own
values and a hash of the row instead: no group of copies makes a leaf too large.

Null text weighs the overhead only; a null or NaN dimension counts as its smallest value,
infinities as the ends of the finite ones; null ids and equal rows are placed like any others; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bucket_count, running, text_key, written

OVERHEAD = 16  # bytes of a row besides its text
BINS = 1024
GROUPS = 50
TIE_BITS = 31
_LARGEST = (1 << 32) - 1
_HIGHEST = (1 << 63) - 1


def _number(df: DataFrame, name: str) -> Column | None:
    """A dimension that has an order, as a number; NaN counts as null."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("double")
    if isinstance(kind, T.NumericType):
        number = F.col(name).cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(F.col(name).cast("timestamp"), "UTC")).cast("double")
    return None


def _values(df: DataFrame, dimensions: list[str]) -> list[Column]:
    """The dimensions as whole numbers from 0 to 2^32 - 1, in their own order.

    Numbers, dates and times are scaled from their least to their greatest finite value
    (whole numbers that span less stay apart by as much); infinities count as those. Text
    counts by its checksum.
    """
    numbers = [_number(df, name) for name in dimensions]
    ends = [
        end
        for i, number in enumerate(numbers)
        if number is not None
        for finite in [F.when(F.abs(number) < F.lit(float("inf")), number)]
        for end in (F.min(finite).alias(f"low{i}"), F.max(finite).alias(f"high{i}"))
    ]
    found = df.agg(*ends).first() if ends else None
    out = []
    for i, (name, number) in enumerate(zip(dimensions, numbers)):
        if number is None:
            scaled = F.crc32(F.col(name).cast("string"))
        elif found[f"low{i}"] is None:  # no finite number
            scaled = F.when(number > 0, F.lit(_LARGEST)).otherwise(F.lit(0))
        else:
            low, high = found[f"low{i}"], found[f"high{i}"]
            # Halves, as the difference of two large numbers may be no finite one.
            half = high / 2 - low / 2
            whole = isinstance(df.schema[name].dataType, T.IntegralType) and 2 * half <= _LARGEST
            place = (F.least(F.greatest(number, F.lit(low)), F.lit(high)) / 2 - low / 2) / (half or 1.0)
            scaled = F.round(place * (2 * half if whole else _LARGEST))
        out.append(F.coalesce(scaled, F.lit(0)).cast("long"))
    return out


def narrow(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    text = F.col("text")
    return written(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            text_key(text).alias("text_key"),
            *[value.alias(f"d{i}") for i, value in enumerate(_values(docs, dimensions))],
            F.monotonically_increasing_id().alias("row"),  # pinned by the write
        ),
        "narrow",
    )


def _of_node(values: dict[int, int]) -> Column:
    """The value given for a row's node, or null: looked up in an array that goes with the plan.

    A broadcast of as few rows would be a job, and a table in the driver's memory, each time.
    """
    dense = ",".join(str(values.get(node, "")) for node in range(max(values) + 1))
    return F.get(F.split(F.lit(dense), ",").try_cast("array<long>"), F.col("node").cast("int"))


def _along(axis: Column, dimensions: int) -> Column:
    """The coordinate of a row along the dimension that ``axis`` names."""
    chosen = F.col("c0")
    for i in range(1, dimensions):
        chosen = F.when(axis == i, F.col(f"c{i}")).otherwise(chosen)
    return chosen


def _descend(rows: DataFrame, searches: list[_Search], dimensions: int) -> DataFrame:
    """Rows of the nodes that were cut move on to one of their two sides."""
    axis = _of_node({s.node: s.axis for s in searches})
    largest = _of_node({s.node: min(s.cut, _HIGHEST) for s in searches})
    lower, upper = (_of_node({s.node: s.sides()[i][0] for s in searches}) for i in (0, 1))
    side = F.when(_along(axis, dimensions) <= largest, lower).otherwise(upper)
    return rows.withColumn("node", F.coalesce(side, F.col("node")))


def grow(rows: DataFrame, dimensions: int, leaves: int, tolerance: float) -> DataFrame:
    """``rows`` (size and coordinates c0, c1, ...) with the leaf of each in ``node``.

    The rows of a level are written, so the plans of all levels are equally small.
    """
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    frontier = {0: leaves} if leaves > 1 else {}
    widest = None
    while frontier:
        stats = rows.groupBy("node").agg(
            F.sum("size").alias("size"),
            *[F.min(f"c{i}").alias(f"low{i}") for i in range(dimensions)],
            *[F.max(f"c{i}").alias(f"high{i}") for i in range(dimensions)],
        )
        searches = []
        for row in stats.collect():  # at most one row a leaf
            spans = [row[f"high{i}"] - row[f"low{i}"] for i in range(dimensions)]
            widest = widest or [max(1, x) for x in spans]
            if row["node"] in frontier:
                axis = max(range(dimensions), key=lambda i: spans[i] / widest[i])
                n = frontier[row["node"]]
                searches.append(
                    _Search(
                        row["node"], n, axis, row[f"low{axis}"], row[f"high{axis}"],
                        row["size"] * (n // 2) / n, row["size"],
                    )
                )
        if not searches:  # no rows
            break
        _find_cuts(rows, dimensions, searches, tolerance)
        rows = written(_descend(rows, searches, dimensions), "level")
        sides = [side for s in searches for side in s.sides()]
        frontier = {first: n for first, n in sides if n > 1}
    return rows


#: Bytes of the rows of a bin, their least and their greatest coordinate.
Bin = tuple[int, int, int]


@dataclass
class _Search:
    """The range that holds the cut of a node with ``leaves`` leaves, and the bytes below it."""

    node: int  # its first leaf
    leaves: int
    axis: int
    low: int
    high: int
    share: float
    size: int
    below: int = 0
    cut: int | None = None

    @property
    def step(self) -> int:
        return (self.high - self.low) // BINS + 1

    def narrowed(self, bins: dict[int, Bin], tolerance: float) -> None:
        """Go on within the bin where the running sum passes the share, or cut at its edge.

        While all rows of that bin fall into one of the bins it is divided into, those need
        no pass over the rows.
        """
        while self.cut is None:
            held = self._within(bins, tolerance)
            if held is None:
                return
            _, first, last = held
            k = (first - self.low) // self.step
            if k != (last - self.low) // self.step:
                return
            bins = {k: held}

    def _within(self, bins: dict[int, Bin], tolerance: float) -> Bin | None:
        """The bin that holds the cut, now the range of the search; none if the cut is found."""
        total = self.below
        for k in sorted(bins):
            start, end = self.low + k * self.step, self.low + (k + 1) * self.step - 1
            after = total + bins[k][0]
            if after >= self.share:
                if after - self.share <= tolerance * self.size:
                    self.cut = end
                elif self.share - total <= tolerance * self.size:
                    self.cut = start - 1
                elif self.step == 1:  # one coordinate: the nearer side
                    self.cut = end if after - self.share < self.share - total else start - 1
                else:
                    self.below, self.low, self.high = total, start, min(end, self.high)
                    return bins[k]
                return None
            total = after
        self.cut = self.high
        return None

    def sides(self) -> list[tuple[int, int]]:
        half = self.leaves // 2
        return [(self.node, half), (self.node + half, self.leaves - half)]


def _find_cuts(rows, dimensions: int, searches: list[_Search], tolerance: float) -> None:
    """Divide the ranges of all searches, a pass over ``rows`` a time, until each has its cut."""
    while searches:
        axis = _of_node({s.node: s.axis for s in searches})
        low = _of_node({s.node: s.low for s in searches})
        high = _of_node({s.node: s.high for s in searches})
        step = _of_node({s.node: s.step for s in searches})
        bins = (
            rows.withColumns({"at": _along(axis, dimensions), "low": low, "high": high, "step": step})
            .where("at BETWEEN low AND high")
            .groupBy("node", F.expr("(at - low) DIV step").alias("bin"))
            .agg(F.sum("size").alias("size"), F.min("at").alias("first"), F.max("at").alias("last"))
        )
        found: dict[int, dict[int, Bin]] = {s.node: {} for s in searches}
        for row in bins.collect():  # at most BINS rows a node
            found[row["node"]][row["bin"]] = row["size"], row["first"], row["last"]
        for s in searches:
            s.narrowed(found[s.node], tolerance)
        searches = [s for s in searches if s.cut is None]


def kd_shards(
    docs: DataFrame,
    dimensions: list[str],
    shards: int | None = None,
    target_bytes: int | None = None,
    tolerance: float = 0.001,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (a gapless place in its shard) of every row.

    Give the number of ``shards``, or the bytes a leaf should reach.
    """
    rows = narrow(docs, dimensions)
    total = rows.agg(
        F.sum("size").alias("size"), F.max("size").alias("largest"), F.count("*").alias("rows")
    ).first()
    size = total["size"] or 0
    leaves = shards or max(1, round(size / target_bytes))
    # A group no larger than the largest row unbalances shards no more than that row does.
    light = max(size / (leaves * GROUPS), min(total["largest"] or 0, size / (leaves * 4)))
    heavy = [
        row["text_key"]
        for row in rows.groupBy("text_key")
        .agg(F.sum("size").alias("size"))
        .where(F.col("size") > light)
        .collect()  # at most leaves * GROUPS rows
    ]
    # Rows of the same group share a key and, by it, their coordinates.
    group = F.when(
        F.col("text_key").isin(heavy), F.xxhash64("doc_id", "row", "text_key")
    ).otherwise(F.col("text_key"))
    tie = F.col("group").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    grouped = rows.withColumn("group", group)
    # Combined before the shuffle, however many rows a group has; the join may split it.
    least = grouped.groupBy(F.col("group").alias("of")).agg(
        *[F.min(f"d{i}").alias(f"least{i}") for i in range(len(dimensions))]
    )
    placed = written(
        grouped.join(least, grouped["group"] == least["of"]).select(
            "doc_id", "size", "text_crc32", "text_key", "row",
            *[
                F.shiftleft(f"least{i}", TIE_BITS).bitwiseOR(tie).alias(f"c{i}")
                for i in range(len(dimensions))
            ],
        ),
        "placed",
    )
    leaf = grow(placed, len(dimensions), leaves, tolerance)
    sharded = leaf.select(
        "doc_id", "size", "text_crc32", "text_key", "row",
        F.col("node").alias("shard"), F.lit(1).alias("__one"),
    )
    numbered = running(
        sharded, "shard", "__one", ["text_key", "row"], "slot", bucket_count(total["rows"] or 0)
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int"), F.col("slot").cast("long")
    )


def shard_digest(documents: DataFrame) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return kd_shards(documents, ["n_chars", "lang", "source"], shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
