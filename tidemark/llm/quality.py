"""Quality rules by host: a document's own failures, weighed by how its host does.

Every document is measured once (DataFrame functions only). Two rules reject a document by
themselves: too few words, too many repeated words. The softer rules (symbols, repeated
lines, odd word lengths) misfire on honest documents, so they count only where they are
common: failures are summed by host, each host's rate is shrunk towards the rate of all
hosts by a beta prior fitted to them, and a host whose shrunk rate reaches ``strict_rate``
is strict for that rule. A document goes if it fails a rule that its host is strict for;
one that fails nothing stays, whatever its host.

Null text has no words, so it fails. Null hosts are one host. Equal rows are judged alike,
each for itself. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import words, written

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; a soft rule matters in hosts of ``strict_rate`` or more."""

    least_words: int = 10
    most_repeated: int = 20  # percent of words
    most_symbols: int = 10  # per hundred words
    most_repeated_lines: int = 30  # percent of lines
    shortest_mean: int = 3  # code points a word
    longest_mean: int = 10
    strict_rate: float = 0.3
    most_strength: float = 1e6  # of the prior, in documents; reached when hosts don't differ

    def base(self) -> Column:
        words_, repeated = F.col("n_words"), F.col("n_repeat_words")
        return (words_ < self.least_words) | (100 * repeated > self.most_repeated * words_)

    def soft(self) -> dict[str, Column]:
        words_, chars = F.col("n_words"), F.col("word_chars")
        return {
            "symbols": 100 * F.col("n_symbols") > self.most_symbols * words_,
            "lines": 100 * F.col("n_dup_lines") > self.most_repeated_lines * F.col("n_lines"),
            "length": (chars < self.shortest_mean * words_) | (chars > self.longest_mean * words_),
        }


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` and the counts of each text. Temporary columns start with ``__``.

    Repeated windows: the hashes of all windows of five words are compared within the
    text. Only where two are equal are they sorted with their places; each place then adds
    the words up to the next place, five at most, so overlaps count once.
    """
    given = df.columns
    whole = F.coalesce(F.col(text), F.lit(""))
    split = df.select(
        *given,
        words(F.col(text)).alias("__words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    at = F.sequence(F.lit(0), F.size("__words") - WINDOW)
    hashes = F.transform(
        at, lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)])
    )
    hashed = split.select(
        *given,
        "n_symbols",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__words") > WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("__hashes"),
    )
    places = F.transform("__hashes", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = hashed.select(
        *given, *[c for c in COUNTS if c != "n_repeat_words"],
        F.when(repeats, F.sort_array(places)).alias("__sorted"),
    )

    def twin(place: Column, i: Column) -> Column:
        before, after = F.get("__sorted", i - 1), F.get("__sorted", i + 1)
        same_before = F.coalesce(before["h"] == place["h"], F.lit(False))
        return same_before | F.coalesce(after["h"] == place["h"], F.lit(False))

    covered = ordered.withColumn(
        "__starts", F.sort_array(F.transform(F.filter("__sorted", twin), lambda p: p["i"]))
    ).drop("__sorted")
    step = F.transform(
        "__starts",
        lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__starts", i + 1) - p, F.lit(WINDOW))),
    )
    repeated = F.aggregate(step, F.lit(0), lambda total, n: total + n)
    return covered.withColumn(
        "n_repeat_words", F.coalesce(repeated, F.lit(0)).cast("long")
    ).drop("__starts")


def host_verdicts(measured: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """One row a host: documents, failures, shrunk rate and strictness of each soft rule.

    The prior's mean is the rate of all documents; its strength comes from how far the
    hosts' rates spread beyond what chance gives (method of moments, weighted by size).
    Only its one row of sums reaches the driver.
    """
    soft = rules.soft()
    hosts = written(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count("*").alias("docs"),
            *[F.count_if(fails).alias(f"failed_{name}") for name, fails in soft.items()],
        ),
        "hosts",
    )
    docs = F.col("docs").cast("double")
    moments = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(docs).alias("docs"),
        F.sum(docs * docs).alias("squares"),
        *[F.sum(f"failed_{name}").alias(f"failed_{name}") for name in soft],
        *[
            F.sum(F.col(f"failed_{name}") * F.col(f"failed_{name}") / docs).alias(f"spread_{name}")
            for name in soft
        ],
    ).first()
    for name in soft:
        mean, strength = _prior(moments, name, rules.most_strength)
        rate = (F.col(f"failed_{name}") + mean * strength) / (F.col("docs") + strength)
        hosts = hosts.withColumn(f"rate_{name}", rate)
        hosts = hosts.withColumn(f"strict_{name}", F.col(f"rate_{name}") >= rules.strict_rate)
    return hosts


def _prior(moments, rule: str, most: float) -> tuple[float, float]:
    """Mean and strength (in documents) of the beta prior of a rule."""
    docs, failed = moments["docs"] or 0.0, moments[f"failed_{rule}"] or 0
    mean = failed / docs if docs else 0.0
    chance = mean * (1 - mean)
    if chance <= 0 or moments["hosts"] < 2:
        return mean, most
    free = moments["hosts"] - 1
    spread = moments[f"spread_{rule}"] - failed * failed / docs
    overlap = (spread - free * chance) / (chance * (docs - moments["squares"] / docs - free))
    if not overlap > 0:
        return mean, most
    return mean, min(most, max(0.0, 1 / overlap - 1))


def judged(measured: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """``measured`` (with the counts) and base_failed, kept: its own rules and its host's.

    ``measured`` is read twice, so give a written table. The hosts join by their column;
    whether they are broadcast is left to Spark, which knows their size.
    """
    verdicts = host_verdicts(measured, host, rules)
    soft = rules.soft()
    strict = verdicts.select(
        F.col("host").alias("__host"), *[F.col(f"strict_{n}").alias(f"__strict_{n}") for n in soft]
    )
    joined = measured.join(strict, measured[host].eqNullSafe(strict["__host"]))
    guilty = F.lit(False)
    for name, fails in soft.items():
        guilty = guilty | (F.col(f"__strict_{name}") & fails)
    return joined.withColumn("base_failed", rules.base()).withColumn(
        "kept", ~F.col("base_failed") & ~guilty
    ).drop(*strict.columns)


def quality_digest(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict of every document."""
    measured = with_counts(documents.select("doc_id", "source", "text")).drop("text")
    out = ["doc_id", *COUNTS[:-1], "base_failed", "kept"]
    return judged(written(measured, "measured"), "source", rules).select(out)


def keep_good(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, all columns as given."""
    whole = documents.select(F.struct("*").alias("__row"), "source", "text")
    measured = written(with_counts(whole).drop("text"), "measured")
    return judged(measured, "source", rules).where("kept").select("__row.*")
