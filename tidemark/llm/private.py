"""Personal data and secrets: fixed patterns, a semi-Markov conditional random field for the rest.

The fixed patterns take the leftmost longest run and give up on it when its check fails: two
cards in a row are no card, a phone number followed by an address is no phone number. They do not
read a number without its plus, an address with ``[at]``, or a key. The model reads such places
as a whole. Around every digit or at-mark it takes the unbroken chunks that stand one space apart
(a region; a lone at-mark takes its neighbours in), cuts them into tokens and scores every segment
of up to ``LONGEST`` tokens and ``WIDEST`` characters, as a whole, for every kind: its shape, digit
count, checks (Luhn, octets), first and last character, neighbours, and the name it is assigned to.
Dynamic programming over the ends of segments chooses boundaries and kinds together. A predicted
span is added if it overlaps no span of the fixed patterns and passes its kind's check.

The weights are fitted by gradient on three sets of regions, a few hundred short ones on the driver:

* those of a bounded sample (``SAMPLE`` different texts with a digit or ``@``, those of smallest
  hash), labelled by the fixed patterns where none of them failed;
* copies of them whose spans are written otherwise (``altered``): without a plus, with dots,
  slashes, ``[.]``, ``(at)``, spaces around the ``@``;
* ``SECRETS`` made pairs of a random value under a name such as ``api_key``, which is a secret, and
  under another name or none, which is not. A secret here is a run of 16 letters and digits or more.

Null text is empty and has no spans; equal rows have equal spans; an empty table gives no rows.
Patterns are linear in the text's length, and so is decoding, in memory that does not grow with an
unbroken region but for the spans in it. Other columns are not read.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lowest

PATTERNS = ("email", "ip", "card", "phone")
KINDS = (*PATTERNS, "secret")
SAMPLE = 4_000
REGIONS = 600
EPOCHS = 4
SECRETS = 80
COPIES = 2
LONGEST = 18
WIDEST = 256
RATE = 0.2
DECAY = 1e-4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
_AT = re.compile(r"@|[\[(](?:at|AT)[\])]")
_MASKED_AT = re.compile(r" ?(?:@|[\[(](?:at|AT)[\])]) ?")
_MASKED_DOT = re.compile(r" ?[\[(](?:dot|DOT|\.)[\])] ?")
_RUN = re.compile(r"(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{16,}")
_TOKEN = re.compile(
    _RUN.pattern + r"|[\[(](?:at|AT|dot|DOT|\.)[\])]|[A-Za-z]+|[0-9]+|[^\S\n]|\S", re.ASCII
)
_NAME = re.compile(r"([A-Za-z][A-Za-z0-9_.-]*)[\"']? ?(?::|=|=>|:=) ?[\"']?$|(?:^|[^A-Za-z])([Bb]earer) $")
#: Words in the name of a secret.
_SECRET_NAMES = (
    "token", "secret", "password", "passwd", "pwd", "passphrase", "credential", "credentials", "auth", "bearer",
    "key", "apikey",
)
_SPACE = re.compile(r"\s")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """From each ``@``: back over the local part, on over the domain; never back over a match."""
    out, least = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            least = domain.end()
        at = text.find("@", max(at + 1, least))
    return out


def _unmasked(text: str) -> str:
    """``a [at] b [dot] c`` and ``1[.]2`` as they are meant."""
    return _MASKED_DOT.sub(".", _MASKED_AT.sub("@", text))


def _is_address(text: str) -> bool:
    name, _, host = text.partition("@")
    return bool(name) and set(name) <= _LOCAL and bool(_DOMAIN.fullmatch(host))


def _checked(kind: str, text: str) -> bool:
    if kind == "email":
        return _is_address(_unmasked(text))
    if kind == "secret":
        return bool(_RUN.search(text)) and not _SPACE.search(text)
    if kind == "ip":
        text = _unmasked(text).replace(" ", "")
        if "." in text and text.replace(".", "") != digits_of(text):
            return False
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))
    digits = digits_of(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text: str) -> tuple[list[tuple], list[tuple]]:
    """The (kind, start, end) that hold, and those whose check failed."""
    good = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    bad = []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            (good if _checked(kind, m.group()) else bad).append((kind, m.start(), m.end()))
    return good, bad


def regions(text: str) -> list[tuple[int, int]]:
    """Chunks with a digit or an at-mark, those one space apart together.

    A lone at-mark takes in the chunks beside it, and what is joined to them by lone dots.
    """
    out: list[tuple[int, int]] = []
    m = _ANCHOR.search(text)
    while m:
        least = out[-1][1] if out else 0
        start, end = _chunk_start(text, m.start(), least), _chunk_end(text, m.start())
        if _AT.fullmatch(text, start, end):
            if start > least + 1 and text[start - 1] == " ":
                start = _chunk_start(text, start - 1, least)
            end = _next_chunk(text, end)
            while end + 2 < len(text) and _MASKED_DOT.fullmatch(text, end, _next_chunk(text, end)):
                end = _next_chunk(text, _next_chunk(text, end))
        if out and start - out[-1][1] == 1 and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        m = _ANCHOR.search(text, end)
    return out


def _chunk_start(text: str, at: int, least: int) -> int:
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def _chunk_end(text: str, at: int) -> int:
    space = _SPACE.search(text, at)
    return space.start() if space else len(text)


def _next_chunk(text: str, end: int) -> int:
    """The end of the chunk one space behind ``end``; ``end`` itself, if there is none."""
    if text[end : end + 1] == " " and end + 1 < len(text) and not text[end + 1].isspace():
        return _chunk_end(text, end + 1)
    return end


def _likely(text: str, start: int, end: int) -> bool:
    """Whether a segment with an at-mark or four digits can be an entity at all: the rest is
    scored as outside only."""
    first = text[start]
    return 5 <= end - start <= WIDEST and text[end - 1].isalnum() and (first.isalnum() or first in "+(")


def features(text: str, start: int, end: int) -> list[str]:
    """What is seen of a segment as a whole."""
    part = text[start:end]
    digits = digits_of(part)
    runs = _RUN.findall(part)
    shape = _RUN.sub("#", part) if runs else part
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[0-9]+", "9", shape.lower()))
    meant = _unmasked(part)
    octets = [p.strip(" ") for p in meant.split(".")]
    found = [
        "bias",
        f"shape={shape[:14]}",
        f"digits={min(len(digits), 20)}",
        f"first={'9' if part[0].isdigit() else 'a' if part[0].isalpha() else part[0]}",
        f"before={_side(text, start - 1)}",
        f"after={_side(text, end)}",
    ]
    if digits and not re.search("[A-Za-z@]", part):
        found.append(f"luhn={luhn(digits)},{13 <= len(digits) <= 19},{part[0] == '+'}")
        found.append(f"count={9 <= len(digits) <= 15},{part[0] == '+'}")
        groups = re.findall("[0-9]+", part)
        sizes = f"{[min(len(g), 6) for g in groups[-3:]]},{min(len(groups), 5)}"
        found.append(f"groups={sizes}")
        # Alone, and not the end of a longer number.
        found.append(f"alone={sizes},{9 <= len(digits) <= 15},{_side(text, start - 1)},{_side(text, end)}")
    if len(octets) == 4 and digits and all(p and p == digits_of(p) for p in octets):
        found.append(f"octets={_checked('ip', part)}")
    if "@" in meant:
        found.append(f"address={_is_address(meant)},{bool(_MASKED_DOT.match(text, end))}")
    if runs:
        named = _named(text, start)
        found.append(f"named={named}")
        found.append(f"run={len(runs)},{runs[0] == part},{min(len(part) // 8, 5)}")
        found.append(f"secret={named == 'secret' and len(runs) == 1},{' ' in part},{_side(text, end)}")
    found.append(f"spaces={min(part.count(' '), 3)}")
    return found


def _named(text: str, start: int) -> str:
    """What a value at ``start`` is assigned to: a name of secrets, another, or none."""
    m = _NAME.search(text[max(0, start - 48) : start])
    if not m:
        return "none"
    words = re.findall("[A-Z]?[a-z]+|[A-Z]+", m.group(1) or m.group(2))
    return "secret" if any(w.lower() in _SECRET_NAMES for w in words) else "other"


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "space"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


def tokens_of(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    return ((m.start(), m.end()) for m in _TOKEN.finditer(text, start, end))


def best_spans(text: str, start: int, end: int, weights: dict[str, list[float]]) -> list[tuple]:
    """The spans of the best segmentation of a region; of equal ones, the one found first.

    ``weights`` has the weights of a feature for all kinds. The dynamic program goes on token
    by token and keeps the last ``LONGEST`` of its columns: the starts of tokens, the best
    scores, and the spans that led there as a chain, which others share. So memory does not
    grow with a region but for the spans in it.
    """
    starts: deque[tuple[int, int, bool]] = deque(maxlen=LONGEST)  # with digits, and whether an @
    scores: deque[float] = deque([0.0], maxlen=LONGEST)
    chains: deque[tuple | None] = deque([None], maxlen=LONGEST)
    for a, b in tokens_of(text, start, end):
        token = text[a:b]
        starts.append((a, len(digits_of(token)), bool(_AT.fullmatch(token))))
        # Without a span, the token is outside; a span must be better than that.
        top, chain = scores[-1], chains[-1]
        digits, has_at = 0, False
        for back in range(-1, -len(starts) - 1, -1) if token.isalnum() else ():
            first, count, is_at = starts[back]
            digits, has_at = digits + count, has_at or is_at
            if (digits >= 4 or has_at) and _likely(text, first, b):
                before = scores[back]
                given = [weights[f] for f in features(text, first, b) if f in weights]
                for kind, score in zip(KINDS, map(sum, zip(*given))):
                    if before + score > top:
                        top, chain = before + score, ((kind, first, b), chains[back])
        scores.append(top)
        chains.append(chain)
    out, at = [], chains[-1]
    while at:
        out.append(at[0])
        at = at[1]
    return out[::-1]


def by_feature(weights: dict[tuple[str, str], float]) -> dict[str, list[float]]:
    """Of each feature, its weights for all kinds."""
    out: dict[str, list[float]] = {}
    for (kind, feature), weight in weights.items():
        out.setdefault(feature, [0.0] * len(KINDS))[KINDS.index(kind)] = weight
    return out


class Lattice:
    """The segments of a region to learn from: (first token, end token, kind or None, features)."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.tokens = list(tokens_of(text, start, end))
        self.ending: list[list[tuple]] = [[] for _ in range(len(self.tokens) + 1)]
        for i, (a, _) in enumerate(self.tokens):
            self.ending[i + 1].append((i, None, ()))
            for j in range(i, min(i + LONGEST, len(self.tokens))):
                b = self.tokens[j][1]
                part = text[a:b]
                if (_AT.search(part) or len(digits_of(part)) >= 4) and _likely(text, a, b):
                    seen = features(text, a, b)
                    self.ending[j + 1] += [(i, kind, seen) for kind in KINDS]

    def scored(self, weights) -> list[list[tuple]]:
        return [
            [(i, kind, sum(weights.get((kind, f), 0.0) for f in seen) if kind else 0.0, seen) for i, kind, seen in row]
            for row in self.ending
        ]

    def learn(self, weights, gold: set[tuple], rate: float) -> None:
        """One step along the gradient of the log-likelihood: what is there less what is expected."""
        rows = self.scored(weights)
        n = len(self.tokens)
        ahead = [0.0] + [0.0] * n
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[i] + s for i, _, s, _ in rows[j]])
        behind = [-math.inf] * n + [0.0]
        for j in range(n, 0, -1):
            for i, _, s, _ in rows[j]:
                behind[i] = _log_sum([behind[i], s + behind[j]])
        for j in range(1, n + 1):
            for i, kind, s, seen in rows[j]:
                if not kind:
                    continue
                there = (kind, self.tokens[i][0], self.tokens[j - 1][1]) in gold
                step = rate * (there - math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n])))
                if abs(step) > 1e-6:
                    for f in seen:
                        weights[kind, f] += step - rate * DECAY * weights[kind, f]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def examples(texts: list[str]) -> list[tuple[Lattice, set[tuple]]]:
    """Regions in which no pattern failed a check or crosses another, and their spans."""
    out = []
    for text in texts:
        good, bad = base_spans(text)
        for a, b in regions(text):
            inside = sorted((s for s in good if s[1] < b and s[2] > a), key=lambda s: s[1])
            failed = [s for s in bad if s[1] < b and s[2] > a and (s[0] != "card" or len(digits_of(text[s[1]:s[2]])) > 19)]
            crossing = any(x[2] > y[1] for x, y in zip(inside, inside[1:]))
            if not failed and not crossing and b - a < 120:
                out.append((Lattice(text, a, b), set(inside)))
    return out


def _other_email(part: str, dice: random.Random) -> str:
    at, dot = dice.choice([(" @ ", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) ")])
    name, _, host = part.partition("@")
    return name + at + host.replace(".", dot)


def _other_ip(part: str, dice: random.Random) -> str:
    return part.replace(".", dice.choice(["[.]", "(.)", ". "]))


def _other_card(part: str, dice: random.Random) -> str:
    digits, by = digits_of(part), dice.choice([".", "/", "_", "-.", ""])
    return by.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _other_phone(part: str, dice: random.Random) -> str:
    digits = digits_of(part)
    if len(digits) < 10:
        return dice.choice(["00", "0"]) + part[1:]
    country, area, first, last = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    by = dice.choice([".", "-", " ", "/"])
    area = dice.choice([area, f"({area})"])
    lead = dice.choice(["", "00" + country + by, country + by]) if country else ""
    return f"{lead}{area}{by}{first}{by}{last}"


def altered(text: str, start: int, end: int, spans: list[tuple], dice: random.Random) -> tuple[str, list[tuple]]:
    """A region whose spans are written otherwise, and the spans in it."""
    other = {"email": _other_email, "ip": _other_ip, "card": _other_card, "phone": _other_phone}
    out, found, at = "", [], start
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        out += text[at:a]
        part = other[kind](text[a:b], dice)
        found.append((kind, len(out), len(out) + len(part)))
        out, at = out + part, b
    return out + text[at:end], found


def secret_regions(count: int, dice: random.Random) -> list[tuple[str, list[tuple]]]:
    """Texts with a random value: under a secret's name, and under another name or none."""
    # Names of secrets, other names, what stands between name and value, and quotes.
    names = ["token", "api_key", "API_KEY", "secret", "client_secret", "password", "authToken", "access-key", "PWD"]
    others = ["commit", "sha", "checksum", "id", "build", "digest", "file", "etag", "revision", "version"]
    marks, quotes = ["=", " = ", ": ", ":"], ['"', "'", ""]
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits]
    out = []
    for _ in range(count):
        value = "".join(dice.choices(dice.choice(alphabets), k=dice.choice([20, 24, 32, 40, 44, 64])))
        mark, quote, tail = dice.choice(marks), dice.choice(quotes), dice.choice(["", ";", ",", " and"])
        head = dice.choice(["", "the ", "see "])
        if not _RUN.fullmatch(value):
            continue
        before = head + dice.choice(names) + mark + quote
        out.append((before + value + quote + tail, [("secret", len(before), len(before) + len(value))]))
        without = [dice.choice(others) + mark + quote, dice.choice(others) + " ", dice.choice(names) + " ", quote]
        out.append((head + dice.choice(without) + value + quote + tail, []))
    return out


def fit(texts: list[str], seed: int = 11) -> dict[tuple[str, str], float]:
    dice = random.Random(seed)
    known = examples(texts)
    dice.shuffle(known)
    weights: dict[tuple[str, str], float] = defaultdict(float)
    weights.update({(kind, "bias"): -2.0 for kind in KINDS})
    # As many regions with spans as without are enough.
    with_spans = [e for e in known if e[1]][: REGIONS // 2]
    chosen = with_spans + [e for e in known if not e[1]][: REGIONS - len(with_spans)]
    others = [altered(x.text, x.start, x.end, sorted(gold), dice) for x, gold in with_spans * COPIES]
    for text, spans in others + secret_regions(SECRETS, dice):
        anchored = regions(text)
        if anchored:
            chosen.append((Lattice(text, anchored[0][0], anchored[-1][1]), set(spans)))
    for epoch in range(EPOCHS):
        dice.shuffle(chosen)
        for lattice, gold in chosen:
            lattice.learn(weights, gold, RATE / (1 + epoch))
    return {k: round(w, 6) for k, w in weights.items() if abs(w) > 1e-4}


def sample_texts(documents: DataFrame) -> list[str]:
    texts = documents.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("at"))
    different = texts.agg(F.approx_count_distinct("at")).first()[0]
    chunks = F.expr("regexp_extract_all(text, '[^\\\\s]*[0-9@][^\\\\s]*( [^\\\\s]*[0-9@][^\\\\s]*)*', 0)")
    few = lowest(texts, "at", different, SAMPLE).select("at", chunks.alias("chunks"))
    rows = few.groupBy("at").agg(F.min("chunks").alias("chunks")).orderBy("at").limit(SAMPLE)
    # Only the regions of the sample come to the driver, each with its neighbours gone.
    return ["\n".join(chunk for chunk in r["chunks"] if len(chunk) < 200) for r in rows.collect()]


def spans_of(text: str, weights: dict[str, list[float]]) -> tuple[list[tuple], list[tuple]]:
    """The spans of the fixed patterns, and those that the model adds.

    ``weights`` are by feature, as of :func:`by_feature`.
    """
    if not _ANCHOR.search(text):
        return [], []
    good, _ = base_spans(text)
    taken = sorted((a, b) for _, a, b in good)
    added, k = [], 0
    for a, b in regions(text):
        for span in best_spans(text, a, b, weights):
            while k < len(taken) and taken[k][1] <= span[1] and taken[k][1] <= a:
                k += 1
            free = not any(x < span[2] and y > span[1] for x, y in _from(taken, k, span[2]))
            if free and _checked(span[0], text[span[1] : span[2]]):
                added.append(span)
    return good, added


def _from(taken: list[tuple[int, int]], k: int, end: int):
    while k < len(taken) and taken[k][0] < end:
        yield taken[k]
        k += 1


def _listed(spans: list[tuple]) -> str:
    spans = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def find_spans(text: Column, weights: dict[tuple[str, str], float]) -> Column:
    """base and all: spans as ``kind:start:end``, by kind, then start; base counts; secrets."""
    by_kinds = by_feature(weights)

    @F.pandas_udf("base string, spans string, n_email long, n_ip long, n_card long, n_phone long, n_secret long")
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, added = spans_of(t or "", by_kinds)
            counts = [sum(s[0] == kind for s in base) for kind in PATTERNS]
            counts.append(sum(s[0] == "secret" for s in added))
            rows.append((_listed(base), _listed(base + added), *counts))
        return pd.DataFrame(rows, columns=["base", "spans", *(f"n_{k}" for k in KINDS)])

    return find(text)


def private_digest(documents: DataFrame) -> DataFrame:
    """Counts and spans of every document."""
    weights = fit(sample_texts(documents))
    found = documents.select("doc_id", find_spans(F.col("text"), weights).alias("found"))
    return found.select(
        "doc_id", *[f"found.n_{kind}" for kind in PATTERNS],
        F.sha2(F.col("found.base"), 256).alias("base_sha256"), "found.spans", "found.n_secret",
    )
