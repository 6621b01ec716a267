"""Personal data by weak supervision.

Base rules find emails, addresses, card and phone numbers. Looser patterns give candidates, and four
labelers vote on each: the base rule, the format (check digits, ranges, lengths), gazetteers
(top-level domains, card prefixes, calling codes, reserved networks) and the words around. Votes are
counted by pattern over the whole corpus; expectation-maximisation estimates how reliable each
labeler is and how likely each pattern is personal data. A logistic span classifier, trained on
those likelihoods, decides on candidates outside the base spans. Base spans always stay.
"""

import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from ipaddress import ip_address, ip_network
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill
from marketframe.llm.spans import Span, digest, written

KINDS = ("email", "ip", "card", "phone")

# Base rules, in forms that take time linear in the text. The digit chains are possessive: nothing
# follows them in the rule, so that greedy and possessive matches are the same.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser candidates.
AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?: ?\(at\) ?| ?\[at\] ?)[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
NUMBER = re.compile(r"[0-9(](?:[ ().-]{0,2}[0-9])++")

# A whole address, its sign spelled out or not, with labels of a length that mail servers take.
MAIL = re.compile(
    r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?(?:@| ?\(at\) ?| ?\[at\] ?)"
    r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}"
)

# Gazetteers: fixed values. Top-level domains: those of countries have two letters, all of which count, and these.
DOMAINS = frozenset(
    "com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat asia post "
    "app blog cloud club dev eco email global group live ltd media news online shop site store tech "
    "today top web website wiki work world xyz".split()
)
# Card networks by ISO/IEC 7812: first and last prefix of a range, and the lengths of its numbers.
CARD_RANGES = (
    ("4", "4", (13, 16, 19)),
    ("51", "55", (16,)),
    ("2221", "2720", (16,)),
    ("34", "34", (15,)),
    ("37", "37", (15,)),
    ("300", "305", (14, 16, 19)),
    ("36", "36", (14, 16, 19)),
    ("38", "39", (14, 16, 19)),
    ("6011", "6011", (16, 19)),
    ("644", "659", (16, 19)),
    ("3528", "3589", (16, 19)),
    ("62", "62", (16, 17, 18, 19)),
    ("2200", "2204", (16, 19)),
    ("50", "50", (12, 13, 14, 15, 16, 17, 18, 19)),
    ("56", "58", (12, 13, 14, 15, 16, 17, 18, 19)),
)
# IPv4 networks of the IANA special-purpose registry.
RESERVED = tuple(
    ip_network(n) for n in (
        "0.0.0.0/8 10.0.0.0/8 100.64.0.0/10 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24 "
        "192.0.2.0/24 192.88.99.0/24 192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24 "
        "224.0.0.0/4 240.0.0.0/4"
    ).split()
)
# Calling codes by ITU-T E.164: two zones of one digit, these of two; in the other zones codes have three
# digits, save where a whole ten is spare.
ONE_DIGIT_CODES = ("1", "7")
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)
SPARE_TENS = frozenset("28 83 89".split())
FOR = frozenset("tel phone call fax mobile mail email contact write card visa pay ip host server address login telefon teléfono courriel".split())
AGAINST = frozenset("order invoice isbn version price total page vol no nr ref doi rfc section".split())


def card_network(digits: str) -> bool:
    """Whether a card network gives out numbers of this beginning and length."""
    return any(
        low <= digits[: len(low)] <= high and len(digits) in lengths for low, high, lengths in CARD_RANGES
    )


def calling_code(digits: str) -> bool:
    """Whether an international number begins with a calling code and goes on behind it."""
    if digits[:1] in ONE_DIGIT_CODES:
        return len(digits) > 7
    two = digits[:2]
    if two in SPARE_TENS or digits[:1] == "0":
        return False
    return len(digits) >= (8 if two in TWO_DIGIT_CODES else 9)


def top_level(domain: str) -> int:
    """1 for a known top-level domain, 0 for one that may be, -1 for what cannot be one."""
    last = domain.rsplit(".", 1)[-1].lower()
    if last in DOMAINS or (len(last) == 2 and last.isascii() and last.isalpha()):
        return 1
    return 0 if last.isalpha() or last.startswith("xn--") else -1


def reserved(value: str) -> bool:
    try:
        address = ip_address(value)
    except ValueError:
        return False
    return any(address in network for network in RESERVED)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def _emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def _addresses(text: str) -> list[tuple[int, int, list[str]]]:
    """Four dotted numbers each, with their parts: a chain holds one per four of its numbers."""
    found = []
    for chain in CHAIN.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            found.append((at, at + length, four))
            at += length + 1
    return found


def base_spans(text: str) -> list[Span]:
    spans = _emails(text)
    for start, end, parts in _addresses(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            spans.append(("ip", start, end))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() and c.isascii() for c in m.group()) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def _numbers(run: str, at: int) -> list[tuple[int, int, int]]:
    """(start, end, digits) of a run that starts at ``at``, or of its parts if it is too long for one.

    Parts end at blanks. Those of under 7 digits, such as the groups of a card number, are put
    together again up to 16 digits.
    """
    n = sum(c.isdigit() for c in run)
    if n <= 19:
        return [(at, at + len(run), n)]
    parts: list[tuple[int, int, int]] = []
    joined = False  # whether the last part may still grow
    for m in re.finditer(r"[^ ]+", run):
        n = sum(c.isdigit() for c in m.group())
        short = n < 7
        if joined and short and parts[-1][2] + n <= 16:
            parts[-1] = (parts[-1][0], at + m.end(), parts[-1][2] + n)
        else:
            parts.append((at + m.start(), at + m.end(), n))
        joined = short
    return parts


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Base spans, and what the looser patterns find outside them."""
    spelled = AT.finditer(text) if "(at)" in text or "[at]" in text else ()
    loose: list[Span] = [("email", m.start(), m.end()) for m in spelled]
    loose += [("ip", start, end) for start, end, _ in _addresses(text)]
    for m in NUMBER.finditer(text):
        for start, end, n in _numbers(m.group(), m.start()):
            # Digits within a word, such as a key, are no number.
            alone = not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())
            if 7 <= n <= 19 and alone:
                loose.append(("phone" if n < 12 else "card", start, end))
    near = sorted(base, key=lambda s: s[1])
    starts = [s[1] for s in near]
    reach = list(accumulate((s[2] for s in near), max))
    out = list(base)
    for kind, start, end in loose:
        # Of the base spans that begin before its end, the one that reaches furthest.
        before = bisect_left(starts, end)
        if not before or reach[before - 1] <= start:
            out.append((kind, start, end))
    return out


def _context(text: str, start: int) -> list[str]:
    return re.findall(r"[^\W\d_]+", text[max(0, start - 40) : start].lower())[-4:]


def votes(kind: str, value: str, around: list[str], in_base: bool) -> tuple[int, int, int, int]:
    """The labelers' votes: 1 for personal data, -1 against, 0 for none."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        form, listed = (1 if MAIL.fullmatch(value) else -1), top_level(value)
    elif kind == "ip":
        parts = value.split(".")
        plain = all(len(p) < 4 and int(p) < 256 and (p == "0" or p[0] != "0") for p in parts)
        form, listed = (1 if plain else -1), (-1 if reserved(value) else 0)
    elif kind == "card":
        form = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        listed = 1 if card_network(digits) else -1
    else:
        form = 1 if 10 <= len(digits) <= 15 else -1
        # National numbers name no country, and the list has no vote on them.
        listed = 0 if value[0] != "+" else 1 if calling_code(digits) else -1
    words = set(around)
    spoken = 1 if words & FOR else -1 if words & AGAINST else 0
    # The base rule has no vote on what it does not look at: numbers without a plus, spelled-out signs.
    looked = kind in ("ip", "card") or value[0] == "+" or "@" in value
    return (1 if in_base else -1 if looked else 0, form, listed, spoken)


FEATURES = 1 << 12


def features(kind: str, value: str, around: list[str]) -> list[int]:
    """Hashed features of a span: its shape, length, ends and the words before it."""
    shape = re.sub(r"9+", "9", re.sub("[0-9]", "9", re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", value))))
    digits = sum(c.isdigit() for c in value)
    named = [f"shape {shape[:24]}", f"length {len(value) // 4}", f"digits {digits}"]
    named += [f"first {value[0]}", f"last {value[-3:].lower()}" if kind == "email" else "last"]
    named += [f"before {w}" for w in around]
    return sorted({zlib.crc32(f"{kind} {n}".encode()) % FEATURES for n in named})


@dataclass(frozen=True)
class Supervision:
    """``max_spans`` bounds the candidates that train the span classifier."""

    max_spans: int = 20_000
    rounds: int = 50
    epochs: int = 200
    rate: float = 0.5
    threshold: float = 0.5


def estimate(counts: dict[tuple[int, ...], int], rounds: int) -> dict[tuple[int, ...], float]:
    """Likelihood of each vote pattern by expectation-maximisation over the patterns' counts.

    Labelers are independent given the truth; each has its own chance of being right under either
    truth. One that gives no vote says nothing of it. It starts from the majority and from labelers that are
    mostly right.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    vote = np.array(patterns, dtype=int).reshape(len(patterns), -1)
    belief = 1 / (1 + np.exp(-vote.sum(axis=1, dtype=float)))
    for _ in range(rounds):
        prior = (n @ belief + 1) / (n.sum() + 2)
        odds = np.full(len(patterns), np.log(prior / (1 - prior)))
        for labeler in range(vote.shape[1]):
            given = vote[:, labeler] != 0
            side = (vote[given, labeler] + 1) // 2
            right = np.bincount(side, (n * belief)[given], 2) + np.array([0.5, 2.0])
            wrong = np.bincount(side, (n * (1 - belief))[given], 2) + np.array([2.0, 0.5])
            odds[given] += (np.log(right / right.sum()) - np.log(wrong / wrong.sum()))[side]
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(patterns, belief.tolist(), strict=True))


def train_spans(rows: list[tuple[list[int], float]], s: Supervision) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels."""
    weights = np.zeros(FEATURES + 1)
    if not rows:
        return weights
    lengths = [len(f) + 1 for f, _ in rows]
    at = np.array([i for f, _ in rows for i in (*f, FEATURES)])
    row = np.repeat(np.arange(len(rows)), lengths)
    target, squares = np.array([y for _, y in rows]), np.full(FEATURES + 1, 1e-6)
    for _ in range(s.epochs):
        score = np.bincount(row, weights[at], len(rows))
        error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - target
        gradient = np.bincount(at, error[row], FEATURES + 1) / len(rows) + 1e-4 * weights
        squares += gradient**2
        weights -= s.rate * gradient / np.sqrt(squares)
    return weights


FOUND = (
    "doc_id long, base array<struct<kind:string,start:int,stop:int>>, more array<struct<"
    "kind:string,start:int,stop:int,votes:array<int>,features:array<int>,base:boolean>>"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]
    more = [*span, ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32())), ("base", pa.bool_())]
    for batch in all_slices(batches, "text"):
        bases, mores = [], []
        for text in batch["text"].to_pylist():
            text = text or ""
            base = base_spans(text)
            held, rows = set(base), []
            for one in candidates(text, base):
                kind, start, end = one
                value, around = text[start:end], _context(text, start)
                rows.append(
                    {"kind": kind, "start": start, "stop": end, "base": one in held,
                     "votes": votes(kind, value, around, one in held),
                     "features": features(kind, value, around)}
                )
            bases.append([{"kind": k, "start": a, "stop": b} for k, a, b in base])
            mores.append(rows)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(bases, pa.list_(pa.struct(span))), pa.array(mores, pa.list_(pa.struct(more)))],
            names=["doc_id", "base", "more"],
        )


def find_personal_data(docs: DataFrame, s: Supervision = Supervision()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base and added spans (kind, start, stop).

    A null text is empty and has none; repeated rows have equal spans; ties in start are ordered by
    kind. An empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    found = spill(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_find, FOUND), "spans")
    spans = found.select("doc_id", F.explode("more").alias("s")).select("doc_id", "s.*")
    # At most 3 votes to the power of 4 labelers, for 4 kinds.
    patterns: dict[str, dict[tuple[int, ...], int]] = defaultdict(dict)
    for row in spans.groupBy("kind", "votes").count().collect():
        patterns[row.kind][tuple(row.votes)] = row["count"]
    belief = {kind: estimate(counts, s.rounds) for kind, counts in patterns.items()}
    total = sum(sum(c.values()) for c in patterns.values())
    draw = F.pmod(F.xxhash64("doc_id", "kind", "start", "stop"), F.lit(1 << 40))
    sample = spans.filter(draw < int(min(1.0, s.max_spans / max(total, 1)) * (1 << 40)))
    chosen = sample.select("kind", "votes", "features").collect()  # about max_spans rows
    rows = sorted((list(r.features), belief[r.kind][tuple(r.votes)]) for r in chosen)
    weights = train_spans(rows, s)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            added = []
            for spans in batch["more"].to_pylist():
                kept: list[dict] = []
                for x in sorted(spans, key=lambda x: (x["start"], KINDS.index(x["kind"]))):
                    score = weights[x["features"]].sum() + weights[FEATURES]
                    free = not kept or kept[-1]["stop"] <= x["start"]
                    if not x["base"] and free and 1 / (1 + np.exp(-score)) >= s.threshold:
                        kept.append({k: x[k] for k in ("kind", "start", "stop")})
                added.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["base"], pa.array(added, span)], names=["doc_id", "base", "added"]
            )

    kind = "array<struct<kind:string,start:int,stop:int>>"
    return found.mapInArrow(decide, f"doc_id long, base {kind}, added {kind}")


def digest_spans(found: DataFrame, kinds: tuple[str, ...], counted: tuple[str, ...]) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(len(counted) + 2)]
            for base, added in zip(batch["base"].to_pylist(), batch["added"].to_pylist(), strict=True):
                own = [(x["kind"], x["start"], x["stop"]) for x in base]
                more = [(x["kind"], x["start"], x["stop"]) for x in added]
                for i, kind in enumerate(counted):
                    columns[i].append(sum(k == kind for k, _, _ in own))
                columns[-2].append(digest(own, kinds))
                columns[-1].append(written(own + more, kinds))
            types = [pa.int64()] * len(counted) + [pa.string()] * 2
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names=names)

    names = ["doc_id", *(f"n_{k}" for k in counted), "base_sha256", "spans"]
    kind = ", ".join(["doc_id long", *(f"n_{k} long" for k in counted), "base_sha256 string, spans string"])
    return found.mapInArrow(run, kind)
