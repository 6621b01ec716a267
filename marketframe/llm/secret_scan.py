"""Secret scan: base rules, and a character convolutional network over every candidate.

Candidates are the base findings and every other long run of key characters. Each is seen whole, with
the characters before and behind it. A small network (one convolution over character embeddings, the
maximum over positions, a logistic output) is trained on all findings that the base rules label and all
runs that they pass over. These are dealt by a hash into blocks of bounded size; in each epoch every block
starts from the same parameters and takes its own steps, and what the blocks end with is averaged. Scores are
calibrated on all findings kept from training, and the threshold is the highest that still reaches the
required recall there. Candidates above it are added; base findings always stay.
"""

import copy
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill
from marketframe.llm.spans import Span

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "learned")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so that this drops just the short ones
LEAST = 16  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

FIXED = 2.0**36  # one, in the sums of parameters
BINS = 1024  # of a logit's unit, in calibration
BESIDE = 20  # characters on either side of a candidate; the candidate itself is seen whole
CHUNK = 44  # in chunks that overlap by a filter's width less one


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    if "=" in text or ":" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Long runs of key characters outside the base findings."""
    near = sorted(base, key=lambda s: s[1])
    starts = [s[1] for s in near]
    reach = list(accumulate((s[2] for s in near), max))
    out = []
    for m in CANDIDATE.finditer(text):
        # Of the findings that begin before its end, the one that reaches furthest.
        before = bisect_left(starts, m.end())
        if not before or reach[before - 1] <= m.start():
            out.append(m.span())
    return out


def window(text: str, start: int, end: int) -> str:
    """The characters before a candidate and behind it, padded to fixed places, then the candidate."""
    before = text[max(0, start - BESIDE) : start].rjust(BESIDE, "\0")
    return before + text[end : end + BESIDE].ljust(BESIDE, "\0") + text[start:end]


@dataclass(frozen=True)
class Chars:
    """Numbers of the characters of some windows: both sides, and chunks of the candidates, of which
    ``first`` is each candidate's first."""

    before: np.ndarray
    after: np.ndarray
    chunks: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def take(self, rows: np.ndarray) -> "Chars":
        ends = np.append(self.first[1:], len(self.chunks))
        sizes = (ends - self.first)[rows]
        first = np.cumsum(sizes) - sizes
        chunks = np.repeat(self.first[rows] - first, sizes) + np.arange(sizes.sum())
        return Chars(self.before[rows], self.after[rows], self.chunks[chunks], first)


def _numbers(texts: list[str], size: int) -> np.ndarray:
    """ASCII by itself, all other characters as one; trailing padding is zero."""
    codes = np.array(texts, dtype=f"<U{size}").view("<u4").reshape(-1, size)
    return np.minimum(codes, 128).astype(np.int16)


def char_ids(windows: list[str], width: int = 5) -> Chars:
    before = _numbers([w[:BESIDE] for w in windows], BESIDE)
    after = _numbers([w[BESIDE : 2 * BESIDE] for w in windows], BESIDE)
    chunks, first, step = [], [], CHUNK - width + 1
    for w in windows:
        first.append(len(chunks))
        own = w[2 * BESIDE :]
        chunks += [own[at : at + CHUNK] for at in range(0, max(1, len(own) - width + 1), step)]
    return Chars(before, after, _numbers(chunks, CHUNK), np.array(first, dtype=np.int64))


@dataclass(frozen=True)
class Network:
    """``block`` and ``block_chars`` are about what one block holds: windows, and characters of them."""

    block: int = 6000
    block_chars: int = 2 << 20
    width: int = 5
    filters: int = 16
    epochs: int = 12
    batch: int = 256
    rate: float = 0.01
    recall: float = 0.99
    seed: int = 11


class CharCnn:
    """Convolution over one-hot characters (a table per offset), maximum over places, logit.

    The maximum over a candidate is the maximum over its chunks, so that its length has no bound.
    """

    SIDES = 3  # before, behind, and the candidate

    def __init__(self, n: Network) -> None:
        rng = np.random.default_rng(n.seed)
        self.n = n
        self.own = rng.normal(0, 0.3, (self.SIDES, n.width, 129, n.filters))
        self.bias, self.out = np.zeros((self.SIDES, n.filters)), rng.normal(0, 0.3, self.SIDES * n.filters)
        self.last = np.zeros(1)
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5
        self.first = [np.zeros_like(p) for p in self._parameters()]
        self.second = [np.zeros_like(p) for p in self._parameters()]
        self.steps = np.zeros(1)

    def _tops(self, side: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest answer of each filter in each row, and where it is."""
        span = x.shape[1] - self.n.width + 1
        y = sum(self.own[side, k][x[:, k : k + span]] for k in range(self.n.width))
        place = y.argmax(axis=1)
        return np.take_along_axis(y, place[:, None, :], axis=1)[:, 0], place

    def _pooled(self, ids: Chars) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Pooled answers, and for each side the characters' rows and places that gave them."""
        pooled, won = [], []
        for side, x in enumerate((ids.before, ids.after)):
            top, place = self._tops(side, x)
            pooled.append(np.maximum(top + self.bias[side], 0))
            won.append((np.broadcast_to(np.arange(len(x))[:, None], place.shape), place))
        parts = [self._tops(2, ids.chunks[i : i + 2048]) for i in range(0, len(ids.chunks), 2048)]
        top, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        best = np.maximum.reduceat(top, ids.first)
        owner = np.repeat(np.arange(len(ids)), np.diff(np.append(ids.first, len(top))))
        rows = np.where(top == best[owner], np.arange(len(top))[:, None], len(top))
        row = np.minimum.reduceat(rows, ids.first)
        pooled.append(np.maximum(best + self.bias[2], 0))
        won.append((row, np.take_along_axis(place, row, axis=0)))
        return np.concatenate(pooled, axis=1), won

    def logits(self, ids: Chars) -> np.ndarray:
        steps = range(0, len(ids), 2048)
        parts = [self._pooled(ids.take(np.arange(i, min(i + 2048, len(ids)))))[0] @ self.out for i in steps]
        return np.concatenate([*parts, np.zeros(0)]) + self.last[0]

    def _parameters(self) -> list[np.ndarray]:
        return [self.own, self.bias, self.out, self.last]

    def _gradients(self, ids: Chars, labels: np.ndarray, counts: np.ndarray | None = None) -> list[np.ndarray]:
        hidden, won = self._pooled(ids)
        counts = np.ones(len(labels)) if counts is None else counts
        error = (1 / (1 + np.exp(-(hidden @ self.out + self.last[0]))) - labels) * counts / counts.sum()
        back = error[:, None] * self.out * (hidden > 0)
        own, bias = np.zeros_like(self.own), np.zeros_like(self.bias)
        lanes = np.arange(self.n.filters)[None, :]
        for side, x in enumerate((ids.before, ids.after, ids.chunks)):
            g = back[:, side * self.n.filters : (side + 1) * self.n.filters]
            bias[side] = g.sum(axis=0)
            row, place = won[side]
            for k in range(self.n.width):
                np.add.at(own[side, k], (x[row, place + k], lanes), g)
        return [own, bias, hidden.T @ error, np.array([error.sum()])]

    def epoch(self, ids: Chars, labels: np.ndarray, counts: np.ndarray, seed: Sequence[int]) -> None:
        """Adam over mini-batches in a seeded order, once through."""
        order = np.random.default_rng(seed).permutation(len(ids))
        for start in range(0, len(ids), self.n.batch):
            rows = order[start : start + self.n.batch]
            self.steps += 1
            grads = self._gradients(ids.take(rows), labels[rows], counts[rows])
            for p, g, m, v in zip(self._parameters(), grads, self.first, self.second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                ahead = m / (1 - 0.9 ** self.steps[0])
                p -= self.n.rate * ahead / (np.sqrt(v / (1 - 0.999 ** self.steps[0])) + 1e-8)

    def packed(self) -> np.ndarray:
        """Parameters and Adam's state in fixed point, so that the order of a sum over blocks does not matter."""
        state = [*self._parameters(), *self.first, *map(np.sqrt, self.second), self.steps]
        return np.rint(np.concatenate([x.ravel() for x in state]) * FIXED).astype(np.int64)

    def unpack(self, total: np.ndarray, blocks: int) -> None:
        """The average of ``blocks`` networks of which ``total`` is the sum."""
        mean, at = total / (FIXED * blocks), 0
        for x in [*self._parameters(), *self.first, *self.second, self.steps]:
            x[...] = mean[at : at + x.size].reshape(x.shape)
            at += x.size
        for v in self.second:
            v *= v

    def calibrate(self, ids: Chars, labels: np.ndarray) -> None:
        x = self.logits(ids)
        self.settle(x, x, labels, np.ones(len(x)))

    def settle(self, low: np.ndarray, high: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> None:
        """A logistic curve over ``counts`` logits each from ``low`` to ``high``; the threshold keeps the required
        recall."""
        x = (low + high) / 2
        for _ in range(200):
            p = self._chance(x)
            error, w = counts * (p - labels), counts * (p * (1 - p) + 1e-6)
            g = np.array([(error * x).sum(), error.sum()])
            h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
            self.slope, self.shift = np.array([self.slope, self.shift]) - np.linalg.solve(h, g)
        right = labels == 1
        found = np.minimum(self._chance(low), self._chance(high))[right]
        if len(found):
            order = np.argsort(found)
            passed = np.cumsum(counts[right][order])
            at = np.searchsorted(passed, int((1 - self.n.recall) * passed[-1]), side="right")
            # An even chance, or less where the required recall asks for it.
            self.threshold = min(float(found[order[at]]), 0.5)

    def _chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -30, 30)))

    def probability(self, ids: Chars) -> np.ndarray:
        return self._chance(self.logits(ids))


FOUND = (
    "doc_id long, base array<struct<kind:string,start:int,stop:int>>, "
    "more array<struct<start:int,stop:int,window:string>>, known array<string>"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    run = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("window", pa.string())]))
    for batch in all_slices(batches, "text"):
        bases, mores, known = [], [], []
        for text in batch["text"].to_pylist():
            text = text or ""
            base = base_spans(text)
            bases.append([{"kind": k, "start": a, "stop": b} for k, a, b in base])
            mores.append(
                [{"start": a, "stop": b, "window": window(text, a, b)} for a, b in candidates(text, base)]
            )
            # A base finding is learned as the run of key characters that it holds.
            inside = [(a, m) for _, a, b in base for m in CANDIDATE.finditer(text[a:b])]
            known.append([window(text, a + m.start(), a + m.end()) for a, m in inside])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(bases, span), pa.array(mores, run), pa.array(known, pa.list_(pa.string()))],
            names=["doc_id", "base", "more", "known"],
        )


def varied(windows: list[str], seed: int | Sequence[int]) -> list[str]:
    """Each finding once more with its letters and digits drawn anew and another length, so that the
    network learns the look of random keys and not one alphabet or length."""
    rng, keys = np.random.default_rng(seed), np.array(list(ALPHABET))
    out = []
    for text in windows:
        own = text[2 * BESIDE :]
        size = int(rng.integers(LEAST, 2 * len(own) + 1))
        own = (own * (size // len(own) + 1))[:size]
        drawn = "".join(rng.choice(keys, len(own)))
        out.append(text[: 2 * BESIDE] + "".join(d if c.isalnum() else c for c, d in zip(own, drawn, strict=True)))
    return out


def moved(windows: list[str], others: list[str], seed: int | Sequence[int]) -> list[str]:
    """Each finding once more in the surroundings of some other run, so that surroundings alone do not
    settle what it is."""
    places = np.random.default_rng(seed).integers(0, len(others), len(windows))
    return [others[k][: 2 * BESIDE] + w[2 * BESIDE :] for k, w in zip(places, windows, strict=True)]


SET = "model int, block long, windows array<string>, labels array<double>, counts array<double>, apart array<boolean>"
Counted = list[tuple[str, int]]


def labelled_blocks(found: DataFrame, n: Network) -> DataFrame | None:
    """All windows, label 1 for those of base findings, in blocks of a hash; repeated rows are counted.

    None if there is none of either label.
    """
    columns = {0: F.transform("more", lambda x: x["window"]), 1: F.col("known")}
    each = [
        found.select("doc_id", F.lit(label).alias("label"), F.posexplode(column).alias("at", "window"))
        for label, column in columns.items()
    ]
    keys = ["doc_id", "at", "label", "window"]
    counted = each[0].unionByName(each[1]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = spill(counted, "windows")
    size = counted.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length("window")).alias("chars"),
        F.count_if(F.col("label") == 1).alias("right"),
    ).first()
    if size.right in (0, size.rows):
        return None
    blocks = max(-(-size.rows // n.block), -(-size.chars // n.block_chars))
    block = F.pmod(F.xxhash64(F.lit("block"), "doc_id", "at", "window"), F.lit(blocks)).alias("block")
    rows = F.sort_array(F.collect_list(F.struct("label", "window", "n"))).alias("rows")
    return spill(counted.groupBy(block).agg(rows), "blocks")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _known(block: dict, n: Network) -> tuple[Counted, Counted]:
    """A block's findings, each also drawn anew, and its other runs."""
    right = [(r["window"], r["n"]) for r in block["rows"] if r["label"]]
    wrong = [(r["window"], r["n"]) for r in block["rows"] if not r["label"]]
    drawn = varied([w for w, _ in right], [n.seed, block["block"]])
    return right + [(w, k) for w, (_, k) in zip(drawn, right, strict=True)], wrong


def _set(model: int, block: int, right: Counted, wrong: Counted, n: Network) -> pa.RecordBatch:
    """Four fifths of the windows train a network, one fifth calibrates it."""
    apart = np.random.default_rng([n.seed, block, model]).random(len(right) + len(wrong)) < 0.2
    row = {"model": model, "block": block, "windows": [w for w, _ in right + wrong]}
    row |= {"labels": [1.0] * len(right) + [0.0] * len(wrong), "apart": apart.tolist()}
    row["counts"] = [float(k) for _, k in right + wrong]
    kinds = [pa.int32(), pa.int64(), *map(pa.list_, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
    names = ["model", "block", "windows", "labels", "counts", "apart"]
    return pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds, strict=True)], names=names)


def _side(row: dict, apart: bool, n: Network) -> tuple[Chars, np.ndarray, np.ndarray]:
    """Windows, labels and counts of a set that are kept from training, or are not."""
    own = np.flatnonzero(np.array(row["apart"], dtype=bool) == apart)
    ids = char_ids([row["windows"][i] for i in own], n.width)
    return ids, np.array(row["labels"])[own], np.array(row["counts"])[own]


def _bare(windows: Counted) -> Counted:
    return [("\0" * (2 * BESIDE) + w[2 * BESIDE :], k) for w, k in windows]


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _one_epoch(models: list[CharCnn], epoch: int, n: Network) -> Run:
    """Sums of the networks that the blocks of a task end with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[np.ndarray, int]] = {}
        for row in _rows(batches):
            own = copy.deepcopy(models[row["model"]])
            own.epoch(*_side(row, False, n), [n.seed, row["block"], epoch])
            total, blocks = totals.get(row["model"], (np.int64(0), 0))
            totals[row["model"]] = total + own.packed(), blocks + 1
        for model, (total, blocks) in totals.items():
            yield pa.RecordBatch.from_pylist([{"model": model, "blocks": blocks, "total": total.tobytes()}])

    return run


def _logits(models: list[CharCnn], n: Network) -> Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, labels, counts = _side(row, True, n)
            columns = [np.full(len(ids), row["model"], np.int32), labels, counts, models[row["model"]].logits(ids)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["model", "label", "n", "x"])

    return run


def train(sets: DataFrame, models: int, n: Network) -> list[CharCnn]:
    """Networks side by side, each from its sets. One network per task comes to the driver and is added up."""
    trained = [CharCnn(n) for _ in range(models)]
    for epoch in range(n.epochs):
        run = _one_epoch(trained, epoch, n)
        sums = sets.mapInArrow(run, "model long, blocks long, total binary").collect()
        for model, own in enumerate(trained):
            parts = [r for r in sums if r.model == model]
            if parts:
                own.unpack(sum(np.frombuffer(r.total, np.int64) for r in parts), sum(r.blocks for r in parts))
    # Every logit counts, by narrow bins.
    logits = sets.mapInArrow(_logits(trained, n), "model int, label double, n double, x double")
    bins = logits.groupBy("model", "label", F.floor(F.col("x") * BINS).alias("bin")).agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n").alias("n")
    )
    rows = sorted(bins.collect())
    for model, own in enumerate(trained):
        mine = [(r.low, r.high, r.label, r.n) for r in rows if r.model == model]
        own.settle(*np.array(mine, dtype=float).reshape(-1, 4).T)
    return trained


def _wrongs(sets: DataFrame) -> dict[int, int]:
    """How many runs that are no findings each network's sets hold."""
    size = F.sum(F.size(F.filter("labels", lambda y: y == 0)))
    return {r.model: r.n for r in sets.groupBy("model").agg(size.alias("n")).collect()}


def _half_sets(n: Network) -> Run:
    """Sets of two networks that each see half of the other runs, and nothing beside a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows(batches):
            right, wrong = _known(block, n)
            for half in (0, 1):
                yield _set(half, block["block"], _bare(right), _bare(wrong[half::2]), n)

    return run


def _whole_sets(judges: list[CharCnn], seen: dict[int, int], n: Network) -> Run:
    """Sets of the findings, also moved, and the runs that do not look like findings by themselves, whatever
    stands beside them.

    What the base rules pass over is not all harmless: a key that they miss must not be learned as none.
    Each half is judged by a network that has not seen it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows(batches):
            right, wrong = _known(block, n)
            kept: Counted = []
            for half in (0, 1):
                own = wrong[half::2]
                if own and seen[1 - half]:
                    looks = judges[1 - half].probability(char_ids([w for w, _ in _bare(own)], n.width))
                    own = [w for w, p in zip(own, looks, strict=True) if p < 0.5]
                kept += own
            if kept:
                elsewhere = moved([w for w, _ in right], [w for w, _ in kept], [n.seed, block["block"], 1])
                right += [(w, k) for w, (_, k) in zip(elsewhere, right, strict=True)]
            yield _set(0, block["block"], right, kept, n)

    return run


def learn(found: DataFrame, n: Network) -> CharCnn:
    """The network from all findings that the base rules label and all runs that they pass over."""
    blocks = labelled_blocks(found, n)
    if blocks is not None:
        halves = spill(blocks.mapInArrow(_half_sets(n), SET), "halves")
        judges = train(halves, 2, n)
        sets = spill(blocks.mapInArrow(_whole_sets(judges, _wrongs(halves), n), SET), "sets")
        if _wrongs(sets)[0]:
            return train(sets, 1, n)[0]
    model = CharCnn(n)
    model.threshold = 1.1  # nothing to tell apart: nothing is added
    return model


def find_secrets(docs: DataFrame, n: Network = Network()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base and added spans (kind, start, stop).

    A null text is empty and has none; repeated rows have equal spans; ties in start are ordered by
    kind. Without labelled findings nothing is added. An empty table gives no rows. Other columns
    are not read.
    """
    ship(docs.sparkSession)
    found = spill(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_find, FOUND), "secrets")
    model = learn(found, n)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            rows = batch["more"].to_pylist()
            flat = [x["window"] for row in rows for x in row]
            keep = iter(model.probability(char_ids(flat, n.width)) >= model.threshold if flat else ())
            added = [
                [{"kind": "learned", "start": x["start"], "stop": x["stop"]} for x in row if next(keep)]
                for row in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["base"], pa.array(added, span)], names=["doc_id", "base", "added"]
            )

    kind = "array<struct<kind:string,start:int,stop:int>>"
    return found.select("doc_id", "base", "more").mapInArrow(decide, f"doc_id long, base {kind}, added {kind}")
