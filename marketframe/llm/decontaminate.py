"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words. Their TF-IDF vectors, over the benchmark's terms, span a latent space
found by a randomised SVD whose products with the passage matrix are sums over partitions. Passages
whose latent cosine with a benchmark item is high are candidates, and for items made of terms too common
for that, passages with one of the item's rarest terms; a longest common subsequence
between the item and the text around the passage, and a check that the terms it ends on (its
answer) are there, decide. Words outside the benchmark cannot match an item, so a document is reduced
once to the positions of the benchmark's terms in it, and every later pass reads only that.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill

TERM = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Retrieval:
    """``window``: words of a passage; ``rank``: latent dimensions; ``common``: terms in more than
    this share of passages get weight zero, save an item's rarest; ``cosine``: least latent cosine of a candidate;
    ``overlap``: least share of an item's words in the common subsequence; ``answer``: least share
    of its answer, the terms of its last quarter; ``words_at_once``: words of benchmark items per pass over
    the corpus, which bound the vocabulary and so every array of a pass; ``items_per_rank``: items for which
    a latent dimension is added beyond ``rank``, so that large benchmarks stay apart in the space."""

    window: int = 32
    rank: int = 48
    common: float = 0.1
    cosine: float = 0.35
    overlap: float = 0.7
    answer: float = 0.5
    words_at_once: int = 60_000
    items_per_rank: int = 16


# Every ASCII character in lower case, or a blank where it is in no term.
PLAIN = {i: chr(i).lower() if chr(i).isalnum() else " " for i in range(128)}


def terms_of(text: str | None) -> list[str]:
    text = text or ""
    return text.translate(PLAIN).split() if text.isascii() else TERM.findall(text.lower())


class Items:
    """A block of benchmark items and the vocabulary they span."""

    def __init__(self, rows: list[tuple[int, str | None]]) -> None:
        self.ids = [item_id for item_id, _ in rows]
        words = [terms_of(text) for _, text in rows]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.terms = [np.array([self.vocabulary[w] for w in ws], dtype=np.int32) for ws in words]


def _compact(items: Items):
    """Per document the number of words and where which benchmark terms stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.vocabulary.get
        for batch in all_slices(batches, "text"):
            counts, at, terms = [], [], []
            for text in batch["text"].to_pylist():
                words = terms_of(text)
                found = np.fromiter(map(known, words, repeat(-1)), dtype=np.int32, count=len(words))
                place = np.flatnonzero(found >= 0)
                counts.append(len(found))
                at.append(place)
                terms.append(found[place])
            ends = np.cumsum([0, *map(len, at)], dtype=np.int32)
            none = [np.zeros(0, dtype=np.int32)]
            lists = [
                pa.ListArray.from_arrays(ends, np.concatenate([*x, *none]).astype(np.int32))
                for x in (at, terms)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(counts, pa.int32()), *lists],
                names=["doc_id", "text_key", "n_words", "places", "terms"],
            )

    return run


def compact(docs: DataFrame, items: Items) -> DataFrame:
    text_key = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    kind = "doc_id long, text_key binary, n_words int, places array<int>, terms array<int>"
    rows = docs.select(F.col("doc_id").cast("long"), text_key.alias("text_key"), "text")
    return spill(rows.mapInArrow(_compact(items), kind), "terms")


class Passages:
    """The passages of some documents as a sparse matrix: one entry per term occurrence."""

    def __init__(self, batch: pa.RecordBatch, window: int, shift: int) -> None:
        lengths = batch["terms"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        n_words = batch["n_words"].to_numpy().astype(np.int64)
        windows = (n_words + shift + window - 1) // window
        first = np.concatenate([[0], np.cumsum(windows)])
        document = np.repeat(np.arange(len(lengths)), lengths)
        self.term = batch["terms"].flatten().to_numpy()
        place = batch["places"].flatten().to_numpy().astype(np.int64)
        self.row = first[document] + (place + shift) // window
        self.document = np.repeat(np.arange(len(windows)), windows)
        number = np.arange(first[-1]) - first[self.document]
        self.begin = np.maximum(number * window - shift, 0)
        end = np.minimum((number + 1) * window - shift, n_words[self.document])
        self.words = end - self.begin
        self.count = int(first[-1])

    def times(self, used: np.ndarray, scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage rows, their sums of rows of ``scaled``) over the terms in ``used``."""
        use = np.flatnonzero(used[self.term])
        row, term = self.row[use], self.term[use]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        if not len(starts):
            return row, np.zeros((0, scaled.shape[1]), scaled.dtype)
        return row[starts], np.add.reduceat(scaled[term], starts, axis=0)


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``most`` term occurrences, or one document."""
    for batch in batches:
        ends = np.cumsum(batch["terms"].value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _rows(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def passage_frequencies(terms: DataFrame, size: int, window: int) -> tuple[np.ndarray, int]:
    """In how many passages of distinct texts each term stands, and how many passages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, dtype=np.int64)
        for batch in _pieces(batches):
            passages = Passages(batch, window, 0)
            pairs = np.unique(passages.row * size + passages.term)
            counts[:size] += np.bincount(pairs % size, minlength=size)
            counts[size] += passages.count
        yield _rows(["term", "n"], [np.arange(size + 1), counts])

    once = terms.drop("doc_id").distinct()
    rows = once.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(size + 1, dtype=np.int64)
    for term, n in rows.collect():  # one row per benchmark term
        found[term] = n
    return found[:size], int(found[size])


def term_weights(items: Items, frequency: np.ndarray, passages: int, r: Retrieval) -> np.ndarray:
    """Inverse document frequencies; zero for common terms, but an item keeps its rarest ones."""
    full = np.log((1 + passages) / (1 + frequency))
    weights = np.where(frequency > max(r.common * passages, 100), 0.0, full)
    for item in items.terms:
        if not np.any(weights[item] > 0):
            rarest = item[frequency[item] == frequency[item].min()]
            weights[rarest] = full[rarest]
    return weights


class Anchors:
    """Items with too little weighted mass for the latent search, and terms that any match has.

    A common subsequence leaves out at most some places of an item, so that it holds one of any
    larger set of its places: the rarest are its anchors. Every passage with one is a candidate.
    """

    def __init__(self, items: Items, weights: np.ndarray, frequency: np.ndarray, outside: float, r: Retrieval) -> None:
        self.weak: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for j, item in enumerate(items.terms):
            length = len(item)
            inside = min(length, 3 * r.window // 4)  # of the item, in the better of two passages
            mass = float((weights[item] ** 2).sum()) * inside / length
            share = math.sqrt(mass / max(mass + outside * (r.window - inside), 1e-12))
            if share >= 1.5 * r.cosine and np.count_nonzero(weights[item]) * 4 >= length:
                continue
            least = next(n for n in range(length + 1) if n / length >= r.overlap)
            order = np.argsort(frequency[item], kind="stable")
            anchor, own = (np.zeros(len(weights), dtype=bool) for _ in range(2))
            anchor[item[order[: length - least + 1]]] = True
            own[item] = True
            self.weak.append((j, anchor, own, least))

    def passages(self, p: Passages, places: np.ndarray, starts: np.ndarray, r: Retrieval, lengths: list[int]):
        """(passage, item) with an anchor in the passage and enough of the item's terms around it.

        ``places``: where each term of ``p`` stands; ``starts``: each document's first term in it.
        """
        for j, anchor, own, least in self.weak:
            rows = np.unique(p.row[anchor[p.term]])
            if not len(rows):
                continue
            # One ascending number per word, so that a place in a document is found by bisection.
            wide = int(places.max()) + r.window + 2 * lengths[j] + 2
            number = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * wide + places
            held = np.concatenate([[0], np.cumsum(own[p.term])])
            base, begin = p.document[rows] * wide, p.begin[rows]
            lo = np.searchsorted(number, base + np.maximum(begin - lengths[j], 0))
            hi = np.searchsorted(number, base + begin + r.window + lengths[j])
            for row in rows[held[hi] - held[lo] >= least].tolist():
                yield row, j


def gram_product(terms: DataFrame, weights: np.ndarray, right: np.ndarray, window: int) -> np.ndarray:
    """transpose(A) A ``right`` for the passage matrix A: each task adds up its own passages."""
    size, width = right.shape
    names = [f"y{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, width)), False
        used, scaled = weights > 0, (weights[:, None] * right).astype(np.float32)
        for batch in _pieces(batches):
            passages = Passages(batch, window, 0)
            row, latent = passages.times(used, scaled)
            if not len(row):
                continue
            seen = True
            place = np.zeros(passages.count, dtype=np.int64)
            place[row] = np.arange(len(row))
            use = np.flatnonzero(used[passages.term])
            order = use[np.argsort(passages.term[use], kind="stable")]
            term = passages.term[order]
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            parts = latent[place[passages.row[order]]]
            total[term[starts]] += np.add.reduceat(parts, starts, axis=0)
        if seen:
            total *= weights[:, None]
            some = np.flatnonzero(np.any(total != 0, axis=1))
            yield _rows(["term", *names], [some, *total[some].T])

    kind = ", ".join(["term long", *(f"{n} double" for n in names)])
    sums = terms.mapInArrow(run, kind).groupBy("term").agg(*[F.sum(n).alias(n) for n in names])
    out = np.zeros((size, width))
    for row in sums.collect():  # one row per benchmark term
        out[row[0]] = row[1:]
    return out


def latent_space(terms: DataFrame, items: Items, weights: np.ndarray, r: Retrieval) -> np.ndarray:
    """Right singular vectors (terms x rank) of corpus and benchmark passages together.

    The Nyström form of the randomised SVD: a single product of transpose(A) A with random vectors gives
    both the range and the small matrix. Benchmark items count as passages, weighted up to the corpus, so
    that the space has room for what is searched.
    """
    size = len(weights)
    rank = min(max(r.rank, len(items.terms) // r.items_per_rank), size)
    width = min(size, rank + 8)
    # The items' matrix, one entry for a word of an item.
    item = np.repeat(np.arange(len(items.terms)), [len(t) for t in items.terms])
    term = np.concatenate(items.terms)
    starts = np.flatnonzero(np.diff(item, prepend=-1))

    def product(right: np.ndarray) -> np.ndarray:
        corpus = gram_product(terms, weights, right, r.window)
        latent = np.add.reduceat(weights[term, None] * right[term], starts, axis=0)
        own = np.zeros((size, right.shape[1]))
        np.add.at(own, term, weights[term, None] * latent[item])
        scale = np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-12)
        return corpus + max(scale, 1.0) * own

    start = np.linalg.qr(np.random.default_rng(7).standard_normal((size, width)))[0]
    image = product(start)
    inner = start.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    # Products are in single precision: what is below that is noise, as where there are few passages.
    held = values > 1e-6 * values[-1]
    if not held.any() or values[-1] <= 0:
        return start[:, :1]
    half = image @ (turn[:, held] / np.sqrt(values[held]))
    vectors, _, _ = np.linalg.svd(half, full_matrices=False)
    return vectors[:, :rank]


def common_subsequence(item: dict[int, int], length: int, text: list[int]) -> int:
    """Length of the longest common subsequence; ``item`` has the bit mask of each term's places."""
    full = (1 << length) - 1
    state = full
    for term in text:
        mask = item.get(term)
        if mask:
            both = state & mask
            state = ((state + both) | (state - both)) & full
    return length - state.bit_count()


def _search(items: Items, weights: np.ndarray, frequency: np.ndarray, basis: np.ndarray, r: Retrieval):
    latent_items = np.stack([weights[t] @ basis[t] for t in items.terms])
    norms = np.linalg.norm(latent_items, axis=1)
    latent_items = (latent_items / np.maximum(norms, 1e-9)[:, None]).astype(np.float32)
    masks, answers = [], []
    for item in items.terms:
        mask: dict[int, int] = {}
        for i, term in enumerate(item.tolist()):
            mask[term] = mask.get(term, 0) | 1 << i
        masks.append(mask)
        answers.append(set(item[-math.ceil(len(item) / 4) :].tolist()))
    outside = float(np.median(weights[weights > 0])) ** 2 if np.any(weights > 0) else 1.0
    used, squares = weights > 0, weights**2
    scaled = (weights[:, None] * basis).astype(np.float32)
    anchors = Anchors(items, weights, frequency, outside, r)
    lengths = [len(item) for item in items.terms]

    def candidates(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, float]]:
        """(document, item, first word of the passage, cosine)."""
        places = batch["places"].flatten().to_numpy().astype(np.int64)
        sizes = batch["terms"].value_lengths().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        for shift in (0, r.window // 2):
            passages = Passages(batch, r.window, shift)
            row, latent = passages.times(used, scaled)
            exact = anchors.passages(passages, places, starts, r, lengths)
            if not len(row):
                for p, j in exact:
                    yield int(passages.document[p]), j, int(passages.begin[p]), 0.0
                continue
            mass = np.bincount(passages.row, squares[passages.term], passages.count)[row]
            known = np.bincount(passages.row, minlength=passages.count)[row]
            share = np.sqrt(mass / (mass + outside * (passages.words[row] - known)))
            latent *= (share / np.maximum(np.linalg.norm(latent, axis=1), 1e-9))[:, None]
            for p, j in exact:
                at = int(np.searchsorted(row, p))
                here = at < len(row) and row[at] == p
                near = float(latent[at] @ latent_items[j]) if here else 0.0
                yield int(passages.document[p]), j, int(passages.begin[p]), near
            for start in range(0, len(row), 2048):
                cosine = latent[start : start + 2048] @ latent_items.T
                for i, j in zip(*np.nonzero(cosine >= r.cosine), strict=True):
                    p = row[start + i]
                    yield int(passages.document[p]), int(j), int(passages.begin[p]), float(cosine[i, j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            places, terms, seen = {}, {}, {}
            for d, j, begin, cosine in candidates(batch):
                length = len(items.terms[j])
                if d not in places:
                    places[d] = batch["places"][d].values.to_numpy()
                    terms[d] = batch["terms"][d].values.to_numpy()
                lo, hi = np.searchsorted(places[d], [begin - length, begin + r.window + length])
                if hi - lo < r.overlap * length:
                    continue  # too few words for a match
                stretch = (d, j, int(lo), int(hi))
                if stretch not in seen:
                    around = terms[d][lo:hi].tolist()
                    answer = len(answers[j].intersection(around)) / len(answers[j])
                    overlap = 0.0
                    if answer >= r.answer:
                        overlap = common_subsequence(masks[j], length, around) / length
                    seen[stretch] = overlap, answer
                overlap, answer = seen[stretch]
                if overlap >= r.overlap:
                    best[d, j] = max(best.get((d, j), (0.0, 0.0, 0.0)), (overlap, answer, cosine))
            if best:
                ids, keys = batch["doc_id"].to_pylist(), batch["text_key"].to_pylist()
                found = [(ids[d], keys[d], items.ids[j], *v) for (d, j), v in sorted(best.items())]
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "text_key", "item_id", "overlap", "answer", "cosine"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), *[pa.float64()] * 3]
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, r: Retrieval = Retrieval()) -> DataFrame:
    """(doc_id, text_key, item_id, overlap, answer, cosine) of every document that holds an item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. Null
    or empty texts and items match nothing; repeated rows of ``docs`` give repeated rows, equal
    items one row each. Empty tables give no rows. ``text_key`` is the MD5 of the text. The
    benchmark is the stated query set: it is read in blocks of ``words_at_once``, each searched over
    the whole corpus.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = "doc_id long, text_key binary, item_id long, overlap double, answer double, cosine double"
    found = spark.createDataFrame([], kind)
    queries = spill(benchmark.select(F.col("item_id").cast("long"), "text"), "items")
    words = queries.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"[\W_]+")))).first()[0]
    blocks = -(-(words or 0) // r.words_at_once)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for block in range(blocks):
        rows = queries.filter(place == block).collect()  # of about words_at_once words
        rows = sorted(((i, t) for i, t in rows if terms_of(t)), key=lambda x: (x[0] is None, x))
        if not rows:
            continue
        items = Items(rows)
        terms = compact(docs, items)
        frequency, passages = passage_frequencies(terms, len(items.vocabulary), r.window)
        weights = term_weights(items, frequency, passages, r)
        basis = latent_space(terms, items, weights, r)
        found = found.unionByName(terms.mapInArrow(_search(items, weights, frequency, basis, r), kind))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, r: Retrieval = Retrieval()) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; rows without a doc_id as well."""
    hits = spill(contaminated(docs, benchmark, r).select("text_key").distinct(), "leaks")
    key: Column = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    return docs.join(hits, key == hits["text_key"], "left_anti")
