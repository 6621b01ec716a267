"""Document fingerprints: the quartile bucket digest.

Triplets of bytes within windows of five are hashed into 256 buckets. The digest holds for each bucket the
quartile of its count among all buckets (two bits), and before them a byte for the length on a
logarithmic scale and one for the place of the lower quartiles below the upper one. Digests are
compared by a bounded score: distances of the bucket quartiles, the length bytes and the quartile
places, at most ``WORST``; likeness is 1 minus the score's share of that.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import ship, spill

BUCKETS = 256
# Distances back from the newest byte of a window of five, of the two others of a triplet.
PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
WORST = 512
SLICE = 1 << 20
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
# Distance of two quartiles: opposite ends count double.
_GAP = np.array([0, 1, 2, 6])


def bucket_counts(data: bytes) -> np.ndarray:
    """How many byte triplets fall into each bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)
    reach = PAIRS[-1][1]
    for start in range(0, max(len(whole), 1), SLICE):
        part = whole[max(0, start - reach) : start + SLICE].astype(np.uint32)
        mixed = [part * m for m in _MIX[:3]]
        skip = min(start, reach)  # windows that end here ended in the slice before
        for salt, (near, far) in enumerate(PAIRS):
            first = max(far, skip)
            size = len(part) - first
            if size <= 0:
                continue
            h = mixed[0][first:] + mixed[1][first - near : first - near + size]
            h = h + mixed[2][first - far : first - far + size] + np.uint32(salt * 0x51ED27)
            h = (h ^ (h >> np.uint32(15))) * _MIX[3]
            counts += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """The fingerprint of a text's bytes, in hexadecimal."""
    counts = bucket_counts(data)
    low, middle, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quartile = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    body = quartile.reshape(-1, 4) @ np.array([64, 16, 4, 1], dtype=np.uint8)
    size = min(255, int(8 * np.log2(1 + len(data))))
    place = [15 * int(q) // int(high) if high else 0 for q in (low, middle)]
    return bytes([size, place[0] << 4 | place[1], *body.astype(np.uint8)]).hex()


def _parts(fingerprint: str) -> tuple[int, int, int, np.ndarray]:
    data = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)
    body = (data[2:, None] >> np.array([6, 4, 2, 0], dtype=np.uint8)) & 3
    return int(data[0]), int(data[1] >> 4), int(data[1] & 15), body.ravel().astype(np.int64)


def difference(a: str, b: str) -> int:
    """From 0 for equal fingerprints to ``WORST``."""
    if a == b:
        return 0
    (size, low, middle, body), (size2, low2, middle2, body2) = _parts(a), _parts(b)
    places = abs(low - low2) + abs(middle - middle2)
    return min(WORST, int(_GAP[np.abs(body - body2)].sum()) + abs(size - size2) + 4 * places)


def likeness(a: str, b: str) -> float:
    return 1 - difference(a, b) / WORST


def fingerprint(text: Column) -> Column:
    """Fingerprints of a text column; a null text counts as empty."""

    @F.arrow_udf("string")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array([digest(t or b"") for t in texts.cast(pa.binary()).to_pylist()])

    return column(text)


def likenesses(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns; null where one is null."""

    @F.arrow_udf("double")
    def column(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else likeness(x, y) for x, y in pairs])

    return column(a, b)


_FOUND = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_COLUMNS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(text: str, print_: str, following: str, next_print: str) -> dict:
    """A document against its edited text and the document after it."""
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    edited_print = digest(edited)
    return {
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited).hexdigest(),
        "fingerprint": print_,
        "edited_fingerprint": edited_print,
        "near_edited": likeness(print_, edited_print),
        "near_next": likeness(print_, next_print),
    }


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text), of its edited text and of the next one.

    Edited: the second half of the text (the smaller half) gives way to as many of the first code
    points of the next document by doc_id, or all; the first document follows the last. Nulls of
    doc_id come first, equal ids are ordered by a hash of the text, and a null text is empty. Repeated
    rows follow each other. A lone document follows itself. Texts are taken whole, in slices. An
    empty table gives no rows; other columns are not read.

    Documents are sorted once, by ranges. Each task needs one text of another: the first of the next
    range. These, two texts for each range, are written apart and joined afterwards.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The last key deals equal rows over several ranges; their order among themselves is all the same.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), "tie", "copy"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "copy")
    kind = dealt.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, {_COLUMNS}, part int, head string, tail string"

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, head, last = None, None, None
        part = TaskContext.get().partitionId()
        for batch in batches:
            schema = schema or pa.schema([
                batch.schema.field("doc_id"), *_FOUND,
                ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string()),
            ])
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                print_ = digest(text.encode())
                if last is None:
                    head = text
                else:
                    out.append({"doc_id": last[0], **_compared(*last[1:], text, print_)})
                last = doc_id, text, print_
            yield pa.RecordBatch.from_pylist(out, schema)
        if last is not None:
            edge = {"doc_id": last[0], "part": part, "head": head, "tail": last[1]}
            yield pa.RecordBatch.from_pylist([edge], schema)

    found = spill(dealt.mapInArrow(compared, shape), "fingerprints")
    names = ["doc_id", *[name for name, _ in _FOUND]]
    inner, edges = found.filter("part is null").select(*names), found.filter("part is not null")
    parts = sorted(r[0] for r in edges.select("part").collect())  # one number per range
    follow = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1], strict=True)), "before int, following int"
    )
    heads = edges.select(F.col("part").alias("head_part"), F.col("head").alias("next_head"))
    joined = (
        edges.select("doc_id", "part", "tail")
        .join(follow, F.col("part") == F.col("before"))
        .join(heads, F.col("following") == F.col("head_part"))
        .select("doc_id", "tail", "next_head")
    )

    def closed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field("doc_id"), *_FOUND])
            out = []
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prints = digest(text.encode()), digest(following.encode())
                out.append({"doc_id": doc_id, **_compared(text, prints[0], following, prints[1])})
            yield pa.RecordBatch.from_pylist(out, schema)

    return inner.unionByName(joined.mapInArrow(closed, f"doc_id {kind}, {_COLUMNS}"))
