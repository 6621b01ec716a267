"""Near duplicates by SimHash, found with covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Two documents
are linked when their fingerprints differ in at most ``radius`` bits. Candidates come from
2 ** (radius + 1) - 1 tables, each keyed by the fingerprint under a bit mask. The masks are built so
that for any set of at most ``radius`` differing bits some mask covers none of them (Pagh's covering
construction): each bit position holds a vector of radius + 1 bits, mask ``v`` holds the positions
whose vector has an odd product with ``v``, and ``radius`` vectors leave some non-zero ``v``
orthogonal to them all. No linked pair can be missed.

Work is done on distinct fingerprints, so exact copies cost one row whatever their number. A bucket
gives a spanning forest of its links, never all its pairs. A bucket above ``bucket_limit`` is split
first: its free bits are cut into radius + 1 blocks, and linked pairs agree on at least one of them.
Each split fixes more bits, so a bucket of distinct fingerprints must shrink below the limit.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import fresh, ship, spill
from marketframe.llm.components import components

SHINGLE, RADIUS, BITS, SEED = 4, 4, 64, 42
BUCKET_LIMIT = 4096


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: 0 without words; shorter than a shingle, the whole is one."""
    words = (text or b"").lower().split()  # on bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    width, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)],
        dtype="<u8",
    )
    votes = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        rows = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed longs."""

    @F.arrow_udf("long")
    def column(texts: pa.Array) -> pa.Array:
        values = [simhash(text, shingle) for text in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return column(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2 ** (radius + 1) - 1 masks of which one avoids any ``radius`` bit positions."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def split_mask(mask: int, radius: int = RADIUS) -> list[int]:
    """``mask`` with each of radius + 1 blocks of its free bits added."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    blocks = [free[k :: radius + 1] for k in range(radius + 1)]
    return [mask | sum(1 << i for i in block) for block in blocks if block]


def spanning_links(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect whatever the pairs within ``radius`` connect; at most one per value."""
    left, links = values, []
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            # Unsigned: numpy counts the bits of a negative number's absolute value.
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius
            links += [(int(at), int(x)) for x in left[near]]
            reached += list(left[near])
            left = left[~near]
    return links


def _bucket_links(radius: int) -> object:
    @F.arrow_udf("array<struct<a:long,b:long>>")
    def column(buckets: pa.Array) -> pa.Array:
        out = [
            [{"a": a, "b": b} for a, b in spanning_links(np.unique(np.array(x, dtype=np.int64)), radius)]
            for x in buckets.to_pylist()
        ]
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.array(out, type=kind)

    return column


def links_within(
    prints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``prints`` (fp) that join the same classes
    as all pairs within ``radius`` bits."""
    spark, masks = prints.sparkSession, covering_masks(radius)
    mask = F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")
    rows = prints.select("fp", mask).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    found = None
    while True:
        counts = rows.groupBy("mask", "key").count().filter("count > 1")
        # Merged by hint: Spark sizes the exploded rows as if they were one per fingerprint and
        # would broadcast them.
        shared = spill(rows.join(counts.hint("merge"), ["mask", "key"]), "buckets")
        small = shared.filter(F.col("count") <= bucket_limit)
        links = (
            small.groupBy("mask", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select(F.explode(_bucket_links(radius)("fps")).alias("link"))
            .select("link.*")
        )
        found = links if found is None else found.unionByName(links)
        large = shared.filter(F.col("count") > bucket_limit)
        masks = [r.mask for r in large.select("mask").distinct().collect()]  # a fixed family
        if not masks:
            return spill(found.distinct(), "links")
        finer = [(m, _signed(s)) for m in masks for s in split_mask(m % (1 << BITS), radius)]
        steps = spark.createDataFrame(finer, "mask long, finer long")
        rows = (
            large.join(F.broadcast(steps), "mask")
            .select("fp", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"))
        )


def near_duplicates(
    docs: DataFrame,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    bucket_limit: int = BUCKET_LIMIT,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` (doc_id, text), with fp and component_id.

    ``component_id`` is the smallest doc_id among the documents that links reach, its own included.
    Null and empty texts have fingerprint 0 and are linked like any other. Rows without a doc_id
    link but never name a component, unless it has no doc_id at all: then it is null. Repeated rows
    are equal fingerprints. An empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    fp, component = fresh(docs, "fp"), fresh(docs, "component_id")
    columns = dict.fromkeys([*keep, "doc_id"])
    printed = spill(docs.select(*columns, fingerprint(F.col("text"), shingle).alias(fp)), "prints")
    first = spill(
        printed.groupBy(F.col(fp).alias("fp")).agg(F.min("doc_id").alias("first")), "first"
    )
    roots = components(links_within(first.select("fp"), radius, bucket_limit))
    rooted = first.join(roots, first["fp"] == roots["node"])
    smallest = rooted.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = rooted.join(smallest, "root").select(F.col("fp").alias("linked_fp"), "smallest")
    classes = spill(
        first.join(linked, F.col("fp") == F.col("linked_fp"), "left").select(
            F.col("fp").alias("_s_fp"),
            F.when(F.col("linked_fp").isNull(), F.col("first")).otherwise(F.col("smallest")).alias(
                "_s_id"
            ),
        ),
        "classes",
    )
    joined = printed.join(classes, printed[fp] == classes["_s_fp"])
    return joined.select(
        *[F.col(c) for c in keep], F.col(fp), F.col("_s_id").alias(component)
    )


def one_per_group(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with one row per group of near duplicates: the one whose doc_id names the group.

    Repeated rows of that doc_id leave the one with the smallest text; a group without any doc_id
    leaves one row per fingerprint. Columns are those of ``docs``.
    """
    names = docs.columns
    classed = near_duplicates(docs, keep=tuple(names), **options)
    fp, component = classed.columns[len(names) :]
    # Only rows that carry the group's name are compared: one per group, but for repeated rows.
    named = classed.filter(F.col("doc_id").eqNullSafe(F.col(component)))
    place = fresh(classed, "place")
    unnamed = F.when(F.col(component).isNull(), F.col(fp))
    group = Window.partitionBy(component, unnamed).orderBy(F.col("text").asc_nulls_first())
    return named.withColumn(place, F.row_number().over(group)).filter(F.col(place) == 1).select(*names)
