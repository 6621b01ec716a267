"""Quartile digests against plain loops, and edited texts against sorted rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import fingerprints as fp


def plain_counts(data):
    counts = [0] * 256
    for i in range(len(data)):
        for salt, (near, far) in enumerate(((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))):
            if i >= far:
                h = data[i] * 0x9E3779B1 + data[i - near] * 0x85EBCA77 + data[i - far] * 0xC2B2AE3D
                h = (h + salt * 0x51ED27) % (1 << 32)
                counts[((h ^ (h >> 15)) * 0x27D4EB2F % (1 << 32)) >> 24] += 1
    return counts


def plain_difference(a, b):
    def codes(x):
        return [int(x[4:][k // 2 * 2 : k // 2 * 2 + 2], 16) for k in range(0, 128, 2)]

    score = abs(int(a[:2], 16) - int(b[:2], 16))
    score += 4 * sum(abs(int(a[i], 16) - int(b[i], 16)) for i in (2, 3))
    for x, y in zip(codes(a), codes(b), strict=True):
        for shift in (0, 2, 4, 6):
            score += (0, 1, 2, 6)[abs((x >> shift & 3) - (y >> shift & 3))]
    return min(score, 512)


def plain(rows):
    """Result rows of (doc_id, text) rows in order."""
    out = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [fp.digest(t.encode()) for t in (text, edited, following)]
        near = [1 - plain_difference(prints[0], p) / 512 for p in prints[1:]]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc, len(text), sha, *prints[:2], *near))
    return out


def test_counts_and_digest():
    rng = random.Random(1)
    for size in (0, 1, 2, 3, 4, 5, 9, 700):
        data = bytes(rng.randrange(97, 112) for _ in range(size))
        counts = plain_counts(data)
        assert fp.bucket_counts(data).tolist() == counts
        low, middle, high = (sorted(counts)[k] for k in (63, 127, 191))
        bits = "".join(f"{(c > low) + (c > middle) + (c > high):02b}" for c in counts)
        assert fp.digest(data)[4:] == f"{int(bits, 2):0128x}"
        assert len(fp.digest(data)) == 132


def test_slices_give_the_same_counts(monkeypatch):
    data = bytes(random.Random(2).randrange(256) for _ in range(1000))
    whole = fp.bucket_counts(data)
    for size in (1, 3, 4, 64, 999):
        monkeypatch.setattr(fp, "SLICE", size)
        assert np.array_equal(fp.bucket_counts(data), whole)


def test_likeness_falls_with_edits():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    text = rng.choices(words, k=400)
    prints = [fp.digest(" ".join([*rng.choices(words, k=n), *text[n:]]).encode()) for n in (0, 20, 200)]
    assert fp.likeness(prints[0], prints[0]) == 1
    assert 1 > fp.likeness(prints[0], prints[1]) > fp.likeness(prints[0], prints[2]) >= 0
    assert fp.difference(prints[0], prints[2]) == plain_difference(prints[0], prints[2])


@pytest.mark.parametrize("parts", ["1", "7"])
def test_edited_texts_against_plain_rows(spark, parts):
    rng = random.Random(4)
    letters = "abc déf\U0001f600\n"
    rows = [(i, "".join(rng.choices(letters, k=rng.randrange(60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "long " * 300_000)]
    df = spark.createDataFrame(random.Random(5).sample(rows, len(rows)), "doc_id long, text string")
    df = df.select("*", F.lit(1).alias("part"), F.lit(2).alias("tie"), F.lit("x").alias("fingerprint"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = sorted(map(tuple, fp.with_edits(df).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == plain(rows)


def test_repeated_rows_lone_rows_and_none(spark):
    shape = "doc_id long, text string"
    same = spark.createDataFrame([(1, "aa bb cc dd")] * 5 + [(None, "x")], shape)
    found = fp.with_edits(same).collect()
    assert len(found) == 6
    equal = {r.fingerprint for r in found if r.doc_id == 1}
    assert equal == {fp.digest(b"aa bb cc dd")}
    lone = fp.with_edits(spark.createDataFrame([(7, "abcd")], shape)).collect()
    assert [tuple(r) for r in lone] == plain([(7, "abcd")])
    assert fp.with_edits(spark.createDataFrame([], shape)).collect() == []


def test_columns(spark):
    df = spark.createDataFrame([("abc abd", "abc abe"), (None, "")], "a string, b string")
    prints = df.select(fp.fingerprint(F.col("a")).alias("a"), fp.fingerprint(F.col("b")).alias("b"))
    found = prints.select("*", fp.likenesses(F.col("a"), F.col("b")).alias("near")).collect()
    assert 0 < found[0].near < 1 and found[1].near == 1
