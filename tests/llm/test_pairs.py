"""SimHash, covering tables and components."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from marketframe.llm import simhash
from marketframe.llm.components import components

DOCS = "doc_id long, text string"


def texts(n, seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(60)) for _ in range(4)]
    out = []
    for i in range(n):
        ws = base[i % 4].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            ws[rng.randrange(len(ws))] = rng.choice("klmnop")
        out.append((i * 3 % 101, rng.choice([" ", "\n", "  "]).join(ws)))
    return out


def test_masks_cover_every_small_set_of_bits():
    rng = random.Random(1)
    for radius in (1, 3, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            bits = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not mask & bits for mask in masks)
    for mask in simhash.covering_masks()[:5]:
        finer = simhash.split_mask(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        bits = sum(1 << b for b in rng.sample(free, 4))
        assert any(not f & bits for f in finer) and all(f & mask == mask for f in finer)


def test_fingerprints_match_the_plain_version():
    odd = ["", None, "One", "a b c", "É À É À x", "A\x0bB\x1cC d e f", "x " * 5000]
    for text in odd + [t for _, t in texts(12)]:
        assert simhash.simhash(None if text is None else text.encode()) == brute.fingerprint(text)


@pytest.mark.parametrize("limit", [4096, 3])
def test_components_match_all_pairs(spark, limit):
    rows = texts(100) + [(900, ""), (901, None), (902, " \n")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS), bucket_limit=limit)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.near_duplicates(rows)
    sample = {r.doc_id: r.fp % (1 << 64) for r in found.collect()}
    assert all(sample[i] == brute.fingerprint(t) for i, t in rows)


def test_hot_groups_split_and_stay_linked(spark):
    """Fingerprints in one dense ball: far more in a bucket than its limit."""
    rng = random.Random(5)
    prints = {sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)}
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    links = [tuple(r) for r in simhash.links_within(frame, 4, 16).collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in links)
    nodes = [simhash._signed(p) for p in prints]
    every = [(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 4]
    assert brute.classes(nodes, links) == brute.classes(nodes, every)


def test_edges_of_near_duplicates(spark):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (None, "q"), (7, "zz yy")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(str, (r.component_id for r in found))) == ["5", "5", "5", "7", "None"]
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    wide = spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("fp"), F.lit(2).alias("FPS"),
                                                    F.lit(3).alias("component_id"), F.lit(4).alias("u"))
    kept = simhash.one_per_group(wide)
    assert kept.columns == wide.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "7", "None"]


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for nodes, count in ((40, 25), (300, 290), (2, 1), (5, 0)):
        edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(count)]
        edges += [(i, i + 1) for i in range(1000, 1040)] if count else []
        found = components(spark.createDataFrame(edges, "a long, b long"))
        linked = {x for a, b in edges if a != b for x in (a, b)}
        assert {r.node: r.root for r in found.collect()} == brute.classes(linked, [e for e in edges if e[0] != e[1]])
