"""Fingerprints are signed longs; their highest bit counts like any other."""

import random

import brute
import numpy as np

from marketframe.llm import simhash

TOP = 1 << 63


def test_spanning_links_cross_the_highest_bit():
    rng = random.Random(4)
    for _ in range(200):
        print_, others = rng.getrandbits(64), rng.sample(range(63), 3)
        near = print_ ^ TOP ^ sum(1 << b for b in others)
        far = print_ ^ TOP ^ sum(1 << b for b in rng.sample(range(63), 4))
        signed = sorted(simhash._signed(p) for p in (print_, near))
        (link,) = simhash.spanning_links(np.array(signed, dtype=np.int64))
        assert sorted(link) == signed
        signed = sorted(simhash._signed(p) for p in (print_, far))
        assert simhash.spanning_links(np.array(signed, dtype=np.int64)) == []
    opposite = np.array([-1, 0], dtype=np.int64)  # 64 bits apart
    assert simhash.spanning_links(opposite) == []


def test_groups_that_differ_in_the_highest_bit_stay_whole(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*words[i % 7 :], *["x"] * (i % 3), f"y{i % 11}"])) for i in range(60)]
    assert len({simhash.simhash(text.encode()) >> 63 for _, text in rows}) == 2
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.near_duplicates(rows)
