"""The secret network learns from every finding, block by block."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marketframe.llm import secret_scan as sc

DOCS = "doc_id long, text string"


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda a, k: "".join(rng.choices(a, k=k))
    rows = []
    for i in range(n):
        token, plain = word("0123456789abcdef", 40), word("aeinrst", rng.randrange(16, 30))
        rows.append((i, f"some {plain} words, token = '{token}' and {plain.upper()} more"))
    return rows


def found_in(spark, rows):
    return spark.createDataFrame(rows, DOCS).mapInArrow(sc._find, sc.FOUND)


def test_every_window_is_learned_from(spark):
    """More findings of each kind than the 3000 that a sample once held."""
    rows = texts(1, 3500)
    rows += [rows[0], rows[0], (None, rows[1][1])]
    found = found_in(spark, rows)
    blocks = sc.labelled_blocks(found, sc.Network(block=900))
    held, want = Counter(), Counter()
    for row in blocks.collect():
        assert 0 < len(row.rows) < 1200
        for r in row.rows:
            held[r.label, r.window] += r.n
    for row in found.collect():
        want.update((1, w) for w in row.known)
        want.update((0, x.window) for x in row.more)
    assert held == want and held.total() == 3503 * 4  # a token is found by two rules
    sets = blocks.mapInArrow(sc._half_sets(sc.Network()), sc.SET).select("model", F.explode("counts").alias("n"))
    weights = {r.model: r.n for r in sets.groupBy("model").agg(F.sum("n").alias("n")).collect()}
    assert sum(weights.values()) == 2 * 2 * 7006 + 7006  # findings twice in each half, other runs in one


def test_the_network_does_not_depend_on_how_rows_are_dealt(spark):
    rows, n = texts(2, 150), sc.Network(block=100, epochs=2)
    sc.ship(spark)
    models = [sc.learn(found_in(spark, rows).repartition(k), n) for k in (1, 7)]
    assert np.array_equal(models[0].packed(), models[1].packed())
    assert models[0].threshold == models[1].threshold


def test_blocks_find_a_key_of_another_alphabet(spark):
    rows = texts(3, 400)
    key = "".join(random.Random(5).choices(sc.ALPHABET, k=40))
    rows += [(1000, f"some words key = '{key}' more")]
    found = sc.find_secrets(spark.createDataFrame(rows, DOCS), sc.Network(block=300)).collect()
    added = {r.doc_id: [rows[-1][1][s.start : s.stop] for s in r.added] for r in found if r.added}
    assert added == {1000: [key]}


def test_a_counted_window_weighs_as_its_copies():
    ids = sc.char_ids(["\0" * 40 + w for w in ("a" * 20, "b" * 20, "b" * 20, "b" * 20)])
    labels, model = np.array([1.0, 0.0, 0.0, 0.0]), sc.CharCnn(sc.Network())
    few = ids.take(np.array([0, 1]))
    pairs = zip(model._gradients(ids, labels), model._gradients(few, labels[:2], np.array([1.0, 3.0])), strict=True)
    assert all(np.allclose(a, b) for a, b in pairs)
    x = np.array([0.5, 1.0, 2.0, -1.0, 0.0])
    y, counts = np.array([1.0, 1, 1, 0, 0]), np.array([1.0, 3, 2, 2, 4])
    other = sc.CharCnn(sc.Network())
    model.settle(x, x, y, counts)
    k = counts.astype(int)
    other.settle(np.repeat(x, k), np.repeat(x, k), np.repeat(y, k), np.ones(k.sum()))
    assert np.allclose([model.slope, model.shift, model.threshold], [other.slope, other.shift, other.threshold])


def test_a_sum_of_blocks_gives_their_average():
    a, b = sc.CharCnn(sc.Network(seed=1)), sc.CharCnn(sc.Network(seed=2))
    ids, labels = sc.char_ids(["\0" * 40 + w for w in ("a" * 20, "b" * 30)]), np.array([1.0, 0.0])
    for net in (a, b):
        net.epoch(ids, labels, np.ones(2), [1])
    mean = sc.CharCnn(sc.Network())
    mean.unpack(a.packed() + b.packed(), 2)
    for p, q, r in zip(a._parameters(), b._parameters(), mean._parameters(), strict=True):
        assert np.allclose((p + q) / 2, r, atol=1e-9)
    assert mean.steps[0] == 1
