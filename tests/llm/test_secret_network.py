"""The secret network against plain loops, and its recall on planted keys."""

import random

import numpy as np
import pytest

from marketframe.llm import secret_scan as sc


def windows(seed, n=12):
    rng = random.Random(seed)
    text = "".join(rng.choices("abcXYZ019 =\"'+/é", k=6000))
    out = []
    for _ in range(n):
        start = rng.randrange(5000)
        out.append(sc.window(text, start, start + rng.choice([16, 43, 44, 45, 84, 85, 200, 900])))
    return out


def plain_logit(model, window):
    """Every place of the whole candidate, one after the other."""
    hidden = []
    parts = [window[:20], window[20:40], window[40:]]
    for side, part in enumerate(parts):
        codes = [min(ord(c), 128) for c in part]
        if side == 2:  # the padding of the last chunk
            step = sc.CHUNK - model.n.width + 1
            chunks = max(1, -(-(len(codes) - model.n.width + 1) // step))
            codes += [0] * ((chunks - 1) * step + sc.CHUNK - len(codes))
        places = [
            sum(model.own[side, k, codes[i + k]] for k in range(model.n.width))
            for i in range(len(codes) - model.n.width + 1)
        ]
        hidden.append(np.maximum(np.max(places, axis=0) + model.bias[side], 0))
    return float(np.concatenate(hidden) @ model.out + model.last[0])


def test_long_candidates_are_seen_whole():
    model = sc.CharCnn(sc.Network())
    found = model.logits(sc.char_ids(windows(1)))
    assert np.allclose(found, [plain_logit(model, w) for w in windows(1)])


def test_gradients_are_slopes_of_the_loss():
    model = sc.CharCnn(sc.Network(filters=3))
    ids, labels = sc.char_ids(windows(2)), np.array([0.0, 1.0] * 6)

    def loss():
        p = 1 / (1 + np.exp(-model.logits(ids)))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    grads = model._gradients(ids, labels)
    rng = np.random.default_rng(1)
    for parameter, grad in zip(model._parameters(), grads, strict=True):
        places = np.argwhere(np.abs(grad) > 1e-6)
        for place in places[rng.permutation(len(places))[:8]]:
            at, before = tuple(place), parameter[tuple(place)]
            parameter[at] = before + 1e-6
            up = loss()
            parameter[at] = before - 1e-6
            slope = (up - loss()) / 2e-6
            parameter[at] = before
            assert slope == pytest.approx(grad[at], rel=1e-3, abs=1e-6)


def test_taken_rows_keep_their_chunks():
    model, ids = sc.CharCnn(sc.Network()), sc.char_ids(windows(3))
    rows = np.array([5, 0, 11, 5])
    assert np.allclose(model.logits(ids.take(rows)), model.logits(ids)[rows])


def test_the_threshold_keeps_the_recall_where_classes_overlap():
    model = sc.CharCnn(sc.Network(recall=0.95))
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdef"), 30)) for _ in range(400)]
    ids, labels = sc.char_ids(["\0" * 40 + t for t in texts]), (rng.random(400) < 0.3).astype(float)
    model.calibrate(ids, labels)
    assert (model.probability(ids)[labels == 1] >= model.threshold).mean() >= 0.95
    assert model.threshold < 0.5


def test_a_finding_that_holds_many_others_is_seen():
    run = "/".join("ab12" * 7 for _ in range(30))
    text = f"token = {run}"
    base = sc.base_spans(text)
    assert len(base) > 20 and sc.candidates(text, base) == []
    plain = [(a, b) for a, b in sc.candidates("x " + "Q" * 20 + " " + text, sc.base_spans("x " + "Q" * 20 + " " + text))]
    assert plain == [(2, 22)]


def test_recall_on_planted_keys(spark):
    """Keys of another alphabet and length, in contexts that the base rules do not name. They are few, as
    what the base rules do not find counts as no secret in training."""
    rng = random.Random(7)
    draw = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()
    planted, rows = {}, []
    for doc_id, text in docs:
        text = text or ""
        if rng.random() < 0.005:
            key = draw(sc.ALPHABET, rng.choice([32, 40, 64]))
            name = draw("abcdefghijklmnopqrstuvwxyz", rng.randrange(3, 9))
            lead = text + rng.choice([f" {name}: '", f" see {name} ", f'\n{name}="', f" ({name}) <", f" {name} -> `"])
            planted[doc_id] = (len(lead), len(lead) + len(key))
            text = lead + key + rng.choice(["' end", " and so on", '"\n', ">.", "`"])
        rows.append((doc_id, text))
    found = sc.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    added = {r.doc_id: {(s.start, s.stop) for s in r.added} for r in found}
    caught = np.mean([place in added[d] for d, place in planted.items()])
    false = sum(len(a) for d, a in added.items() if d not in planted)
    assert len(planted) > 30 and caught >= 0.95, caught
    assert false <= 0.02 * len(rows), false
