"""Repair of conversations against all edits of each."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from marketframe.llm import conversations as conv

SPACE = " \t\n\x0b\x0c\r"
WORDS = ["Yes.", "No!", "cut off", "", " \t", "Why?", "so. ", "end"]


def cheapest(kinds):
    """Least (cost, audit, outputs) over all edits, by the grammar's states; ``kinds``: (initial,
    must go, cut off) of each turn."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserts):
        ways = [(0, "", ())] if i == len(kinds) and state in ("", "a") else []
        if i < len(kinds):
            initial, gone, cut = kinds[i]
            for letter, cost, to in [("D", 2, None)] + [
                ("K" if initial == to else "R", (initial != to) + 5 * cut, to)
                for to in follow[state] if not gone and (initial == to or to != "s")
            ]:
                cost_on, audit, out = best(i + 1, to or state, 0)
                ways.append((cost + cost_on, letter + audit, ((letter, to, i), *out)))
        if inserts < 2:
            for to in follow[state]:
                if to != "s":
                    cost_on, audit, out = best(i, to, inserts + 1)
                    ways.append((5 + cost_on, "I" + audit, (("I", to, None), *out)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    return best(0, "", 0)


def plain(rows):
    """Audit row of one conversation's (turn, role, text) rows, damaged and in order."""
    seen, kinds, counts, last = set(), [], [0, 0, 0, 0], None
    for _, role, text in rows:
        bare = text.strip(SPACE)
        blank, repeat = not bare, (role, text) in seen
        cut = bool(bare) and bare[-1] not in ".!?"
        counts[0 if blank else 1 if repeat else 2] += blank or repeat or cut
        counts[3] += last is not None and last + role[:1] not in ("su", "ua", "au")
        seen.add((role, text))
        last = role[:1]
        kinds.append((role[:1], blank or repeat, cut))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = cheapest(tuple(kinds))
    names = {"u": "user", "a": "assistant"}
    lines = [
        f"{rows[i][1] if letter == 'K' else names[to]}:{'' if i is None else rows[i][2]}"
        for letter, to, i in out if letter != "D"
    ]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (cost, *counts, gaps, audit, digest)


def damaged(rows):
    """{conv_id: rows in order} of (conv_id, turn, role, text)."""
    out = {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        held = out.setdefault(c, [])
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        held += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def test_alignment_is_cheapest_and_least():
    rng = random.Random(5)
    for _ in range(1500):
        letters = "".join(rng.choices("suaoxSUAO", [2, 6, 6, 1, 2, 1, 2, 2, 1], k=rng.randrange(13)))
        paths = conv.Paths([conv.START])
        size = rng.choice([1, 3, 16])
        for at in range(0, len(letters), size):
            paths.add(letters[at : at + size])
        state = conv.ending(paths.best[conv.START])
        audit = paths.audit(conv.START, state) + conv.ENDING[state]
        cost = paths.best[conv.START][state][0] + 5 * len(conv.ENDING[state])
        kinds = tuple((k.lower(), k == "x", k.isupper()) for k in letters)
        assert (cost, audit) == cheapest(kinds)[:2], letters


def test_blocks_join_to_the_whole():
    rng = random.Random(6)
    for _ in range(300):
        letters = "".join(rng.choices("suaoxSUA", k=rng.randrange(1, 40)))
        matrices, at = [], 0
        while at < len(letters):
            cut = letters[at : at + rng.randrange(1, 9)]
            paths = conv.Paths(conv.STATES)
            paths.add(cut)
            matrices.append((paths, [
                {"entry": e, "state": s, "cost": w[0], "rank": w[1]}
                for e, ways in paths.best.items() for s, w in ways.items()
            ]))
            at += len(cut)
        cost, steps = conv.best_path([m for _, m in matrices])
        audit = "".join(p.audit(e, s) for (p, _), (e, s) in zip(matrices, steps, strict=True))
        audit += conv.ENDING[steps[-1][1]]
        kinds = tuple((k.lower(), k == "x", k.isupper()) for k in letters)
        assert (cost, audit) == cheapest(kinds)[:2], letters


def make_rows(seed):
    rng, rows = random.Random(seed), []
    for c in [*range(40), None]:
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            number = None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2])
            rows.append((c, number, role, rng.choice([*WORDS, None, f"Turn {turn}."])))
    rows += [(77, t, ("user", "assistant")[t % 2], f"Long {t}." if t % 9 else "again") for t in range(150)]
    rows += [(78, 3, "user", "Same."), (78, 3, "user", "Same.")] * 20
    return rows + rows[:5]


@pytest.mark.parametrize("limits", [{}, {"most_turns": 2, "block_turns": 7}, {"most_bytes": 1}])
def test_repair_against_the_plain_version(spark, limits):
    rows = make_rows(3)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as cost", "'x' as turns", "2 as block").repartition(3)
    found = {r[0]: tuple(r)[1:] for r in conv.audits(conv.damage(df), **limits).collect()}
    want = {c: plain(r) for c, r in damaged(rows).items()}
    assert found == want
    assert len(found[77][6]) > 100


def test_repaired_turns_alternate(spark):
    df = spark.createDataFrame(make_rows(4), "conv_id long, turn long, role string, text string")
    blocks = conv.repair(conv.damage(df), most_turns=5, block_turns=3)
    rows = blocks.selectExpr("conv", "block", "inline(turns)").orderBy("conv", "block").collect()
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r.conv, []).append(r.role[0] if r.edit != "D" else "")
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by_conv.values())


def test_empty_and_dropped(spark):
    shape = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], shape)
    assert conv.audits(conv.damage(empty)).collect() == []
    gone = next(t for t in range(200) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    one = conv.audits(conv.damage(spark.createDataFrame([(5, gone, "user", "Hi.")], shape))).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in one] == [(5, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_a_very_long_text(spark):
    shape = "conv_id long, turn long, role string, text string"
    rows = [(1, 1, "user", "word " * 400_000 + "end."), (1, 2, "assistant", "Yes.")]
    found = conv.audits(conv.damage(spark.createDataFrame(rows, shape))).collect()
    assert tuple(found[0])[1:] == plain(damaged(rows)[1])
