"""Documents read by byte ranges, against the same documents parsed whole."""

import json
import random

import pytest

from marketframe.sources import (
    ranges,
    read_description_document,
    read_descriptions,
    read_history,
    read_history_document,
)


def odd_document(rng):
    """A history document with awkward names, fields, spacing and repeated coins."""
    names, entries = ["a", 'b"q', "c\\", "[x]", "{y", "é,:", '"prices"', "d\\\\"], []
    for _ in range(rng.randrange(1, 7)):
        fields = {}
        for field in rng.sample(["prices", "market_caps", "note"], rng.randrange(4)):
            points = [[rng.randrange(10**12), rng.random()] for _ in range(rng.randrange(9))]
            points += rng.choice([[], [[5]], [[]], [[None, 2.5]], [[1.0, None]]])
            text = rng.choice(['text ] [ { " \\ :', None, 3])
            fields[field] = text if field == "note" else rng.choice([None, [], points])
        coin = json.dumps(rng.choice(names) + str(rng.randrange(3)), ensure_ascii=rng.random() < 0.5)
        gap = rng.choice([":", ": ", " :\n"])
        entries.append(coin + gap + json.dumps(fields, separators=(rng.choice([",", " ,\n"]), gap)))
    return "{" + rng.choice([",", ",\n", " , "]).join(entries) + rng.choice(["}", " }\n"])


def plain(text):
    rows = []
    for coin, fields in json.loads(text, object_pairs_hook=list):
        for field, points in fields:
            if field == "prices":
                rows += [
                    (coin, None if not p or p[0] is None else int(p[0]), p[1] if len(p) > 1 else None)
                    for p in points or []
                ]
    return rows


def described(path, step):
    size = path.stat().st_size
    marks = []
    for start in range(0, size, step):
        part = ranges.Range(str(path), start, min(size, start + step), size)
        place = {"path": str(path), "start": start, "stop": part.stop, "size": size}
        marks.append({"range": place, "marks": ranges.describe(part)})
    return marks


def read_back(path, step, read=ranges.points):
    rows = []
    for place in ranges.place_ranges(described(path, step)):
        part = ranges.Range(str(path), place["start"], place["stop"], place["size"])
        for batch in read(part, place, None):
            rows += zip(*(column.to_pylist() for column in batch.columns), strict=True)
    return rows


def test_any_cut_gives_the_same_points(tmp_path, monkeypatch):
    rng = random.Random(1)
    for number in range(150):
        path = tmp_path / f"{number}.json"
        text = odd_document(rng)
        path.write_text(text)
        monkeypatch.setattr(ranges, "TAIL", rng.choice([1, 7, 1000]))
        for step in (1, rng.randrange(2, 60), 10**6):
            assert read_back(path, step) == plain(text), (step, text)


def test_any_cut_gives_the_same_texts(tmp_path, monkeypatch):
    rng = random.Random(2)
    letters = 'ab"\\{}[]:, \té\n'
    for number in range(100):
        texts = {"".join(rng.choices(letters, k=rng.randrange(6))): rng.choice(
            [None, "".join(rng.choices(letters, k=rng.randrange(30)))]) for _ in range(5)}
        path = tmp_path / f"{number}.json"
        path.write_text(json.dumps(texts, indent=rng.choice([None, 2])))
        monkeypatch.setattr(ranges, "TAIL", rng.choice([1, 9]))
        for step in (1, rng.randrange(2, 40), 10**6):
            assert dict(read_back(path, step, ranges.texts)) == texts


@pytest.mark.parametrize("text", ['{"a": {"prices": [[1, 2]', '{"a": "x', '{"a": {"prices": [[1, 2]]}}}'])
def test_a_cut_document_fails(tmp_path, text):
    path = tmp_path / "cut.json"
    path.write_text(text)
    with pytest.raises(ranges.MalformedDocument):
        read_back(path, 5)


@pytest.mark.parametrize("text", ['{"a": {"prices": [["x", 2]]}}', '{"a": {"prices": [[1, true]]}}'])
def test_a_point_that_is_no_number_fails(tmp_path, text):
    path = tmp_path / "odd.json"
    path.write_text(text)
    with pytest.raises(ranges.MalformedDocument):
        read_back(path, 1000)


def test_readers_agree(spark, tmp_path):
    rng = random.Random(3)
    for number in range(4):
        (tmp_path / f"{number}.json").write_text(odd_document(rng))
    (tmp_path / "_hidden").write_text("no JSON")
    (tmp_path / "none.json").write_text("")
    found = read_history_document(spark, str(tmp_path), range_bytes=37)
    whole = sorted(read_history(spark, str(tmp_path)).collect(), key=str)
    assert sorted(found.collect(), key=str) == whole and whole
    assert found.rdd.getNumPartitions() > 8


def test_coins_asked_for_reach_the_reader(spark, tmp_path, plan):
    (tmp_path / "h.json").write_text(json.dumps({c: {"prices": [[1, 2.0]]} for c in "abc"}))
    found = read_history_document(spark, str(tmp_path / "h.json")).filter("coin_id in ('a', 'c')")
    assert sorted(r.coin_id for r in found.collect()) == ["a", "c"]
    assert "Filter coin_id" not in plan(found) and "(Python)" in plan(found)


def test_descriptions_agree(spark, tmp_path):
    texts = {"a": 'x "y" \\ ] }', "b": None, "c": "", "dé": "long " * 3000}
    (tmp_path / "d.json").write_text(json.dumps(texts, indent=1))
    found = read_description_document(spark, str(tmp_path), range_bytes=11)
    assert sorted(found.collect()) == sorted(read_descriptions(spark, str(tmp_path)).collect())
