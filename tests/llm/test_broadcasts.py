"""What Spark may send to every task, whatever it takes a table's size to be."""

import brute
import pytest
from test_pairs import DOCS, texts

from marketframe.llm import simhash


@pytest.mark.parametrize("call", ["near_duplicates", "one_per_group"])
def test_exploded_fingerprints_are_not_broadcast(spark, plan, monkeypatch, call):
    """A row per fingerprint and mask: Spark takes them for as many as the fingerprints."""
    plans, spill = [], simhash.spill

    def noted(df, purpose):
        plans.append((purpose, plan(df)))
        return spill(df, purpose)

    monkeypatch.setattr(simhash, "spill", noted)
    rows = list({i: (i, text) for i, text in texts(100)}.values())
    found = getattr(simhash, call)(spark.createDataFrame(rows, DOCS)).collect()
    groups = brute.near_duplicates(rows)
    if call == "near_duplicates":
        assert {r.doc_id: r.component_id for r in found} == groups
    else:
        assert sorted(r.doc_id for r in found) == sorted(set(groups.values()))
    exploded = [text for purpose, text in plans if purpose == "buckets"]
    assert exploded and all("Generate" in text and "SortMergeJoin" in text for text in exploded)
    assert not any("Broadcast" in text for text in exploded)
