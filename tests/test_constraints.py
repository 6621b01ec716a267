from datetime import date

import pytest

from marketframe.operators import (
    ConstraintError,
    assert_no_orphans,
    assert_rules,
    assert_unique,
    dim_rules,
    duplicate_keys,
    fact_rules,
    orphan_counts,
    orphan_rows,
    run_log_rules,
    violations,
)


@pytest.fixture
def dim(spark):
    return lambda *rows: spark.createDataFrame(rows, "coin_id string, symbol string, name string")


def test_lengths_and_nulls(dim):
    good = dim(("a" * 100, "s" * 100, "n" * 300))
    assert violations(good, dim_rules()).count() == 0
    assert_rules(good, dim_rules(), "dim")
    bad = dim(("a" * 101, None, "n" * 301), ("b", "B", "Bb"))
    assert sorted(r.rule for r in violations(bad, dim_rules()).collect()) == [
        "coin_id is too long", "name is too long", "symbol is null",
    ]
    with pytest.raises(ConstraintError, match="symbol is null \\(1 rows\\)"):
        assert_rules(bad, dim_rules(), "dim")


def test_empty_text_is_not_null(dim):
    assert_rules(dim(("a", "", "")), dim_rules(), "dim")


def test_partition_values_come_from_the_same_pass(spark):
    frame = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1))], "coin_id string, price_date date"
    )
    assert assert_rules(frame, fact_rules(), "fact", frame.price_date) == [date(2024, 1, 1)]
    with pytest.raises(ConstraintError):
        assert_rules(spark.createDataFrame([("a", None)], frame.schema), fact_rules(), "fact")


def test_domains(spark):
    log = spark.createDataFrame(
        [("loading", "running"), ("quality", "success"), ("loading", "done"), (None, "failed")],
        "stage string, status string",
    )
    found = {(r.rule, r.stage, r.status) for r in violations(log, run_log_rules()).collect()}
    assert found == {
        ("stage is not in its domain", "quality", "success"),
        ("status is not in its domain", "loading", "done"),
        ("stage is null", None, "failed"),
    }


def test_uniqueness(dim):
    twice = dim(("a", "A", "1"), ("a", "A", "2"), ("b", "B", "3"))
    assert [tuple(r) for r in duplicate_keys(twice, ["coin_id"]).collect()] == [("a", 2)]
    with pytest.raises(ConstraintError, match="duplicate keys"):
        assert_unique(twice, ["coin_id"], "dim")
    assert_unique(twice, ["coin_id", "name"], "dim")


def test_orphans(dim, prices):
    parent = dim(("a", "A", "Aa"))
    fact = prices([("a", "2024-01-01", 1.0), ("z", "2024-01-01", 1.0), ("z", "2024-01-02", 1.0)])
    assert orphan_rows(fact, parent).count() == 2
    assert orphan_rows(fact, parent).columns == fact.columns
    assert [tuple(r) for r in orphan_counts(fact, parent).collect()] == [("z", 2)]
    with pytest.raises(ConstraintError, match="'z'"):
        assert_no_orphans(fact, parent, "fact")
    assert_no_orphans(fact.filter("coin_id = 'a'"), parent, "fact")
