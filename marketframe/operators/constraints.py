"""Table constraints: row rules, uniqueness, referential integrity."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe import schemas

EXAMPLES = 5


class ConstraintError(ValueError):
    """Data that a table must not take."""


def _not_null(*columns: str) -> dict[str, Column]:
    return {f"{name} is null": F.col(name).isNull() for name in columns}


def _length(*columns: str) -> dict[str, Column]:
    return {
        f"{name} is too long": F.length(name) > schemas.MAX_LENGTH[name] for name in columns
    }


def _domain(column: str, values: Sequence[str]) -> dict[str, Column]:
    return {f"{column} is not in its domain": ~F.col(column).isin(*values)}


def dim_rules() -> dict[str, Column]:
    return {**_not_null("coin_id", "symbol", "name"), **_length("coin_id", "symbol", "name")}


def fact_rules() -> dict[str, Column]:
    return {**_not_null(*schemas.FACT_KEYS), **_length("coin_id")}


def run_log_rules() -> dict[str, Column]:
    return {
        **_not_null("stage", "status"),
        **_length("stage", "status"),
        **_domain("stage", schemas.STAGES),
        **_domain("status", schemas.STATUSES),
    }


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per broken rule with the offending row beside it; all rules in a single pass.

    A condition that is NULL is not broken, as with a check constraint.
    """
    broken = F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()])
    return df.select(F.explode(F.array_compact(broken)).alias("rule"), *df.columns)


def assert_rules(
    df: DataFrame,
    rules: Mapping[str, Column],
    table: str,
    partition: Column | None = None,
    example: Column | None = None,
) -> list:
    """Raise if any row breaks a rule: one aggregation without a shuffle of rows.

    The error names, for every broken rule, its number of rows and one value of ``example``. Returns the distinct values of ``partition`` where given, found in the same pass; it must be a
    column of few values.
    """
    names = list(rules)
    counts = [F.count_if(rules[name]).alias(str(i)) for i, name in enumerate(names)]
    shown = F.lit(None).cast("string") if example is None else example.cast("string")
    ones = [F.min(F.when(rules[name], shown)).alias(f"{i}e") for i, name in enumerate(names)]
    values = F.collect_set(F.lit(None) if partition is None else partition)
    row = df.agg(*counts, *ones, values.alias("values")).first()
    found = [
        f"{name} ({n} rows{'' if one is None else f', such as {one}'})"
        for name, n, one in zip(names, row, row[len(names):]) if n
    ]
    if found:
        raise ConstraintError(f"{table}: " + "; ".join(found))
    return row["values"]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    examples = duplicate_keys(df, keys).limit(EXAMPLES).collect()
    if examples:
        raise ConstraintError(f"{table}: duplicate keys, such as {[tuple(r) for r in examples]}")
    return df


def orphan_rows(df: DataFrame, parent: DataFrame, key: str = "coin_id") -> DataFrame:
    """Rows whose key is missing from ``parent``."""
    return df.join(parent.select(key), key, "left_anti").select(*df.columns)


def orphan_counts(df: DataFrame, parent: DataFrame, key: str = "coin_id") -> DataFrame:
    """Keys missing from ``parent`` with their number of rows, counted before the join."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return counts.join(parent.select(key), key, "left_anti")


def split_orphans(
    df: DataFrame, parent: DataFrame, key: str = "coin_id"
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in ``parent``, and the others with a ``reject_reason``."""
    known = df.join(parent.select(key), key, "left_semi").select(*df.columns)
    reason = F.lit(f"{key} not in parent").alias("reject_reason")
    return known, orphan_rows(df, parent, key).select("*", reason)


def assert_no_orphans(
    df: DataFrame, parent: DataFrame, table: str, key: str = "coin_id"
) -> DataFrame:
    """Any orphan fails the whole load."""
    examples = orphan_counts(df, parent, key).limit(EXAMPLES).collect()
    if examples:
        raise ConstraintError(f"{table}: {key} not in parent, such as {[r[0] for r in examples]}")
    return df
