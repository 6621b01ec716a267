"""Row-by-row comparison of a Spark result with a DuckDB result."""

from collections import Counter
from collections.abc import Sequence

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def open_tables(
    sf_dir: str, names: Sequence[str] = TABLES
) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in names:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, empty if nothing does: columns by name, rows as a bag."""
    expected = connection.sql(sql)
    columns = sorted(result.columns)
    if columns != sorted(expected.columns):
        return [f"columns {columns} != {sorted(expected.columns)}"]
    ours = Counter(tuple(row) for row in result.select(*columns).collect())
    theirs = Counter(expected.select(*columns).fetchall())
    found = [f"only in Spark: {row}"[:300] for row in list((ours - theirs).elements())[:3]]
    found += [f"only in DuckDB: {row}"[:300] for row in list((theirs - ours).elements())[:3]]
    if found:
        found.insert(0, f"{ours.total()} rows in Spark, {theirs.total()} in DuckDB")
    return found
