"""What only shows on larger or odder tables than the test data."""

import json

import duckdb
import pyarrow as pa
import pytest
from pyspark import TaskContext

import __spark_entry__ as suite
from bindings import fixtures as fx
from marketframe.sources import read_description_document


def events(tmp_path, rows, ts):
    """An events table of ``rows`` rows, all at ``ts``."""
    duckdb.sql(
        f"""copy (select i as event_id, timestamp '{ts}' as ts, i % 10 as user_id, 'view' as event_type,
                         1.5 as value, '' as props from range({rows}) r(i))
            to '{tmp_path}/events.parquet' (format parquet)"""
    )
    return str(tmp_path)


def test_a_sum_beyond_a_bigint_is_exact(spark, tmp_path):
    ms = 253402214400000  # 9999-12-31
    row = suite.queries()["history_malformed"](spark, events(tmp_path, 35_000, "9999-12-31 00:00:00")).first()
    assert (row.points, row.malformed) == (60_000, 5_000)
    assert int(row.sum_ms) == 30_000 * (2 * ms + 1) > 2**63


def test_a_sum_that_a_bigint_holds_is_one(spark, tmp_path):
    found = suite.queries()["history_malformed"](spark, events(tmp_path, 70, "1960-01-01 00:00:00"))
    assert dict(found.dtypes) == {"points": "bigint", "sum_ms": "bigint", "malformed": "bigint"}
    assert found.first().sum_ms == 60 * (2 * -315619200000 + 1)


def written_by_task(spark):
    """A text per row: the number of the task that made it."""

    def by_task(batches):
        for batch in batches:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist(
                [{"value": json.dumps({f"é{i}": str(task)}, ensure_ascii=False)} for i in batch["id"].to_pylist()]
            )

    return spark.range(0, 40, 1, 4).mapInArrow(by_task, "value string")


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_one_document_is_written_by_many_tasks(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(fx, "PIECE_BYTES", piece, raising=False)
    path = fx.write_one_document(written_by_task(spark), f"{tmp_path}/landed")
    (file,) = (tmp_path / "landed").iterdir()
    held = json.loads(file.read_text())
    assert sorted(held) == sorted(f"é{i}" for i in range(40)) and set(held.values()) == set("0123")
    assert sorted(read_description_document(spark, path, range_bytes=11).collect()) == sorted(held.items())
    assert [p.name for p in tmp_path.iterdir()] == ["landed"]


def test_a_document_of_nothing_is_empty(spark, tmp_path):
    path = fx.write_one_document(spark.createDataFrame([], "value string"), f"{tmp_path}/landed")
    assert read_description_document(spark, path).collect() == []


def test_a_store_with_one_writer_gets_one_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "open_store", lambda path: (None, path))
    fx.write_one_document(written_by_task(spark), f"{tmp_path}/landed")
    (file,) = (tmp_path / "landed").glob("part-*")
    assert len(json.loads(file.read_text())) == 40
