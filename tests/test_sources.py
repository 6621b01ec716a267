import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas, scratch_dir
from marketframe.operators import clean_snapshot
from marketframe.sources import (
    Lake,
    RunLog,
    append_runs,
    flatten_history,
    jdbc_properties,
    merge_partitions,
    read_coin_details,
    read_coin_list,
    read_curated,
    read_descriptions,
    read_history,
    read_malformed,
    read_market,
    read_runs,
    read_table,
    read_valid,
    write_curated,
    write_staging,
)
from marketframe.sources.lease import TableBusyError, _HadoopFile, lease


@pytest.fixture
def land(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
        return str(path)

    return write


def test_arrays_of_objects(spark, land):
    coins = read_coin_list(spark, land("c", [{"id": "a", "symbol": "A", "name": "Aa", "more": 1}]))
    assert [tuple(r) for r in coins.collect()] == [("a", "A", "Aa")]
    market = read_market(spark, land("m", [{"id": "a", "current_price": 1, "market_cap": None}]))
    assert [tuple(r) for r in market.collect()] == [("a", "1", None, None)]
    assert read_coin_list(spark, land("empty", [])).count() == 0


def test_json_lines(spark, land):
    lines = '{"id": "a", "current_price": 1.5}\n{"id": "b", "current_price": 2.5}\n'
    assert read_market(spark, land("l", lines), multi_line=False).count() == 2


def test_malformed_document_fails(spark, land):
    with pytest.raises(Exception):
        read_market(spark, land("bad", '[{"id": "a", "current_price": ')).collect()
    with pytest.raises(Exception):
        read_history(spark, land("badh", '{"a": {"prices": [[1,')).collect()


def test_history(spark, land):
    document = {
        "a": {"prices": [[1, 1], [2, 2.5], [3, None], [4]], "market_caps": [[1, 9]]},
        "none": {},
        "empty": {"prices": []},
    }
    rows = [tuple(r) for r in read_history(spark, land("h", document)).collect()]
    assert rows == [("a", 1, 1.0), ("a", 2, 2.5), ("a", 3, None), ("a", 4, None)]


def test_history_with_an_unusable_timestamp(spark):
    texts = spark.createDataFrame([('{"a": {"prices": [["NaN", 1.0], [null, 2.0]]}}',)], "value string")
    assert [r.timestamp_ms for r in flatten_history(texts).collect()] == [None, None]


def test_descriptions(spark, land):
    rows = read_descriptions(spark, land("d", {"a": "x", "b": "", "c": None})).collect()
    assert [tuple(r) for r in rows] == [("a", "x"), ("b", ""), ("c", None)]


def test_coin_details(spark, land):
    details = [{"id": "a", "description": {"de": "x", "en": "  y\n"}}, {"id": "b", "description": {}},
               {"id": "c"}]
    rows = read_coin_details(spark, land("details", details)).collect()
    assert [tuple(r) for r in rows] == [("a", "y"), ("b", ""), ("c", "")]


TRICKY = ["", None, "  padded ", "line\nbreak", "cr\r\nlf", 'quo"te', "back\\slash", "comma,", "\\\"", "ü"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_curated_round_trip(spark, tmp_path, fmt):
    rows = [(f"c{i}", text, text, datetime(2024, 1, 1, 1, 2, 3, i)) for i, text in enumerate(TRICKY)]
    frame = spark.createDataFrame(rows, schemas.CURATED_DIM)
    path = write_curated(frame, str(tmp_path / "out"), fmt)
    back = read_curated(spark, path, schemas.CURATED_DIM, fmt)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    write_curated(frame.limit(1), path, fmt)
    assert read_curated(spark, path, schemas.CURATED_DIM, fmt).count() == 1


def test_csv_header_is_checked(spark, tmp_path):
    path = write_curated(spark.createDataFrame([("a", "b")], "x string, y string"), f"{tmp_path}/o", "csv")
    other = spark.createDataFrame([], "y string, x string").schema
    with pytest.raises(Exception):
        read_curated(spark, path, other, "csv").collect()


def test_read_valid_of_a_gate_without_survivors(spark, tmp_path):
    frame = spark.createDataFrame([("a", False)], "coin_id string, valid boolean")
    frame.write.partitionBy("valid").parquet(str(tmp_path / "g"))
    schema = frame.select("coin_id").schema
    assert read_valid(spark, str(tmp_path / "g"), schema).collect() == []


P = "coin_id string, p int"


@pytest.fixture
def small_table(spark, tmp_path):
    """A table of one column, partitioned by p: its reader and a merge that appends."""
    path, schema = str(tmp_path / "t"), T.StructType([T.StructField("coin_id", T.StringType())])

    def read():
        return read_table(spark, path, schema, "p", T.IntegerType())

    def merge(rows, touched, how=lambda old, new: old.unionByName(new), wait=20):
        merge_partitions(read, spark.createDataFrame(rows, P), path, "p", touched, how, wait)

    return path, read, merge


def files_by_partition(path):
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in Path(path).glob("p=*")}


def test_only_touched_partitions_are_rewritten(spark, small_table):
    path, read, merge = small_table
    merge([("a", 1), ("b", 2)], [1, 2])
    first = files_by_partition(path)
    merge([("c", 1), ("d", 3)], [1, 3])
    after = files_by_partition(path)
    assert sorted(map(tuple, read().collect())) == [("a", 1), ("b", 2), ("c", 1), ("d", 3)]
    assert after["p=2"] == first["p=2"] and not after["p=1"] & first["p=1"]
    assert not [p.name for p in Path(path).iterdir() if p.name.startswith((".spark", "_lease"))]


def test_a_failed_merge_frees_the_table(spark, small_table):
    path, read, merge = small_table
    merge([("a", 1)], [1])
    first = files_by_partition(path)
    with pytest.raises(Exception, match="broken"):
        merge([("b", 1)], [1], lambda old, new: new.withColumn(
            "coin_id", F.raise_error(F.lit("broken")).cast("string")))
    assert files_by_partition(path) == first
    merge([("c", 1)], [1])
    assert sorted(r.coin_id for r in read().collect()) == ["a", "c"]


def test_a_second_writer_waits_or_fails(spark, small_table):
    path, read, merge = small_table
    merge([("a", 1)], [1])
    with ThreadPoolExecutor(1) as pool:
        with lease(spark, path, "other run", 0):
            with pytest.raises(TableBusyError, match="other run"):
                merge([("b", 1)], [1], wait=0)
            late = pool.submit(merge, [("c", 1)], [1])
            assert sorted(r.coin_id for r in read().collect()) == ["a"]
        late.result()
    assert sorted(r.coin_id for r in read().collect()) == ["a", "c"]


def test_many_writers_lose_nothing(spark, small_table):
    path, read, merge = small_table
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: merge([(str(n), n % 2)], [n % 2]), range(8)))
    assert sorted(r.coin_id for r in read().collect()) == sorted(map(str, range(8)))


def test_a_lease_on_a_store_that_hadoop_reaches(spark, tmp_path):
    place = f"file:{tmp_path}/t/_lease"
    one, two = _HadoopFile(spark, place), _HadoopFile(spark, place)
    assert one.create("me") and not two.create("you")
    assert two.read() == "me"
    one.remove()
    assert two.create("you")


def test_absent_table_reads_as_empty(spark, tmp_path):
    lake = Lake(str(tmp_path / "none"))
    assert lake.read_fact(spark).collect() == [] and lake.read_dim(spark).collect() == []
    assert lake.read_fact(spark).columns[-1] == "price_month"
    assert schemas.DIM.names[-1] == "description"


def test_table_from_before_the_description_column(spark, tmp_path):
    lake = Lake(str(tmp_path))
    old = spark.createDataFrame([("a", "A", "Aa", datetime(2024, 1, 1), 3)],
                                "coin_id string, symbol string, name string, "
                                "loaded_at timestamp_ntz, coin_bucket int")
    merge_partitions(lambda: lake.read_dim(spark), old, lake.dim, "coin_bucket", [3],
                     lambda target, source: source)
    assert lake.read_dim(spark).first().description is None


def test_absent_log_reads_as_empty(spark, tmp_path):
    assert read_runs(spark, str(tmp_path / "none")).collect() == []


def test_numbers_as_text_in_the_market_file(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('[{"id": "a", "current_price": "1.5", "market_cap": 2e3, "total_volume": "x"}]')
    row = clean_snapshot(read_market(spark, str(path)), "2024-01-31").first()
    assert (row.price_usd, row.market_cap_usd, row.volume_24h_usd) == (1.5, 2000.0, None)


def test_malformed_documents_are_kept(spark, tmp_path):
    path = tmp_path / "h"
    path.write_text('{"a": {"prices": [[1, 2]]}}\n{"b": \n')
    read = read_history(spark, str(path), multi_line=False, mode="PERMISSIVE")
    assert read.count() == 1
    kept = read_malformed(spark, str(path), schemas.HISTORY, multi_line=False)
    assert [r.value for r in kept.collect()] == ['{"b": ']


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_namespaces_differ_by_job_and_run():
    lake = Lake("/lake")
    paths = {lake.curated(j, r, "dim") for j in ("daily", "backfill") for r in ("1", "2")}
    assert len(paths) == 4


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), "r1", clock=lambda: datetime(2024, 1, 1))
    with log.stage("transformation") as stage:
        stage.rows_processed = 7
    with pytest.raises(KeyError):
        with log.stage("loading"):
            raise KeyError("gone")
    RunLog(spark, str(tmp_path / "log"), "r2").append("extraction", "running")
    rows = read_runs(spark, str(tmp_path / "log")).orderBy("stage").collect()
    assert [(r.stage, r.status, r.rows_processed, r.error_message) for r in rows] == [
        ("extraction", "running", None, None),
        ("loading", "failed", None, "'gone'"),
        ("transformation", "success", 7, None),
    ]
    assert rows[1].run_date == datetime(2024, 1, 1)


def test_run_log_domains_raise_and_write_errors_do_not(spark, tmp_path, caplog):
    log = RunLog(spark, str(tmp_path / "log"), "r1")
    with pytest.raises(ValueError, match="stage"):
        log.append("quality", "success")
    with pytest.raises(ValueError, match="status"):
        log.append("loading", "done")
    (tmp_path / "file").write_text("not a folder")
    RunLog(spark, str(tmp_path / "file"), "r1").append("loading", "success")
    assert "run log row not written" in caplog.text


def test_appends_add_up(spark, tmp_path):
    rows = spark.createDataFrame([], schemas.RUN_LOG)
    one = rows.unionByName(spark.sql("select timestamp_ntz'2024-01-01' run_date, 'loading' stage, "
                                     "'success' status, 1L rows_processed, '' error_message"))
    for namespace in ("a", "b", "a"):
        append_runs(one, str(tmp_path), namespace)
    assert read_runs(spark, str(tmp_path)).count() == 3


def test_runs_may_write_at_the_same_time(spark, tmp_path):
    """Each run has its own curated folder and log folder, so no overwrite meets another."""
    lake = Lake(str(tmp_path))

    def one_run(number):
        log = RunLog(spark, lake.run_log, f"run{number}")
        with log.stage("transformation") as stage:
            path = lake.curated("daily", f"run{number}", "dim_coins")
            write_curated(spark.range(number), path)
            stage.rows_processed = spark.read.parquet(path).count()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one_run, range(1, 9)))
    rows = read_runs(spark, lake.run_log).collect()
    assert sorted(r.rows_processed for r in rows) == list(range(1, 9))


def test_jdbc_options(spark):
    """No database is started here: the options, and that the write goes through JDBC at all."""
    properties = jdbc_properties("u", "p", "no.such.Driver", num_partitions=3, batch_size=50)
    assert properties["numPartitions"] == "3" and properties["batchsize"] == "50"
    with pytest.raises(Exception, match="no.such.Driver"):
        write_staging(spark.range(1), "jdbc:nothing:here", "staging_dim_coins", properties)


def test_scratch_follows_the_session(spark):
    # The setting is fixed when a session starts, so the test stands in for one that has it.
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/place/"})
    assert scratch_dir(cluster, "x").startswith("/shared/place/marketframe/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
