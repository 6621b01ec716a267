"""Helpers that several operators share."""

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.session import scratch_dir
from marketframe.sources.folders import remove

# White space as the contracts have it: space and the five ASCII controls from tab to return.
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = "[ \\t-\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spill(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: short lineage, and no lost work."""
    spark, path = df.sparkSession, f"{scratch_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a spilled table, once nothing that is still to run reads it."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        remove(df.sparkSession, folder)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which may run where it is not installed."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold at most ``most`` bytes, or one row."""
    sizes = [0 if v is None else v for v in pa.compute.binary_length(batch[column]).to_pylist()]
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def all_slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, most)
