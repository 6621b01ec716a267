"""Curated files between transform and load: parquet by default, CSV with loss-free options."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark's CSV defaults turn empty text into NULL, trim padding, split rows at line breaks, and cut
# microseconds.
_CSV = {
    "header": "true",
    "escape": '"',
    "nullValue": r"\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_CSV_WRITE = {**_CSV, "quoteAll": "true"}
_CSV_READ = {**_CSV, "multiLine": "true", "enforceSchema": "false", "mode": "FAILFAST"}


def write_curated(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrite ``path``. Give each job and run its own path: an overwrite is not shareable."""
    options = _CSV_WRITE if fmt == "csv" else {}
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def read_curated(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    options = _CSV_READ if fmt == "csv" else {}
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_valid(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The good rows of a gated dataset; none if the gate let nothing through."""
    if fmt == "csv":
        return read_curated(spark, f"{path}/rows", schema, fmt)
    split = T.StructType([*schema.fields, T.StructField("valid", T.BooleanType())])
    return read_curated(spark, path, split).filter("valid").select(*schema.names)
