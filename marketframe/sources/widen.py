"""Tables whose older files have narrower types.

A column may have become wider since files were written: every value of the old type must have an equal
value in the new one. Such files are read as the wide type; a column that older files lack is NULL there. Any
other change is refused before a row is read.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits that hold every value of a whole-number type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_WHOLE = list(_DIGITS)


class TypeChangeError(TypeError):
    """A stored type that cannot be read as the wanted one without changing values."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` has its equal in ``new``."""
    if old == new:
        return True
    if type(old) in _DIGITS:
        if type(new) in _DIGITS:
            return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= _DIGITS[type(old)]
        # A double holds whole numbers of 53 bits, a float of 24.
        return isinstance(new, T.DoubleType) and not isinstance(old, T.LongType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        wider = new.precision - new.scale >= old.precision - old.scale
        return wider and new.scale >= old.scale
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    return isinstance(old, T.DateType) and isinstance(new, T.TimestampNTZType)


def _stored(spark: SparkSession, path: str) -> T.StructType:
    """The schema of all files of a generation; footers are read by tasks, not by the driver."""
    return spark.read.option("mergeSchema", True).parquet(path).schema


def read_generations(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The files at ``paths``, written at different times, as one table of ``schema``.

    Raises ``TypeChangeError`` that names the path, the column and both types if a stored type does not widen to the
    wanted one. Columns that ``schema`` does not name are not read.
    """
    frames = []
    for path in paths:
        stored = {field.name: field.dataType for field in _stored(spark, path)}
        for field in schema:
            old = stored.get(field.name, field.dataType)
            if not widens(old, field.dataType):
                raise TypeChangeError(
                    f"{path}: {field.name} is {old.simpleString()}, "
                    f"which does not widen to {field.dataType.simpleString()}"
                )
        own = T.StructType([T.StructField(f.name, stored[f.name]) for f in schema if f.name in stored])
        rows = spark.read.schema(own).parquet(path)
        frames.append(
            rows.select(
                *[
                    (F.col(f.name) if f.name in stored else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in schema
                ]
            )
        )
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
