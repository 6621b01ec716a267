"""JDBC staging table, for users who merge inside a database."""

from pyspark.sql import DataFrame


def jdbc_properties(
    user: str, password: str, driver: str, num_partitions: int = 8, batch_size: int = 10_000
) -> dict[str, str]:
    """``num_partitions`` is the number of connections held at once, ``batch_size`` rows a trip."""
    return {
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(num_partitions),
        "batchsize": str(batch_size),
    }


def write_staging(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Overwrite a staging table, one pass over ``df``."""
    df.write.mode("overwrite").jdbc(url=url, table=table, properties=properties)
