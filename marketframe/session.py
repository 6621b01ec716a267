"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of a write's tasks, and so of its files, before compression.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_spark(app_name: str = "marketframe", **conf: str) -> SparkSession:
    """A session with the recommended settings; master and sizing come from spark-submit.

    Keys in ``conf`` are full setting names. The shuffle partition count is left to the cluster:
    adaptive execution coalesces downwards from it, so set it for the largest shuffle expected.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster shares; a local session may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        return tempfile.mkdtemp(prefix=f"marketframe-{purpose}-")
    return f"{shared.rstrip('/')}/marketframe/{purpose}-{uuid.uuid4().hex}"
