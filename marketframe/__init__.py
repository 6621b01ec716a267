"""Daily asset-price data on Spark: landed JSON to gated, merged tables and monitoring views."""

from marketframe.session import get_spark, scratch_dir
from marketframe.sources import Lake

__all__ = ["Lake", "get_spark", "scratch_dir"]
