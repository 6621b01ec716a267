from marketframe.sources.curated import read_curated, read_valid, write_curated
from marketframe.sources.database import jdbc_properties, write_staging
from marketframe.sources.documents import read_description_document, read_history_document
from marketframe.sources.landed import (
    malformed_documents,
    read_malformed,
    flatten_descriptions,
    flatten_history,
    read_coin_details,
    read_coin_list,
    read_descriptions,
    read_history,
    read_market,
)
from marketframe.sources.lake import Lake, merge_partitions, read_table
from marketframe.sources.lease import TableBusyError
from marketframe.sources.runlog import RunLog, append_runs, compact_runs, read_health, read_runs
from marketframe.sources.widen import TypeChangeError, read_generations

__all__ = [
    "malformed_documents",
    "read_malformed",
    "Lake",
    "RunLog",
    "append_runs",
    "compact_runs",
    "flatten_descriptions",
    "flatten_history",
    "jdbc_properties",
    "TableBusyError",
    "TypeChangeError",
    "merge_partitions",
    "read_coin_details",
    "read_coin_list",
    "read_curated",
    "read_description_document",
    "read_descriptions",
    "read_generations",
    "read_health",
    "read_history",
    "read_history_document",
    "read_market",
    "read_runs",
    "read_table",
    "read_valid",
    "write_curated",
    "write_staging",
]
