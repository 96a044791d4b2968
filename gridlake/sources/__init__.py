"""Sources: batch readers, header-drift CSV, typed projection with rescue."""

from gridlake.sources.batch import (
    INGESTED_AT,
    SOURCE_FILE,
    preview_raw,
    read_csv,
    read_json,
    read_manifest,
    read_parquet,
    with_audit,
    with_provenance,
)
from gridlake.sources.drift import SchemaLog, added_columns, probe_headers, read_csv_drifting
from gridlake.sources.rescue import RESCUED, cast_with_rescue
from gridlake.sources.typing import TypeLog, join_types, narrowest_types

__all__ = [
    "INGESTED_AT",
    "RESCUED",
    "SOURCE_FILE",
    "SchemaLog",
    "TypeLog",
    "added_columns",
    "cast_with_rescue",
    "join_types",
    "narrowest_types",
    "preview_raw",
    "probe_headers",
    "read_csv",
    "read_csv_drifting",
    "read_json",
    "read_manifest",
    "read_parquet",
    "with_audit",
    "with_provenance",
]
