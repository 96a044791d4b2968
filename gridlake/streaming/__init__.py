"""Structured Streaming: incremental file ingest and streaming latest-wins."""

from gridlake.streaming.evolving import ingest_evolving_csv, ingest_evolving_json, read_evolved
from gridlake.streaming.ingest import discover_files, ingest_drifting_csv, ingest_stream, run_until_drained
from gridlake.streaming.latest import latest_incremental, latest_stream_state, lateness_report, upsert_latest

__all__ = [
    "discover_files",
    "ingest_drifting_csv",
    "ingest_evolving_csv",
    "ingest_evolving_json",
    "ingest_stream",
    "latest_incremental",
    "latest_stream_state",
    "lateness_report",
    "read_evolved",
    "run_until_drained",
    "upsert_latest",
]
