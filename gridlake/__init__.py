"""gridlake — lakehouse data operators on Spark DataFrames.

Bronze → silver → gold building blocks (incremental ingest with drift and
rescue, latest-wins dedup, quarantine, DQ metrics, flattening, dimension and
time-bucket joins, marts, layout jobs, expectations), each parameterised by
column names and expressed with built-in Spark operators.
"""

__version__ = "0.1.0"
