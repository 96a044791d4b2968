"""Deterministic defect injection for proofs.

The driver's tables are clean (no NULLs, no malformed codes), so proofs that
exercise quarantine, rescue and DQ metrics derive a "raw extract" from
``orders`` with defects placed by key. Every expression below is plain SQL
accepted by both Spark and DuckDB, so the oracle repeats it verbatim.
No row is dropped: defects only change values.
"""

# The injected-defect formulas (shared verbatim with the oracle SQL).
CODE_SQL = (
    "CASE o_orderkey % 50 WHEN 0 THEN NULL WHEN 1 THEN '99ZZZ' WHEN 2 THEN '' "
    "ELSE lpad(CAST(o_custkey AS STRING), 5, '0') END"
)
PRICE_SQL = "CASE WHEN o_orderkey % 70 = 0 THEN -o_totalprice WHEN o_orderkey % 70 = 1 THEN 0.0 ELSE o_totalprice END"
PRIORITY_SQL = "CASE WHEN o_orderkey % 30 = 0 THEN lower(o_orderpriority) || ' ' ELSE o_orderpriority END"

RAW_ORDERS_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_orderdate",
    f"{CODE_SQL} AS code",
    f"{PRICE_SQL} AS price",
    f"{PRIORITY_SQL} AS priority",
]
RAW_ORDERS_SELECT = ", ".join(RAW_ORDERS_COLUMNS)

# Validity of the injected columns, as SQL for the oracle (NULL/blank code ⇒ missing).
CODE_REASON_SQL = (
    "CASE WHEN code IS NULL OR trim(code) = '' THEN 'code_missing' "
    "WHEN NOT regexp_full_match(code, '[0-9]{5}') THEN 'code_format' END"
)
PRICE_REASON_SQL = "CASE WHEN price IS NULL OR NOT price > 0 THEN 'price' END"
