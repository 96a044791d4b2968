"""Registry of proof queries: each pairs a Spark plan with its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Proof:
    name: str
    fn: QueryFn
    sql: str | None  # None → rows-only check (not SQL-expressible)
    ids: tuple[str, ...]  # SURVEY §2 inventory ids covered


REGISTRY: dict[str, Proof] = {}


def proof(name: str, sql: str | None, ids: tuple[str, ...] = ()) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate proof {name}")
        REGISTRY[name] = Proof(name, fn, sql, ids)
        return fn

    return deco


def load_all() -> dict[str, Proof]:
    # Importing the modules fills REGISTRY.
    from gridlake.plans import proofs_evolution, proofs_ingest, proofs_layout, proofs_relational, proofs_serving, proofs_skew, proofs_streaming  # noqa: F401

    return REGISTRY
