"""Rule-based quarantine (L-03): every row lands in exactly one of good / bad.

A rule is a *validity* predicate. A row fails a rule when the predicate is
false **or NULL**; the failed rule names are kept in an array column, so the
quarantine is auditable and ``good + bad == input`` always holds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "_dq_reasons"
QUARANTINED = "_quarantined"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported when ``check`` is false; ``when_null`` (or ``name``) when it is NULL.

    ``check`` is a SQL predicate string, a ``Column``, or a zero-argument
    callable returning one (so rules can be declared at import time, before a
    session exists).
    """

    name: str
    check: Column | str | Callable[[], Column]
    when_null: str | None = None

    def predicate(self) -> Column:
        if isinstance(self.check, str):
            return F.expr(self.check)
        if isinstance(self.check, Column):
            return self.check
        return self.check()


def _as_rules(rules: Sequence[Rule] | Mapping[str, Column | str]) -> list[Rule]:
    if isinstance(rules, Mapping):
        return [Rule(n, c) for n, c in rules.items()]
    return list(rules)


def reasons_column(rules: Sequence[Rule] | Mapping[str, Column | str]) -> Column:
    """``array<string>`` of failed rule names (empty when the row is valid)."""
    parts = []
    for r in _as_rules(rules):
        p = r.predicate()
        parts.append(
            F.when(p.isNull(), F.lit(r.when_null or r.name)).when(~p, F.lit(r.name))
        )
    if not parts:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*parts))


def flag(
    df: DataFrame,
    rules: Sequence[Rule] | Mapping[str, Column | str],
    reasons_col: str = REASONS,
    flag_col: str = QUARANTINED,
) -> DataFrame:
    """Add the reasons array and a boolean ``_quarantined`` flag (one evaluation per row)."""
    return df.withColumn(reasons_col, reasons_column(rules)).withColumn(flag_col, F.size(reasons_col) > 0)


def split(flagged: DataFrame, flag_col: str = QUARANTINED) -> tuple[DataFrame, DataFrame]:
    """(good, bad) views of a flagged frame; the flag is total so nothing falls between."""
    good = flagged.filter(~F.col(flag_col)).drop(flag_col, REASONS)
    bad = flagged.filter(F.col(flag_col)).drop(flag_col)
    return good, bad


def quarantine(
    df: DataFrame,
    rules: Sequence[Rule] | Mapping[str, Column | str],
) -> tuple[DataFrame, DataFrame]:
    """Convenience: ``split(flag(df, rules))``.

    To materialise both sides, prefer :func:`gridlake.sinks.route_write`, which
    writes the flagged frame once, partitioned by the flag, instead of running
    the upstream (dedup shuffle included) twice or caching it in executors
    that may be lost.
    """
    return split(flag(df, rules))
