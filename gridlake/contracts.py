"""Source contracts: declared schema, business key, ordering and validity rules.

Contract-first: identifiers are declared as strings (leading zeros survive),
keys and tie-breakers are explicit, rules are validity predicates whose NULL
counts as failure. The energy sources are one configuration; the driver's test
tables another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from gridlake.operators.quarantine import Rule

S, D, L, I, TS, NTZ, DT = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampType(),
    T.TimestampNTZType(),
    T.DateType(),
)


def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    keys: Sequence[str] = ()
    order_by: Sequence[str] = ()
    tie_breakers: Sequence[str] | None = None
    enums: Sequence[str] = ()
    rules: Sequence[Rule] = field(default_factory=tuple)
    event_time: str | None = None
    source_tz: str | None = None


# --- fixed values: the energy sources' column names, keys and rules --------------------------

GRID_RECORD = schema(
    ("date_heure", S),
    ("libelle_region", S),
    ("consommation", D),
    ("nucleaire", D),
    ("eolien", D),
    ("solaire", D),
    ("hydraulique", D),
    ("thermique", D),
    ("taux_co2", D),
)

GRID_API = Contract(
    "eco2mix_api",
    T.StructType([T.StructField("pull_timestamp", S), T.StructField("records", T.ArrayType(GRID_RECORD))]),
    keys=("date_heure", "libelle_region"),
    order_by=("pull_timestamp",),
    event_time="date_heure",
    source_tz="+01:00",
)

GRID_ARCHIVE = Contract("eco2mix_archive", GRID_RECORD, keys=("date_heure", "libelle_region"), event_time="date_heure", source_tz="+01:00")

HOUSING = Contract(
    "dpe",
    schema(
        ("numero_dpe", S),
        ("date_etablissement", DT),
        ("code_commune", S),
        ("type_batiment", S),
        ("annee_construction", S),
        ("surface_habitable", D),
        ("classe_dpe", S),
        ("conso_kwh_m2_an", D),
    ),
    keys=("numero_dpe",),
    order_by=("date_etablissement",),
    enums=("classe_dpe",),
    rules=(
        Rule(
            "code_format",
            "CASE WHEN trim(code_commune) <> '' THEN code_commune RLIKE '^[0-9]{5}$' END",
            when_null="code_missing",
        ),
        Rule("surface", "surface_habitable > 0"),
    ),
)

CONSUMPTION = Contract(
    "enedis",
    schema(("annee", I), ("code_commune", S), ("secteur", S), ("nb_sites", I), ("conso_totale_mwh", D)),
    keys=("annee", "code_commune", "secteur"),
)

WEATHER_RAW = Contract(
    "meteo",
    T.StructType(
        [
            T.StructField("region_code", S),
            T.StructField("region_name", S),
            T.StructField("date", S),
            T.StructField(
                "hourly",
                T.StructType([T.StructField("time", T.ArrayType(S)), T.StructField("temperature_2m", T.ArrayType(D))]),
            ),
        ]
    ),
    keys=("region_code", "date"),
)

COMMUNES = Contract(
    "communes",
    schema(("code_commune", S), ("nom_commune", S), ("code_region", S), ("population", L), ("revenu_median", L)),
    keys=("code_commune",),
)


# --- the driver's test tables ----------------------------------------------------------------

ORDERS = Contract(
    "orders",
    schema(
        ("o_orderkey", L),
        ("o_custkey", L),
        ("o_orderstatus", S),
        ("o_totalprice", D),
        ("o_orderdate", NTZ),
        ("o_orderpriority", S),
    ),
    keys=("o_custkey",),
    order_by=("o_orderdate",),
    tie_breakers=("o_orderkey",),
)

ORDERS_V1 = schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D), ("o_orderdate", NTZ))

EVENTS = Contract(
    "events",
    schema(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
    keys=("user_id", "event_type"),
    order_by=("ts",),
    tie_breakers=("event_id",),
    event_time="ts",
)

EVENT_RECORD = schema(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S), ("value", D))
EVENT_ENVELOPE = T.StructType(
    [T.StructField("day", DT), T.StructField("block", L), T.StructField("pull_ts", NTZ), T.StructField("records", T.ArrayType(EVENT_RECORD))]
)
