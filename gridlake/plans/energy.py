"""The energy lakehouse (G-01 … G-11) as one configuration of the gridlake operators.

Landing layout (``FIXTURES.md`` §1)::

    eco2mix/archive/{year}/*.csv          ; separated, ISO instants with +01:00
    eco2mix/api/{pull}/pull.json          one envelope per pull
    dpe/weekly/{yyyy}-W{ww}/*.csv         weekly extracts, header drifts
    enedis/annual/{year}/*.csv
    meteo/daily/{date}/{region}.json      parallel hourly arrays
    insee/communes_reference.parquet

``run(spark, landing, warehouse)`` builds every layer; each step is also a
function of DataFrames so it can be tested or reused on its own. Parity
switches reproduce the original behaviour where it differs (SURVEY §7.5).
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import contracts as C
from gridlake.operators.aggregates import coverage_report, dq_metrics, hot_keys, key_skew, reconcile
from gridlake.operators.layout import optimize, pruning_report, table_location, table_stats
from gridlake.operators.dedup import latest_per_key, repeated_keys
from gridlake.operators.flatten import flatten_envelope, flatten_parallel_arrays
from gridlake.operators.quarantine import Rule
from gridlake.plans.marts import SilverSpec, binned_join_mart, priority_mart, silver_flagged
from gridlake.sinks import publish, read_batches, route_write
from gridlake.sources.batch import read_csv, read_json, with_audit
from gridlake.streaming.ingest import MAX_FILES_PER_TRIGGER, ingest_drifting_csv, ingest_stream

# The classes counted as "passoires" and the minimum dwellings per commune.
POOR_CLASSES = ("F", "G")
MIN_DWELLINGS = 20
GRID_TZ = "+01:00"


@dataclass(frozen=True)
class Paths:
    landing: str
    warehouse: str

    def land(self, sub: str) -> str:
        return f"{self.landing.rstrip('/')}/{sub}"

    def wh(self, sub: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{sub}"


# --------------------------------------------------------------------------- bronze


def bronze_grid_archive(spark: SparkSession, p: Paths) -> DataFrame:
    """G-01: archive CSV (``;``) stream → bronze, with ingestion time and source file."""
    ingest_stream(spark, p.land("eco2mix/archive"), p.wh("bronze/eco2mix_raw"), p.wh("_checkpoints/eco2mix_archive"), "csv", C.GRID_RECORD, {"sep": ";", "header": "true"}, glob="*.csv")
    return spark.read.parquet(p.wh("bronze/eco2mix_raw"))


def _explode_pull(df: DataFrame) -> DataFrame:
    return flatten_envelope(df, "records", keep=["pull_timestamp", "_ingested_at", "_source_file"])


def bronze_grid_api(spark: SparkSession, p: Paths) -> DataFrame:
    """G-02: API pulls (one JSON envelope per file) stream → one row per record."""
    ingest_stream(
        spark, p.land("eco2mix/api"), p.wh("bronze/eco2mix_api_raw"), p.wh("_checkpoints/eco2mix_api"), "json", C.GRID_API.schema, {"multiLine": "true"}, transform=_explode_pull, glob="*.json"
    )
    return spark.read.parquet(p.wh("bronze/eco2mix_api_raw"))


def bronze_housing(spark: SparkSession, p: Paths, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """G-03: weekly extracts with header drift and rescue → bronze (+ ``_extract_week``)."""
    ingest_drifting_csv(
        spark,
        p.land("dpe/weekly"),
        p.wh("bronze/dpe_raw"),
        p.wh("_checkpoints/dpe"),
        C.HOUSING.schema,
        p.wh("_checkpoints/dpe_schema"),
        max_files_per_trigger=max_files_per_trigger,
    )
    return read_batches(spark, p.wh("bronze/dpe_raw"))


def housing_dq_metrics(bronze: DataFrame, parity: bool = False) -> DataFrame:
    """G-03 metrics per extract week: rows, duplicates/re-diagnoses, negative surfaces, bad codes, rescued.

    ``parity=True`` keeps the original counting (NULL instead of 0, a blank
    code counted nowhere); the default counts blanks as bad codes.
    """
    code_rule = (
        Rule("bad_commune", "code_commune RLIKE '^[0-9]{5}$'")
        if parity
        else Rule("bad_commune", "CASE WHEN trim(code_commune) <> '' THEN code_commune RLIKE '^[0-9]{5}$' END")
    )
    rules = [Rule("neg_surface", "NOT (surface_habitable < 0)" if parity else "coalesce(surface_habitable >= 0, true)"), code_rule]
    if parity:
        # NULL predicates were not counted originally: only definite violations count.
        rules = [Rule(r.name, f"coalesce({r.check}, true)") for r in rules]
    return dq_metrics(bronze, ["_extract_week"], key="numero_dpe", rules=rules, rescued_col="_rescued_data", null_when_zero=parity, rows_col="rows")


def bronze_consumption(spark: SparkSession, p: Paths) -> DataFrame:
    """G-04: annual CSV tree, declared types (codes stay strings), ingestion time."""
    return with_audit(read_csv(spark, p.land("enedis/annual"), C.CONSUMPTION.schema, glob="*.csv"))


# --------------------------------------------------------------------------- silver


def silver_weather(spark: SparkSession, p: Paths) -> DataFrame:
    """G-05: daily JSON documents → one row per region and hour (parallel arrays zipped)."""
    raw = read_json(spark, p.land("meteo/daily"), C.WEATHER_RAW.schema, multiline=True, glob="*.json", provenance=False)
    return flatten_parallel_arrays(raw, ["hourly.time", "hourly.temperature_2m"], keep=["region_code", "region_name", "date"], names=["heure", "temperature"])


def silver_communes(spark: SparkSession, p: Paths) -> DataFrame:
    """G-05: commune reference (Parquet)."""
    return spark.read.parquet(p.land("insee/communes_reference.parquet"))


def silver_grid(api_bronze: DataFrame) -> DataFrame:
    """G-06: latest pull wins per (instant, region); ties broken by the remaining columns."""
    return latest_per_key(api_bronze, ["date_heure", "libelle_region"], ["pull_timestamp"])


def silver_grid_incremental(spark: SparkSession, p: Paths, max_files_per_trigger: int | None = None) -> DataFrame:
    """T-01 form of G-06: each micro-batch of API pulls is merged into silver, rewriting only
    the days (of the grid instant) it touches. Equals :func:`silver_grid` over all pulls."""
    from gridlake.streaming.latest import latest_incremental

    r = spark.readStream.format("json").schema(C.GRID_API.schema).option("multiLine", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    pulls = _explode_pull(with_audit(r.option("pathGlobFilter", "*.json").load(p.land("eco2mix/api"))))
    keyed = pulls.withColumn("day", F.substring("date_heure", 1, 10))  # local calendar day of the instant
    latest_incremental(keyed, p.wh("silver/eco2mix_incremental"), p.wh("_checkpoints/eco2mix_incremental"), ["date_heure", "libelle_region"], ["pull_timestamp"], None, "day")
    return spark.read.parquet(p.wh("silver/eco2mix_incremental"))


HOUSING_SPEC = SilverSpec(C.HOUSING.keys, C.HOUSING.order_by, None, C.HOUSING.enums, list(C.HOUSING.rules))


def silver_housing_flagged(bronze: DataFrame) -> DataFrame:
    """G-07: newest diagnosis per dwelling → class normalised → quarantine flags."""
    return silver_flagged(bronze, HOUSING_SPEC)


# --------------------------------------------------------------------------- gold


def gold_renovation_priority(dpe_clean: DataFrame, communes: DataFrame, allow_fanout: bool = False) -> DataFrame:
    """G-08: per commune, dwellings, mean kWh/m², % of class F/G; ≥ 20 dwellings.

    The commune reference must be unique on its code (it is not in the
    original generator's data — codes collide); ``allow_fanout=True`` keeps the
    original join that multiplies dwellings by colliding communes.
    """
    return priority_mart(
        dpe_clean.select("numero_dpe", "code_commune", "conso_kwh_m2_an", "classe_dpe"),
        communes.select("code_commune", "nom_commune", "population"),
        ["code_commune"],
        ["code_commune", "nom_commune", "population"],
        id_col="numero_dpe",
        measure="conso_kwh_m2_an",
        class_predicate=F.col("classe_dpe").isin(*POOR_CLASSES),
        min_support=MIN_DWELLINGS,
        names=("nb_logements", "conso_moyenne", "pct_passoires"),
        allow_fanout=allow_fanout,
    )


def gold_conso_vs_temperature(archive: DataFrame, weather: DataFrame, source_tz: str | None = GRID_TZ) -> DataFrame:
    """G-09: archive quarter-hours ⋈ hourly weather on region + hour; per region and rounded °C,
    the number of matched quarter-hours (``nb_heures``) and mean consumption.

    Archive instants carry their offset; weather hours are naive local times in
    ``source_tz``. ``source_tz=None`` reads them as UTC wall clocks — what the
    original string-formatting join does in a UTC session, pairing the archive's
    00:00+01:00 with the 23:00 weather hour.
    """
    fine = archive.select("libelle_region", "date_heure", "consommation")
    coarse = weather.select("region_name", "heure", "temperature")
    return binned_join_mart(
        fine,
        coarse,
        ["libelle_region"],
        ["region_name"],
        "date_heure",
        "heure",
        F.round("temperature"),
        "consommation",
        unit="hour",
        fine_tz=None,
        coarse_tz=source_tz,
        names=("temp_arrondie", "nb_heures", "conso_moyenne_mw"),
        digits=0,
    ).withColumnRenamed("libelle_region", "region_name")


def source_coverage(archive: DataFrame, api: DataFrame) -> DataFrame:
    """G-11: rows and first/last instant per grid source (instants parsed with their offset)."""
    conv = lambda df: df.select(F.convert_timezone(None, F.lit(GRID_TZ), F.to_timestamp("date_heure")).alias("date_heure"))
    return coverage_report({"archive": conv(archive), "api": conv(api)}, "date_heure")


def skew_report(dpe_clean: DataFrame) -> DataFrame:
    """Rows-per-commune skew of silver housing (M-06)."""
    return key_skew(dpe_clean, ["code_commune"], digits=1)


# --------------------------------------------------------------------------- orchestration


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    allow_fanout: bool = False,
    incremental_grid: bool = False,
) -> dict[str, str]:
    """Build bronze → silver → gold; returns table name → version path.

    Every table is published as a new version (readers never see a half
    rewrite); silver good/quarantine come from one routed write.
    ``incremental_grid`` maintains the silver grid by partition upserts per
    micro-batch of pulls (T-01) instead of a full latest-wins pass.
    """
    p = Paths(landing, warehouse)
    out: dict[str, str] = {}
    archive = bronze_grid_archive(spark, p)
    api = bronze_grid_api(spark, p)
    housing = bronze_housing(spark, p)
    out["bronze.dpe_dq_metrics"] = publish(housing_dq_metrics(housing), "bronze.dpe_dq_metrics", p.wh("tables"))
    out["bronze.enedis_raw"] = publish(bronze_consumption(spark, p), "bronze.enedis_raw", p.wh("tables"))
    out["silver.meteo_clean"] = publish(silver_weather(spark, p), "silver.meteo_clean", p.wh("tables"))
    out["silver.communes"] = publish(silver_communes(spark, p), "silver.communes", p.wh("tables"))
    grid = silver_grid_incremental(spark, p).drop("day") if incremental_grid else silver_grid(api)
    out["silver.eco2mix_clean"] = publish(grid, "silver.eco2mix_clean", p.wh("tables"))
    good, bad = route_write(silver_housing_flagged(housing), p.wh("silver/dpe"))
    out["silver.dpe_clean"] = publish(good, "silver.dpe_clean", p.wh("tables"))
    out["silver.dpe_quarantine"] = publish(bad, "silver.dpe_quarantine", p.wh("tables"))
    communes = spark.table("silver.communes")
    out["gold.renovation_priority"] = publish(
        gold_renovation_priority(spark.table("silver.dpe_clean"), communes, allow_fanout), "gold.renovation_priority", p.wh("tables")
    )
    out["gold.conso_vs_temperature"] = publish(
        gold_conso_vs_temperature(archive, spark.table("silver.meteo_clean")), "gold.conso_vs_temperature", p.wh("tables")
    )
    return out


def report(spark: SparkSession, landing: str, warehouse: str) -> dict[str, DataFrame]:
    """Serving reads and diagnostics over the built layers (G-10, G-11, L-02, L-06, M-01, M-06, M-07)."""
    p = Paths(landing, warehouse)
    archive = spark.read.parquet(p.wh("bronze/eco2mix_raw"))
    api = spark.read.parquet(p.wh("bronze/eco2mix_api_raw"))
    bronze = read_batches(spark, p.wh("bronze/dpe_raw"))
    clean, quarantine = spark.table("silver.dpe_clean"), spark.table("silver.dpe_quarantine")
    return {
        "top_priority": spark.table("gold.renovation_priority").orderBy(F.col("pct_passoires").desc(), "code_commune").limit(20),
        "one_region_curve": spark.table("gold.conso_vs_temperature").filter(F.col("region_name") == "Bretagne").orderBy("temp_arrondie"),
        "repeated_pulls": repeated_keys(api, ["date_heure", "libelle_region"], 2, 10, "times_received"),
        "repeated_dwellings": repeated_keys(bronze, ["numero_dpe"], 2, 10, "nb_versions"),
        "layers": reconcile(bronze, clean, quarantine, ["numero_dpe"]),
        "coverage": source_coverage(archive, api),
        "skew": skew_report(clean),
        "hot_communes": hot_keys(clean, ["code_commune"], 3),
        "table_stats": table_stats(spark, {"bronze.dpe_raw": p.wh("bronze/dpe_raw"), "bronze.eco2mix_raw": p.wh("bronze/eco2mix_raw")}),
    }


def optimization_report(spark: SparkSession, warehouse: str, target_bytes: int = 128 * 1024 * 1024) -> dict[str, DataFrame]:
    """The optimisation notebook as jobs: file stats, then compaction of the weather table and
    clustering of silver housing by commune, with the files a top-3-commune predicate must
    open before and after (deterministic instead of wall-clock timings), and the skew."""
    p = Paths("", warehouse)
    names = ["silver.dpe_clean", "silver.meteo_clean", "silver.communes", "gold.renovation_priority"]
    before = {n: table_location(spark, n) for n in names}
    stats_before = table_stats(spark, before)
    top = hot_keys(spark.table("silver.dpe_clean"), ["code_commune"], 3).select("code_commune")
    optimize(spark, "silver.meteo_clean", p.wh("tables"), None, target_bytes)
    optimize(spark, "silver.dpe_clean", p.wh("tables"), ["code_commune"], target_bytes)
    after = {n: table_location(spark, n) for n in names}
    return {
        "stats_before": stats_before,
        "stats_after": table_stats(spark, after),
        "pruning": pruning_report(spark, {"no_zorder": before["silver.dpe_clean"], "zordered": after["silver.dpe_clean"]}, "code_commune", top),
        "skew": skew_report(spark.table("silver.dpe_clean")),
    }


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Build the energy lakehouse from a landing folder.")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--allow-fanout", action="store_true", help="join colliding commune codes as the original did")
    ap.add_argument("--incremental-grid", action="store_true", help="upsert the silver grid per micro-batch of pulls")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    for name, path in run(spark, a.landing, a.warehouse, a.allow_fanout, a.incremental_grid).items():
        print(name, path)


if __name__ == "__main__":
    main()
