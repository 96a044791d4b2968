"""The energy configuration end to end on a hand-written landing tree (FIXTURES.md §1)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gridlake.plans import energy
from tests.conftest import write_text

HDR_V1 = "numero_dpe,date_etablissement,code_commune,type_batiment,annee_construction,surface_habitable,classe_dpe,conso_kwh_m2_an"


def build_landing(spark, root: str) -> None:
    # Grid archive: 8 quarter-hours of one region, two hours.
    rows = ["date_heure;libelle_region;consommation;nucleaire;eolien;solaire;hydraulique;thermique;taux_co2"]
    for i, c in enumerate([100, 110, 120, 130, 200, 210, 220, 230]):
        h, m = divmod(i * 15, 60)
        rows.append(f"2023-01-01T{h:02d}:{m:02d}:00+01:00;Bretagne;{c}.0;0.0;0.0;0.0;0.0;0.0;10.0")
    write_text(f"{root}/eco2mix/archive/2023/eco2mix_Bretagne_2023.csv", "\n".join(rows) + "\n")

    # Grid API: two pulls; the second revises one point; a third is empty.
    def rec(ts, c):
        return {"date_heure": ts, "libelle_region": "Bretagne", "consommation": c, "nucleaire": 0.0, "eolien": 0.0, "solaire": 0.0, "hydraulique": 0.0, "thermique": 0.0, "taux_co2": 10.0}

    pulls = {
        "2026-01-01T00-00": {"pull_timestamp": "2026-01-01T00:00", "records": [rec("2025-12-31T23:30:00+01:00", 1.0), rec("2025-12-31T23:45:00+01:00", 2.0)]},
        "2026-01-01T00-15": {"pull_timestamp": "2026-01-01T00:15", "records": [rec("2025-12-31T23:45:00+01:00", 2.5), rec("2026-01-01T00:00:00+01:00", 3.0)]},
        "2026-01-01T00-30": {"pull_timestamp": "2026-01-01T00:30", "records": []},
    }
    for folder, doc in pulls.items():
        write_text(f"{root}/eco2mix/api/{folder}/pull.json", json.dumps(doc, indent=2))

    # Housing: W47 (v1) with 20 dwellings in 35001 (5 of class F, one padded), 3 in 35002, defects;
    # W48 (v2, two new columns, other order) re-diagnoses D0 and adds a bad number.
    w47 = [HDR_V1]
    for i in range(20):
        cls = "f " if i == 0 else ("F" if i < 5 else "C")
        w47.append(f"D{i},2024-11-18,35001,Maison,1990,50.0,{cls},{100 + i}.0")
    for i in range(20, 23):
        w47.append(f"D{i},2024-11-18,35002,Maison,ANCIEN,40.0,G,300.0")
    w47.append("D90,2024-11-18,,Maison,1990,50.0,C,100.0")  # blank code
    w47.append("D91,2024-11-18,99ZZZ,Maison,1990,50.0,C,100.0")  # malformed
    w47.append("D92,2024-11-18,35001,Maison,1990,-5.0,C,100.0")  # negative surface
    w47.append("D93,2024-11-18,35001,Maison,1990,50.0,C,100.0")
    w47.append("D93,2024-11-18,35001,Maison,1990,50.0,C,100.0")  # exact duplicate
    write_text(f"{root}/dpe/weekly/2024-W47/dpe_extract.csv", "\n".join(w47) + "\n")
    w48 = [
        "etiquette_ges,numero_dpe,date_etablissement,code_commune,type_batiment,annee_construction,surface_habitable,classe_dpe,conso_kwh_m2_an,cout_chauffage",
        "B,D0,2024-11-25,35001,Maison,1990,50.0,C,90.0,800.5",
        "C,D50,2024-11-25,35002,Maison,1990,abc,C,90.0,700.0",
    ]
    write_text(f"{root}/dpe/weekly/2024-W48/dpe_extract.csv", "\n".join(w48) + "\n")

    write_text(
        f"{root}/enedis/annual/2023/conso_communes_2023.csv",
        "annee,code_commune,secteur,nb_sites,conso_totale_mwh\n2023,01234,RESIDENTIEL,10,55.5\n2023,35001,TERTIAIRE,3,12.0\n",
    )

    times = [f"2023-01-01T{h:02d}:00" for h in range(24)]
    temps = [7.4, 8.6] + [5.0] * 22
    doc = {"region_code": "53", "region_name": "Bretagne", "date": "2023-01-01", "hourly": {"time": times, "temperature_2m": temps}}
    write_text(f"{root}/meteo/daily/2023-01-01/53.json", json.dumps(doc, indent=2))

    communes = spark.createDataFrame(
        [("35001", "Rennes", "53", 220000, 23000), ("35002", "Brest", "53", 140000, 21000)],
        "code_commune string, nom_commune string, code_region string, population long, revenu_median long",
    )
    communes.coalesce(1).write.parquet(f"{root}/insee/communes_reference.parquet")


def test_energy_pipeline_end_to_end(spark, tmp_root):
    landing, warehouse = f"{tmp_root}/landing", f"{tmp_root}/warehouse"
    build_landing(spark, landing)
    published = energy.run(spark, landing, warehouse)
    assert {"gold.renovation_priority", "gold.conso_vs_temperature", "silver.dpe_clean"} <= set(published)

    # G-09: 4 quarter-hours per hour; hour 00 at 7.4 °C, hour 01 at 8.6 °C (+01:00 on both sides).
    g9 = sorted(tuple(r) for r in spark.table("gold.conso_vs_temperature").collect())
    assert g9 == [("Bretagne", 7.0, 4, 115.0), ("Bretagne", 9.0, 4, 215.0)]

    # G-08: only 35001 has ≥ 20 dwellings; D0 was re-diagnosed C in W48 → 4 of 20 in F/G... plus D93.
    g8 = spark.table("gold.renovation_priority").collect()
    assert [(r["code_commune"], r["nb_logements"]) for r in g8] == [("35001", 21)]
    assert g8[0]["pct_passoires"] == round(100.0 * 4 / 21, 1)

    # G-07: quarantine with reasons; newest version wins; exact duplicate collapsed.
    bad = {r["numero_dpe"]: r["_dq_reasons"] for r in spark.table("silver.dpe_quarantine").collect()}
    assert bad == {"D90": ["code_missing"], "D91": ["code_format"], "D92": ["surface"], "D50": ["surface"]}
    clean = spark.table("silver.dpe_clean")
    assert clean.filter("numero_dpe = 'D0'").select("classe_dpe", "etiquette_ges").first() == ("C", "B")
    assert clean.filter("numero_dpe = 'D1'").select("classe_dpe").first()[0] == "F"

    # G-03: bronze keeps everything, rescued number, drift columns NULL for v1 rows.
    bronze = spark.read.option("mergeSchema", True).parquet(f"{warehouse}/bronze/dpe_raw")
    assert bronze.count() == 28 + 2
    r = bronze.filter("numero_dpe = 'D50'").first()
    assert r["surface_habitable"] is None and json.loads(r["_rescued_data"]) == {"surface_habitable": "abc"}
    assert bronze.filter("_extract_week = '2024-W47' AND etiquette_ges IS NOT NULL").count() == 0
    dq = {r["_extract_week"]: r.asDict() for r in spark.table("bronze.dpe_dq_metrics").collect()}
    assert dq["2024-W47"]["rows"] == 28 and dq["2024-W47"]["dup_or_rediag"] == 1
    assert dq["2024-W47"]["neg_surface"] == 1 and dq["2024-W47"]["bad_commune"] == 2 and dq["2024-W47"]["rescued"] == 0
    assert dq["2024-W48"]["rescued"] == 1

    # G-06: latest pull wins; empty pull adds nothing.
    grid = {r["date_heure"]: r["consommation"] for r in spark.table("silver.eco2mix_clean").collect()}
    assert grid == {"2025-12-31T23:30:00+01:00": 1.0, "2025-12-31T23:45:00+01:00": 2.5, "2026-01-01T00:00:00+01:00": 3.0}

    inc = energy.silver_grid_incremental(spark, energy.Paths(landing, warehouse), max_files_per_trigger=1)
    assert {r["date_heure"]: r["consommation"] for r in inc.collect()} == grid

    # G-04 / G-05: codes keep leading zeros, weather flattened to 24 rows.
    assert {r["code_commune"] for r in spark.table("bronze.enedis_raw").collect()} == {"01234", "35001"}
    assert spark.table("silver.meteo_clean").count() == 24

    rep = energy.report(spark, landing, warehouse)
    layers = rep["layers"].first()
    assert layers["balanced"] and layers["good"] + layers["bad"] == layers["bronze"] - layers["superseded"]
    cov = {r["src"]: r["n"] for r in rep["coverage"].collect()}
    assert cov == {"archive": 8, "api": 4}
    assert rep["repeated_pulls"].first()["times_received"] == 2
    assert rep["skew"].first()["max_rows"] == 21

    # Original behaviour (session zone UTC): 00:00+01:00 pairs with the 23:00 UTC hour, so only the second hour matches.
    utc = energy.gold_conso_vs_temperature(spark.read.parquet(f"{warehouse}/bronze/eco2mix_raw"), spark.table("silver.meteo_clean"), source_tz="UTC")
    assert utc.agg(F.sum("nb_heures")).first()[0] == 4

    # Optimisation notebook: compaction / clustering keep content, pruning never gets worse.
    before = sorted(tuple(r) for r in spark.table("silver.dpe_clean").drop("_dq_reasons").collect())
    opt = energy.optimization_report(spark, warehouse, target_bytes=1 << 20)
    after = sorted(tuple(r) for r in spark.table("silver.dpe_clean").drop("_dq_reasons").collect())
    assert before == after
    pr = {r["table"]: r for r in opt["pruning"].collect()}
    assert pr["zordered"]["files_touched"] <= pr["no_zorder"]["files_touched"]
    assert pr["zordered"]["rows_touched"] == pr["no_zorder"]["rows_touched"] == 21 + 3
    assert {r["table"] for r in opt["stats_after"].collect()} == {"silver.dpe_clean", "silver.meteo_clean", "silver.communes", "gold.renovation_priority"}


def test_energy_incremental_grid_equals_batch(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    build_landing(spark, landing)
    energy.run(spark, landing, f"{tmp_root}/wh_batch")
    batch = {r["date_heure"]: r["consommation"] for r in spark.table("silver.eco2mix_clean").collect()}
    energy.run(spark, landing, f"{tmp_root}/wh_inc", incremental_grid=True)
    inc = {r["date_heure"]: r["consommation"] for r in spark.table("silver.eco2mix_clean").collect()}
    assert inc == batch and len(inc) == 3
