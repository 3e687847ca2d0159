from __future__ import annotations

import shutil
from datetime import date

import hospital
import pytest
from pyspark.sql import functions as F

from tidemark.functions.identity import MissingSalt
from tidemark.operators.reconcile import VerificationError
from tidemark.plans import checks, kpis
from tidemark.plans.model import DROP_FILES
from tidemark.plans.warehouse import GOLD_TABLES, SILVER_TABLES, Warehouse
from tidemark.sources import drops, tables
from tidemark.sources.ingest import Lake, ingest
from tidemark.sources.publish import NotAllowed, publish, register_views
from tidemark.streaming.alerts import maintain_daily_alerts
from tidemark.streaming.arrivals import ingest_arrivals

FILES = {file.name: file for file in DROP_FILES}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("hospital")
    house = Warehouse(
        spark, str(hospital.write_all(root / "drops")), str(root / "house"), hospital.SALT, 2026, 1
    )
    house.ingest(*hospital.DAYS)
    house.transform()
    return house


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def counts(house):
    names = [f"silver/{n}" for n in SILVER_TABLES] + [f"gold/{n}" for n in GOLD_TABLES]
    return {name: house.table(name).count() for name in [*names, "clean/rejects"]}


def test_drop_dates(spark, warehouse):
    found = drops.drop_dates(spark, warehouse.drops).collect()
    assert [str(row.business_date) for row in found] == list(hospital.DAYS)


def test_nothing_identifying_reaches_the_lake(spark, warehouse):
    patients = tables.read(spark, warehouse.lake.path(FILES["patients"]))
    assert {"nir", "nom", "prenom", "patient_id", "birth_date"}.isdisjoint(patients.columns)
    assert patients.filter(F.length("patient_hash") != 16).count() == 0
    stays = tables.read(spark, warehouse.lake.path(FILES["sejours"]))
    assert "patient_id" not in stays.columns
    known = stays.join(patients.select("patient_hash").distinct(), "patient_hash", "left_semi")
    assert known.count() == stays.count()


def test_every_file_is_in_the_ledger_once(spark, warehouse):
    ledger = warehouse.lake.ledger(spark)
    assert ledger.count() == 5 * len(hospital.DAYS) + 4
    on_26th = ledger.filter("business_date = '2026-08-26'")
    assert on_26th.count() == 9
    assert warehouse.ingest(*hospital.DAYS).count() == 0


def test_patients(spark, warehouse):
    silver = warehouse.table("silver/patients")
    assert silver.count() == 12
    years = dict(
        tables.read(spark, warehouse.lake.path(FILES["patients"]))
        .join(silver.withColumnRenamed("birth_year", "kept"), "patient_hash")
        .groupBy("patient_hash")
        .agg(F.max("birth_year").alias("newest"), F.max("kept").alias("kept"))
        .select("newest", "kept")
        .collect()
    )
    assert years["1941"] == 1941 and years["1899"] is None and years["2027"] is None
    assert silver.filter("region_code = '13'").select("birth_year").first()[0] == 1941
    assert rows(silver.groupBy("sex").count(), "sex", "count") == [("", 1), ("F", 3), ("M", 8)]


def test_services(warehouse):
    assert rows(warehouse.table("silver/services"), "service_code", "categorie", "capacite_lits", "is_described") == [
        ("CARDIO", "medecine", 30, 1),
        ("NEURO", "(non décrit)", None, 0),
        ("URGENCES", "urgences", 20, 1),
    ]


def test_stays(warehouse):
    first_day = warehouse.table("silver/sejours").filter("stay_id < 'S0010'")
    assert rows(first_day, "stay_id", "los_hours") == [
        ("S0000", 2.0), ("S0001", None), ("S0002", 0.0), ("S0004", 4320.0), ("S0009", 3.0),
    ]
    fact = warehouse.table("gold/fact_sejour").filter("stay_id < 'S0010'")
    assert rows(fact, "stay_id", "los_days", "is_closed", "is_urgence", "diag_principal") == [
        ("S0000", 0.08, 1, 1, "I50"), ("S0001", None, 0, 1, ""), ("S0002", 0.0, 1, 1, ""),
        ("S0004", 180.0, 1, 1, ""), ("S0009", 0.12, 1, 0, ""),
    ]


def test_journal(warehouse):
    journal = warehouse.table("clean/rejects")
    counted = journal.groupBy("source", "rule").agg(F.count("*").alias("n"))
    per_rule = {(row.source, row.rule): row.n for row in counted.collect()}
    assert per_rule == {
        ("patients", "sex_non_normalise"): 1,
        ("patients", "birth_year_aberrant"): 2,
        ("referentiels", "service_sans_description"): 1,
        ("sejours", "admission_ts_invalide"): 3,
        ("sejours", "sortie_avant_admission"): 6,
        ("sejours", "duree_sejour_aberrante"): 3,
        ("sejours", "service_hors_referentiel"): 6,
        ("monitoring", "hors_plage_physiologique"): 21,
        ("diagnostics", "sejour_inconnu"): 6,
        ("diagnostics", "code_cim10_hors_referentiel"): 6,
        ("actes", "sejour_inconnu"): 6,
        ("actes", "code_ccam_hors_referentiel"): 6,
    }
    both = journal.filter("natural_key = 'S0008'")
    assert rows(both, "rule") == [("service_hors_referentiel",), ("sortie_avant_admission",)]
    details = dict(rows(journal.filter("source = 'monitoring' AND natural_key LIKE 'S0%'"), "natural_key", "detail"))
    assert details["S0010@2026-08-26 06:10:00"] == "hr=19 spo2=95 temp=37"
    assert details["S0015@2026-08-26 06:15:00"] == "hr=70 spo2=95 temp=45.1"
    assert details["S0016@2026-08-26 06:16:00"] == ""


def test_reading_days_reads_their_partitions_only(warehouse, capsys):
    days = warehouse.between("silver/monitoring", date(2026, 8, 27), date(2026, 8, 28))
    assert days.count() == 20 and days.columns == warehouse.table("silver/monitoring").columns
    days.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert "jour" in filters[0] and "20260827" in filters[0]
    month = warehouse.between("gold/fact_acte", date(2026, 8, 26), date(2026, 8, 26))
    assert month.count() == 4


def test_alerts(warehouse):
    daily = warehouse.marts()["kpi_pilotage_alertes_constantes"]
    # Of the ten plausible readings: 20 bpm with SpO2 91, 250 bpm, 49 bpm, 101 bpm, 38.6 degrees.
    assert [tuple(row)[1:] for row in daily.collect()] == [(10, 5, 50.0)] * 3


def test_diagnoses_and_procedures_of_rejected_stays_are_kept(warehouse):
    diagnoses, acts = warehouse.table("silver/diagnostics"), warehouse.table("silver/actes")
    assert diagnoses.filter("stay_id = 'S0003'").count() == 1
    assert rows(acts.filter("stay_id = 'S0003'"), "service_code") == [("CARDIO",)]
    assert warehouse.table("gold/fact_sejour").filter("stay_id = 'S0003'").count() == 0
    assert rows(warehouse.table("silver/pathologies"), "code_cim10") == [("I50",), ("J18",), ("N39",), ("Q90",)]
    assert rows(warehouse.table("silver/ccam"), "code_ccam") == [("DZEA001",), ("YYYY010",)]


def test_marts(warehouse):
    marts = warehouse.marts()
    density = [tuple(row) for row in marts["kpi_pilotage_densite_actes_lit"].collect()]
    assert density == [("CARDIO", "Cardiologie", 30, 9, 0.3), ("NEURO", "Neurologie", None, 3, None)]
    billed = [tuple(row) for row in marts["kpi_pilotage_montant_t2a"].collect()]
    assert billed == [("CARDIO", "Cardiologie", 9, 1500, 166.67), ("NEURO", "Neurologie", 3, 75, 25.0)]
    per_stay = {row.service_code: row.actes_par_sejour for row in marts["kpi_pilotage_actes_service"].collect()}
    assert per_stay == {"CARDIO": 0.38, "NEURO": 1.0}
    assert rows(marts["kpi_recherche_prevalence"], "code_cim10", "nb_patients") == [
        ("I50", 6), ("J18", 1), ("N39", 6), ("Q90", 1),
    ]


def test_masked_cells_stay_masked_in_the_pyramid(warehouse):
    masked = kpis.cohorte_age_sexe(
        warehouse.table("silver/diagnostics"), warehouse.table("gold/dim_patient"), 2
    )
    assert masked.filter("nb_patients < 2").count() == 0
    published = masked.agg(F.sum("nb_patients")).first()[0]
    assert kpis.pyramide(masked).agg(F.sum("nb_patients")).first()[0] == published
    rare = kpis.rare_codes(warehouse.table("silver/diagnostics"), warehouse.table("gold/dim_cim10"), 5)
    assert rows(rare, "code_cim10", "nb_patients") == [("J18", 1), ("Q90", 1)]


def test_every_card_runs(warehouse):
    marts = warehouse.marts()
    for name in [*kpis.CARDS, kpis.PYRAMID_CARD]:
        assert kpis.card(name, marts).columns


def test_transform_is_idempotent(warehouse):
    before = counts(warehouse)
    warehouse.transform()
    assert counts(warehouse) == before
    warehouse.transform("gold")
    with pytest.raises(ValueError):
        warehouse.transform("platinum")


def test_checks_pass_and_catch_a_break(spark, warehouse):
    relaxed = {name: check for name, check in warehouse.checks().items() if name != "04_kanonymat"}
    from tidemark.operators.reconcile import report, verify

    assert {row.n_violations for row in report(relaxed).collect()} == {0}
    golden = (("readmission_30j_denominateur", 1.0, 0.0), ("dms_NOWHERE_jours", 1.0, 0.1))
    broken = checks.golden_mismatch(warehouse.marts(), golden)
    assert rows(broken, "repere", "obtenu")[0] == ("dms_NOWHERE_jours", None)
    with pytest.raises(VerificationError, match="09"):
        verify({"09": broken})
    with pytest.raises(VerificationError, match="04_kanonymat"):
        warehouse.verify()
    last = warehouse.status(1).first()
    assert (last.action, last.status) == ("verify", "error") and len(last.error) <= 500


def test_publishing_respects_the_lists(spark, warehouse, tmp_path):
    marts = warehouse.marts()
    allowed = {"kpi_recherche_prevalence": marts["kpi_recherche_prevalence"]}
    assert publish("recherche", allowed, str(tmp_path)) == ["kpi_recherche_prevalence"]
    assert tables.read(spark, f"{tmp_path}/recherche/kpi_recherche_prevalence").count() == 4
    with pytest.raises(NotAllowed):
        publish("recherche", {"kpi_pilotage_dms": marts["kpi_pilotage_dms"]}, str(tmp_path))
    with pytest.raises(NotAllowed):
        publish("pilotage", {**allowed, "kpi_pilotage_dms": marts["kpi_pilotage_dms"]}, str(tmp_path))
    with pytest.raises(NotAllowed):
        publish("public", {}, str(tmp_path))
    assert not (tmp_path / "pilotage").exists()
    register_views({"kpi_recherche_prevalence": marts["kpi_recherche_prevalence"]})
    assert spark.sql("SELECT count(*) FROM kpi_recherche_prevalence").first()[0] == 4


# --- ingest ---------------------------------------------------------------------------


@pytest.fixture
def site(tmp_path):
    hospital.write_day(tmp_path / "drops", 0)
    return tmp_path


def stays_only(spark, site, lake, *dates):
    files = [FILES["sejours"]]
    return {r.source: r.n_files for r in ingest(spark, str(site / "drops"), lake, dates or None, files).collect()}


@pytest.mark.parametrize("salt", ["", "change-me"])
def test_no_ingest_without_a_salt(spark, site, salt):
    with pytest.raises(MissingSalt):
        ingest(spark, str(site / "drops"), Lake(str(site / "lake"), salt))
    assert not (site / "lake").exists()


@pytest.mark.parametrize("per_date", [False, True])
def test_identical_and_changed_files(spark, site, per_date):
    lake = Lake(str(site / "lake"), hospital.SALT, per_date)
    table = lake.path(FILES["sejours"])
    first = site / "drops/sejours/2026-08-26/sejours.csv"
    assert stays_only(spark, site, lake) == {"sejours": 1}
    assert stays_only(spark, site, lake) == {}

    later = site / "drops/sejours/2026-08-30/sejours.csv"
    later.parent.mkdir()
    shutil.copy(first, later)
    assert stays_only(spark, site, lake, "2026-08-30") == ({"sejours": 1} if per_date else {})
    dates = {str(r[0]) for r in tables.read(spark, table).select("business_date").distinct().collect()}
    assert dates == ({"2026-08-26", "2026-08-30"} if per_date else {"2026-08-26"})

    lines = first.read_text().splitlines()
    first.write_text("\n".join(lines[:4]) + "\n")
    assert stays_only(spark, site, lake, "2026-08-26") == {"sejours": 1}
    assert tables.read(spark, table).filter("business_date = '2026-08-26'").count() == 3
    recorded = lake.ledger(spark).filter("business_date = '2026-08-26'")
    assert recorded.count() == 2 and recorded.select("path").distinct().count() == 1


def test_a_new_salt_ingests_again(spark, site):
    stays_only(spark, site, Lake(str(site / "lake"), hospital.SALT))
    assert stays_only(spark, site, Lake(str(site / "lake"), "another salt")) == {"sejours": 1}


def test_equal_files_of_one_batch_count_once(spark, site):
    for other in ("2026-08-24", "2026-08-31"):
        copy = site / f"drops/sejours/{other}/sejours.csv"
        copy.parent.mkdir()
        shutil.copy(site / "drops/sejours/2026-08-26/sejours.csv", copy)
    lake = Lake(str(site / "lake"), hospital.SALT)
    assert stays_only(spark, site, lake) == {"sejours": 1}
    assert [str(r.business_date) for r in lake.ledger(spark).collect()] == ["2026-08-24"]


def test_a_missing_day_is_no_error(spark, site):
    lake = Lake(str(site / "lake"), hospital.SALT)
    assert ingest(spark, str(site / "drops"), lake, ["2031-01-01"]).count() == 0


def test_integers_and_floats_from_day_to_day(spark, site):
    """Vitals arrive as integers one day and as doubles the next."""
    frame = hospital.monitoring(1).dropna().astype({"heart_rate": "int64", "spo2": "int64"})
    path = site / f"drops/monitoring/{hospital.DAYS[1]}/monitoring.parquet"
    path.parent.mkdir()
    frame.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    lake = Lake(str(site / "lake"), hospital.SALT)
    for dropped in hospital.DAYS[:2]:
        ingest(spark, str(site / "drops"), lake, [dropped], [FILES["monitoring"]])
    table = tables.read(spark, lake.path(FILES["monitoring"]))
    assert table.count() == 17 + len(frame) and dict(table.dtypes)["spo2"] == "double"


def test_replay_and_daily_run(spark, tmp_path):
    hospital.write_day(tmp_path / "drops", 0)
    house = Warehouse(spark, str(tmp_path / "drops"), str(tmp_path / "house"), hospital.SALT, 2026, 5)
    house.run_daily(hospital.DAYS[0])
    before = counts(house)
    house.replay(hospital.DAYS[0])
    assert counts(house) == before
    hospital.write_day(tmp_path / "drops", 1)
    house.run_daily(hospital.DAYS[1])
    assert house.table("bronze/sejours").count() == 2 * len(hospital.stays(0))
    runs = [(r.action, str(r.business_date), r.status) for r in house.status().collect()]
    assert sorted(runs) == [
        ("replay", "2026-08-26", "success"),
        ("run-daily", "2026-08-26", "success"),
        ("run-daily", "2026-08-27", "success"),
    ]
    published = house.publish()
    assert len(published["pilotage"]) == 11 and len(published["recherche"]) == 2


# --- streams --------------------------------------------------------------------------


def test_arrivals_stream(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), hospital.SALT)
    for day in range(2):
        hospital.write_day(tmp_path / "drops", day)
        for name in ("sejours", "diagnostics", "monitoring"):
            ingest_arrivals(spark, str(tmp_path / "drops"), FILES[name], lake)
        stays = tables.read(spark, lake.path(FILES["sejours"]))
        assert stays.count() == (day + 1) * len(hospital.stays(0))
    assert lake.ledger(spark).count() == 6
    nested = tables.read(spark, lake.path(FILES["diagnostics"]))
    assert nested.select(F.explode("diagnostics")).count() == 2 * 19


def test_alerts_stream_agrees_with_the_batch(spark, warehouse, tmp_path):
    source = str(tmp_path / "readings")
    bronze = warehouse.table("bronze/monitoring")
    schema = bronze.schema
    for day in hospital.DAYS:
        bronze.filter(F.to_date("ts") == day).write.mode("append").parquet(source)
        readings = spark.readStream.schema(schema).parquet(source)
        maintain_daily_alerts(readings, str(tmp_path / "alerts"), str(tmp_path / "checkpoint"))
    streamed = tables.read(spark, str(tmp_path / "alerts"))
    batch = warehouse.marts()["kpi_pilotage_alertes_constantes"]
    assert rows(streamed, *batch.columns) == rows(batch, *batch.columns)
