"""Rules and marts on the smallest rows that tell right from wrong."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.catalogue import REGISTRY
from tidemark.operators.skew import hot_keys
from tidemark.plans import bronze, checks, gold, kpis, silver

DAY = datetime(2026, 8, 1, 8)
STAY = (
    "stay_id string, patient_hash string, service_code string, admission_ts timestamp,"
    " discharge_ts timestamp, admission_mode string, discharge_mode string"
)
READING = "stay_id string, ts timestamp, heart_rate int, spo2 int, temp_c float"
PATIENT = "patient_hash string, birth_year int, sex string, region_code string, business_date date"


def stay(name, patient, admission, discharge, service="CARDIO"):
    return (name, patient, service, admission, discharge, "urgence", "domicile" if discharge else "")


@pytest.fixture
def services(frame):
    return frame("service_code string, service_label string", ("CARDIO", "Cardiologie"))


@pytest.fixture
def no_codes(frame):
    return frame("stay_id string, patient_hash string, code_cim10 string, type string").limit(0)


@pytest.mark.parametrize(
    ("vitals", "plausible"),
    [
        ((20, 50, 30.0), True),
        ((250, 100, 45.0), True),
        ((None, None, None), True),
        ((19, 90, 37.0), False),
        ((251, 90, 37.0), False),
        ((80, 49, 37.0), False),
        ((80, 101, 37.0), False),
        ((80, 90, 29.9), False),
        ((80, 90, 45.1), False),
        ((None, None, 29.9), False),
    ],
)
def test_vitals_bounds_are_inclusive(frame, vitals, plausible):
    cleaned = silver.monitoring(frame(READING, ("S1", DAY, *vitals)))
    assert cleaned.kept.count() == int(plausible)
    assert cleaned.rejects.count() == int(not plausible)
    assert checks.monitoring_borne(cleaned.kept).count() == 0


@pytest.mark.parametrize(
    ("year", "kept", "traced"),
    [(1899, None, 1), (1900, 1900, 0), (2026, 2026, 0), (2027, None, 1), (None, None, 0)],
)
def test_birth_year_bounds(frame, year, kept, traced):
    cleaned = silver.patients(frame(PATIENT, ("p", year, "M", "75", DAY.date())), 2026)
    assert [row.birth_year for row in cleaned.kept.collect()] == [kept]
    assert cleaned.rejects.filter("rule = 'birth_year_aberrant'").count() == traced


def test_readmissions(frame, services, no_codes):
    end = DAY + timedelta(days=2)
    stays = frame(
        STAY,
        stay("a1", "same day", DAY, end),
        stay("a2", "same day", end.replace(hour=1), end + timedelta(days=1)),
        stay("b1", "30 days", DAY, end),
        stay("b2", "30 days", end + timedelta(days=30), None),
        stay("c1", "31 days", DAY, end),
        stay("c2", "31 days", end + timedelta(days=31), end + timedelta(days=32)),
        stay("d1", "open first", DAY, None),
        stay("d2", "open first", end, end),
        stay("e1", "alone", DAY, end),
    )
    fact = gold.fact_sejour(silver.sejours(stays, services).kept, no_codes)
    assert tuple(kpis.readmission(fact, 30).first()) == (2, 9, 22.22)
    assert tuple(kpis.readmission(fact, 31).first()) == (3, 9, 33.33)


def test_one_fact_per_stay(frame, services):
    """Copies of a stay merge; of several principal codes the smallest is taken."""
    row = stay("s1", "p", DAY, DAY + timedelta(hours=3))
    kept = silver.sejours(frame(STAY, row, row, stay("s2", "p", DAY, None)), services).kept
    codes = frame(
        "stay_id string, patient_hash string, code_cim10 string, type string",
        ("s1", "p", "N39", "principal"),
        ("s1", "p", "I50", "principal"),
        ("s1", "p", "A00", "associe"),
    )
    fact = gold.fact_sejour(kept, codes)
    found = {r.stay_id: (r.los_days, r.diag_principal) for r in fact.collect()}
    assert fact.count() == 2 and found == {"s1": (0.12, "I50"), "s2": (None, "")}
    assert checks.fact_vs_silver_sejours(fact, kept).collect()[0].asDict() == {
        "fact": 2,
        "silver_sejours": 3,
    }


def test_a_repeated_stay_multiplies_facts_but_not_rejects(frame):
    stays = frame(STAY, stay("s1", "p", DAY, None), stay("s1", "q", DAY, None))
    codes = frame(
        "stay_id string, code_cim10 string, type string",
        ("s1", "I50", "principal"),
        ("s1", "BAD", "associe"),
        ("s9", "I50", "principal"),
    )
    reference = frame("code_cim10 string, libelle string", ("I50", "x"), ("I50", "x again"))
    cleaned = silver.diagnostics(codes, stays, reference)
    assert sorted(row.patient_hash for row in cleaned.kept.collect()) == ["p", "q"]
    assert sorted((r.natural_key, r.rule) for r in cleaned.rejects.collect()) == [
        ("s1", "code_cim10_hors_referentiel"),
        ("s9", "sejour_inconnu"),
    ]


def test_patient_days_round_half_even_per_stay(frame, services, no_codes):
    """99 hours are 4.125 days, 4.12 to even: 1648 for 400 stays, not 1650 or 1652."""
    stays = frame(STAY, *[stay(f"s{i}", "p", DAY, DAY + timedelta(hours=99)) for i in range(400)])
    fact = gold.fact_sejour(silver.sejours(stays, services).kept, no_codes)
    load = kpis.charge_service(fact, services).first()
    assert (load.admissions, load.patients_jours) == (400, 1648.0)


def test_facts_are_the_same_with_hot_stays(frame, services):
    row = stay("hot", "p", DAY, DAY + timedelta(hours=3))
    rows = [row] * 30 + [stay("hot", "q", DAY, None)] + [stay(f"s{i}", "p", DAY, None) for i in range(20)]
    kept = silver.sejours(frame(STAY, *rows).repartition(6), services).kept
    codes = frame(
        "stay_id string, patient_hash string, code_cim10 string, type string",
        *[("hot", "p", "N39", "principal")] * 40,
        ("s1", "p", "I50", "principal"),
    )
    hot = hot_keys(kept, ["stay_id"], hot_rows=10)
    assert len(hot) == 1
    plain, split = (gold.fact_sejour(kept, codes, chosen) for chosen in ([], hot))
    assert plain.count() == split.count() == 22
    assert plain.exceptAll(split).count() == 0


def test_facts_shuffle_each_table_once(spark, frame, capsys):
    """Without hot stays, merging copies and joining codes share one shuffle by stay."""
    kept = frame(STAY + ", los_hours double", (*stay("s", "p", DAY, None), None))
    codes = frame(
        "stay_id string, patient_hash string, code_cim10 string, type string",
        ("s", "p", "N39", "principal"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        gold.fact_sejour(kept, codes, []).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    plan = capsys.readouterr().out
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2 and all("hashpartitioning(stay_id" in line for line in shuffles)


def test_tariffs_default_to_zero_and_ages_are_frozen(frame, services):
    acts = frame(
        "stay_id string, patient_hash string, service_code string, code_ccam string,"
        " acte_ts timestamp, acte_date date",
        ("s", "p", "CARDIO", "KNOWN", DAY, DAY.date()),
        ("s", "p", "CARDIO", "OTHER", DAY, DAY.date()),
    )
    tariffs = frame("code_ccam string, libelle string, tarif_euros bigint", ("KNOWN", "k", 450))
    billed = kpis.montant_t2a(gold.fact_acte(acts, tariffs), services).first()
    assert (billed.montant_total_euros, billed.tarif_moyen_euros) == (450, 225.0)

    people = frame(
        "patient_hash string, birth_year int, sex string, region_code string",
        ("a", 2026, "F", "75"),
        ("b", 1926, "M", "75"),
        ("c", None, "", "75"),
    )
    kept = silver.sejours(frame(STAY, stay("s", "a", DAY, None)), services).kept
    ages = {r.patient_hash: (r.age_years, r.age_band) for r in gold.dim_patient(people, kept).collect()}
    assert ages == {"a": (0, "0-9"), "b": (100, "100+"), "c": (None, "inconnu")}


def test_bronze_types(frame):
    raw = frame(
        "patient_hash string, birth_year string, sex string, region_code string, business_date date",
        ("p", "1950", None, None, DAY.date()),
        ("q", "19x0", "M", "75", DAY.date()),
        ("r", "-5", "M", "75", DAY.date()),
        ("s", "70000", "M", "75", DAY.date()),
    )
    typed = bronze.patients(raw).collect()
    assert [row.birth_year for row in typed] == [1950, None, None, None]
    assert (typed[0].sex, typed[0].region_code) == ("", "")
    vitals = frame(
        "stay_id string, ts timestamp, heart_rate double, spo2 double, temp_c double",
        ("s", DAY + timedelta(milliseconds=750), 72.0, 95.5, 36.6),
    )
    reading = bronze.monitoring(vitals).first()
    assert (reading.heart_rate, reading.spo2, reading.ts) == (72, None, DAY)
    assert reading.temp_c == pytest.approx(36.6, abs=1e-5)


def test_share_of_nothing_is_nothing(frame, services, no_codes):
    fact = gold.fact_sejour(silver.sejours(frame(STAY).limit(0), services).kept, no_codes)
    assert kpis.mode_sortie(fact).count() == 0
    assert tuple(kpis.readmission(fact).first()) == (0, 0, None)
    assert kpis.dms(fact, services).filter(F.lit(True)).count() == 0


def test_checks_read_the_tables_that_were_written_once(spark, frame, tmp_path):
    """Twelve checks over few rows; what the tables were built from is not read for each check."""
    day, later = date(1998, 1, 5), datetime(2024, 1, 5, 10)
    tables = {
        "region": ("r_regionkey int, r_name string", (0, "ASIA")),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", (1, "JAPAN", 0)),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", (1, 1, 9000.0)),
        "customer": ("c_custkey long, c_nationkey int", (7, 1), (8, 1)),
        "part": (
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            (1, "a", "Brand#1", "LARGE", 3, 9.5),
            (2, "b", "Brand#2", "SMALL", 50, 1.5),
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, "
            "o_orderpriority string",
            (1, 7, "O", 30000.0, day, "1-URGENT"),
            (2, 8, "F", 1000.0, day, "2-HIGH"),
            (3, 8, "P", 30000.0, day, "2-HIGH"),
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_shipdate date",
            *[(order, part, part, "R", day) for order in (1, 2, 3) for part in (1, 2)],
        ),
        "events": (
            "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
            (1, later, 7, "view", 50.0, '{"k": 30}'),
            (2, later, 7, "view", 500.0, '{"k": 30}'),
        ),
    }
    for name, (columns, *rows) in tables.items():
        frame(columns, *rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    report = REGISTRY["chk_13_checks_report"](spark, str(tmp_path))
    found = {row.check[:2]: row.n_violations for row in report.collect()}
    # three rare codes and one cohort, a reading out of range, a wrong and a missing figure
    assert found == {f"{n:02}": 0 for n in range(1, 13)} | {"04": 4, "07": 1, "09": 2}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("l_orderkey|l_partkey", plan)
