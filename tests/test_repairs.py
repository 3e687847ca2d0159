"""Faults that clean drops do not show."""

from __future__ import annotations

from pathlib import Path

import hospital
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.identity import fingerprint_groups, pseudonym
from tidemark.operators.measures import next_event
from tidemark.operators.skew import hot_keys
from tidemark.plans.model import DIAGNOSTICS, DROP_FILES
from tidemark.plans.warehouse import GOLD_TABLES, SILVER_TABLES, Warehouse
from tidemark.sources import drops, tables
from tidemark.sources.ingest import Lake
from tidemark.streaming.arrivals import arriving

PATIENTS = "patient_id,nir,nom,prenom,birth_date,sex,region_code\n"


def drop(root, source, day, name, text):
    folder = root / source / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "drops"), str(tmp_path / "house"), "a-secret-salt", as_of_year=2026)


def test_fingerprint_sees_nested_nulls(spark):
    def prints(entries):
        rows = spark.createDataFrame([("s1", entries)], DIAGNOSTICS).withColumn("file", F.lit("f"))
        return fingerprint_groups(rows, "file", ["stay_id", "diagnostics"]).first()["sha256"]

    seen = {prints(e) for e in ([("A", None)], [(None, "A")], [("A", None), (None, None)], [None, ("A", None)], [], None)}
    assert len(seen) == 6


def test_line_breaks_inside_quotes(spark, tmp_path):
    drop(tmp_path / "drops", "patients", "2026-08-01", "patients.csv", PATIENTS + 'p1,1,"Du\nPont",A,1980-01-01,F,75\np2,2,B,B,1990-01-01,M,13\n')
    warehouse = house(spark, tmp_path)
    warehouse.ingest()
    rows = tables.read(spark, f"{warehouse.root}/lake/patients/patients").collect()
    assert sorted((row.birth_year, row.sex, row.region_code) for row in rows) == [("1980", "F", "75"), ("1990", "M", "13")]


def test_stream_refuses_another_column_order(spark, tmp_path):
    text = "nir,patient_id,nom,prenom,birth_date,sex,region_code\n1,p1,A,A,1980-01-01,F,75\n"
    drop(tmp_path / "drops", "patients", "2026-08-01", "patients.csv", text)
    rows = arriving(spark, str(tmp_path / "drops"), DROP_FILES[0])
    query = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    with pytest.raises(PySparkException):
        query.start().awaitTermination()


def test_failed_rebuild_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.rebuild(spark.range(5), path)
    with pytest.raises(PySparkException):
        tables.rebuild(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), path)
    with pytest.raises(PySparkException):
        tables.write_partitioned(spark.range(3).select("id", F.raise_error(F.lit("stop")).alias("day")), path, "day")
    assert tables.read(spark, path).count() == 5
    own = tables.rebuild(tables.read(spark, path).where("id > 1"), path)
    assert own.count() == 3


def test_reference_dropped_twice_and_sources_that_never_came(spark, tmp_path):
    for day, label in (("2026-08-01", "Cardio"), ("2026-08-02", "Cardiologie")):
        drop(tmp_path / "drops", "referentiels", day, "services.csv", f"service_code,service_label\nCARDIO,{label}\n")
    stay = "stay_id,patient_id,service_code,admission_ts,discharge_ts,admission_mode,discharge_mode\n"
    drop(tmp_path / "drops", "sejours", "2026-08-01", "sejours.csv", stay + "s1,p1,CARDIO,2026-08-01 10:00:00,2026-08-03 10:00:00,urgence,domicile\n")
    warehouse = house(spark, tmp_path)
    warehouse.ingest()
    warehouse.transform()
    services = warehouse.table("gold/dim_service").collect()
    assert [(row.service_code, row.service_label) for row in services] == [("CARDIO", "Cardiologie")]
    assert warehouse.table("gold/fact_sejour").count() == 1 and warehouse.table("bronze/monitoring").count() == 0
    warehouse.verify()


def test_next_event_without_times(frame):
    at = [None, None, "1970-01-01 00:30:00", "1970-01-01 00:10:00", "2026-01-01 10:00:00", "2026-01-01 10:00:00", "2026-01-03 00:00:00"]
    rows = [(key, time, stay) for key in ("p", "q") for stay, time in enumerate(at)] + [("r", None, 1)]
    df = frame("patient string, at string, stay int", *rows).withColumn("at", F.col("at").cast("timestamp"))
    every = [row.h for row in df.select(F.xxhash64("patient").alias("h")).distinct().collect()]

    def answer(hot):
        return sorted(map(repr, next_event(df, "patient", "at", "stay", "following", hot).collect()))

    assert answer([]) == answer(every) == answer(every[:1])


def test_next_event_of_one_moment_copies_and_no_key(frame):
    """A bulk load at one time, rows that agree in everything, NULL keys and tie-breaks."""
    rows = [("p", "2026-01-01 10:00:00", stay % 7) for stay in range(40)] + [("p", "2026-01-01 10:00:01", None)] * 2
    rows += [(None, "2026-01-01 10:00:00", 1), (None, None, 2), (None, "2026-01-02 10:00:00", None), (None, None, 2)]
    df = frame("patient string, at string, stay int", *rows).withColumn("at", F.col("at").cast("timestamp"))
    every = [row.h for row in df.select(F.xxhash64("patient").alias("h")).distinct().collect()]

    def answer(hot):
        return sorted(map(repr, next_event(df, "patient", "at", "stay", "following", hot).collect()))

    plain = answer([])
    assert plain == answer(every) == answer(every[:1])


def test_hot_keys_of_many_partitions(spark):
    df = spark.range(40_000, numPartitions=100).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    assert hot_keys(df, ["k"], hot_rows=1000) == [spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]]


def test_salt_is_not_in_any_repr(spark, tmp_path):
    assert "a-secret-salt" not in repr(house(spark, tmp_path)) + repr(Lake("/x", "a-secret-salt"))


def test_mixed_parquet_types_in_one_batch(spark, tmp_path):
    for day in range(3):
        frame = hospital.monitoring(day)
        if day == 1:
            frame = frame.dropna().astype({"heart_rate": "int64", "spo2": "int64"})
        folder = tmp_path / "drops/monitoring" / hospital.DAYS[day]
        folder.mkdir(parents=True)
        frame.to_parquet(folder / "monitoring.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    warehouse = house(spark, tmp_path)
    warehouse.ingest()
    table = tables.read(spark, f"{warehouse.root}/lake/monitoring/monitoring")
    assert table.select("business_date").distinct().count() == 3 and dict(table.dtypes)["heart_rate"] == "double"


def test_types_that_differ_within_a_day(spark, tmp_path):
    for day in range(3):
        folder = tmp_path / "drops/monitoring" / hospital.DAYS[day]
        folder.mkdir(parents=True)
        frame = hospital.monitoring(day).dropna()
        for number, kind in enumerate(("int64", "float64") if day == 1 else ("float64",)):
            typed = frame.astype({"heart_rate": kind, "spo2": kind})
            typed.to_parquet(folder / f"part-{number}.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    parts = drops.read_parquet_by_type(spark, str(tmp_path / "drops/monitoring/*/*.parquet"))
    assert sorted(dict(part.dtypes)["spo2"] for part in parts) == ["bigint", "double"]
    assert sum(part.count() for part in parts) == 4 * len(hospital.monitoring(0).dropna())
    alike = drops.read_parquet_by_type(spark, str(tmp_path / "drops/monitoring" / hospital.DAYS[0] / "*.parquet"))
    assert len(alike) == 1


def test_files_that_no_drop_names(spark, tmp_path):
    hospital.write_day(tmp_path / "drops", 0)
    drop(tmp_path / "drops", "sejours", "2026-08-26", "sejours.csv.bak", "x")
    drop(tmp_path / "drops", "surprise", "2026-08-26", "new.csv", "y")
    found = house(spark, tmp_path).unclaimed().collect()
    assert sorted(row.path.rpartition("/")[2] for row in found) == ["new.csv", "sejours.csv.bak"]


def contents(warehouse):
    names = [f"{layer}/{name}" for layer, tables in (("silver", SILVER_TABLES), ("gold", GOLD_TABLES)) for name in tables]
    journal = warehouse.table("clean/rejects").drop("detected_at")
    every = {name: warehouse.table(name) for name in names} | {"clean/rejects": journal}
    return {name: sorted(map(repr, df.select(*sorted(df.columns)).collect())) for name, df in every.items()}


def slices(warehouse, name, day):
    return {path for path in warehouse.stored(name).inputFiles() if f"business_date={day}" in path}


def test_a_day_at_a_time_equals_a_full_build(spark, tmp_path):
    """Also when a late stay turns the orphans of an earlier day into known facts, and when a
    day is dropped again with fewer rows."""
    first, second, third = hospital.DAYS
    daily = house(spark, tmp_path)
    for day in range(2):
        hospital.write_day(tmp_path / "drops", day)
        daily.replay(hospital.DAYS[day])
    tables_by_day = ("silver/monitoring", "silver/actes", "bronze/sejours", "gold/fact_acte")
    kept = {name: slices(daily, name, first) for name in tables_by_day}
    assert all(kept.values())
    daily.replay(second)
    assert {name: slices(daily, name, first) for name in tables_by_day} == kept

    hospital.write_day(tmp_path / "drops", 2)
    orphan = daily.table("clean/rejects").filter("rule = 'sejour_inconnu' AND source = 'actes'").first().natural_key
    stays = tmp_path / "drops/sejours" / third / "sejours.csv"
    stays.write_text(stays.read_text().rstrip("\n") + f"\n{orphan},IPP0000001,CARDIO,2026-08-26 10:00:00,,urgence,\n")
    daily.replay(third)
    again = tmp_path / "drops/monitoring" / second / "monitoring.parquet"
    hospital.monitoring(1).head(3).to_parquet(again, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    daily.replay(second)
    assert daily.table("silver/actes").filter(F.col("stay_id") == orphan).count() > 0
    stepwise = contents(daily)
    counted = {row.step: tuple(row)[1:4] for row in daily.steps().join(daily.status(1), "run_id").select("step", "rows_in", "rows_kept", "journal_rows").collect()}
    assert counted["actes"][1] == len(stepwise["silver/actes"]) and len(counted) == 6
    assert sum(journal for *_, journal in counted.values()) == len(stepwise["clean/rejects"])
    daily.transform()
    assert stepwise == contents(daily)


def test_a_daily_build_takes_in_every_landed_date(spark, tmp_path):
    """Also one whose ledger entry a crash prevented."""
    first, second, third = hospital.DAYS
    daily = house(spark, tmp_path)
    hospital.write_day(tmp_path / "drops", 0)
    daily.replay(first)
    for day in (1, 2):
        hospital.write_day(tmp_path / "drops", day)
    daily.ingest(second)
    daily.replay(third)
    assert daily.table("bronze/sejours").count() == 3 * len(hospital.stays(0))
    stepwise = contents(daily)
    daily.transform()
    assert stepwise == contents(daily)


def test_a_build_that_crashed_is_made_good(spark, tmp_path, monkeypatch):
    """After bronze is replaced: a late stay's earlier facts, then a changed reference."""
    first, second, _ = hospital.DAYS
    daily = house(spark, tmp_path)
    hospital.write_day(tmp_path / "drops", 0)
    daily.replay(first)
    hospital.write_day(tmp_path / "drops", 1)
    orphan = daily.table("clean/rejects").filter("rule = 'sejour_inconnu' AND source = 'actes'").first().natural_key
    stays = tmp_path / "drops/sejours" / second / "sejours.csv"
    stays.write_text(stays.read_text().rstrip("\n") + f"\n{orphan},IPP0000001,CARDIO,2026-08-26 10:00:00,,urgence,\n")

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError, match="lost"):
        patched.setattr(daily, "events", crash)
        daily.replay(second)
    daily.replay(second)
    stepwise = contents(daily)
    daily.transform()
    assert stepwise == contents(daily)

    services = tmp_path / "drops/referentiels" / second / "services.csv"
    services.parent.mkdir(parents=True)
    services.write_text("service_code,service_label\nXXX,Nouveau\n")
    with monkeypatch.context() as patched, pytest.raises(OSError, match="lost"):
        patched.setattr(daily, "events", crash)
        daily.replay(second)
    daily.replay(second)
    stepwise = contents(daily)
    daily.transform()
    assert stepwise == contents(daily)


def test_salt_is_in_no_printed_plan(spark, capsys):
    named = spark.range(3).select(F.col("id").cast("string").alias("patient_id"))
    hidden = named.select(pseudonym(F.col("patient_id"), "a-secret-salt").alias("patient_hash"))
    for mode in ("extended", "formatted", "codegen", "cost"):
        hidden.explain(mode)
    printed = capsys.readouterr().out
    assert "sha2" in printed and "a-secret-salt" not in printed
