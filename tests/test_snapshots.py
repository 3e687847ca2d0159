"""Tables as versions: what readers see when a replacement stops half way, and what stays on disk."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import hospital
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans import kpis, silver
from tidemark.plans.model import DROP_FILES
from tidemark.plans.warehouse import GOLD_TABLES, SILVER_TABLES, Warehouse
from tidemark.sources import drops, ingest, snapshots, tables
from tidemark.sources.ingest import Lake

FILES = {file.name: file for file in DROP_FILES}


def ids(spark, path):
    return sorted(row[0] for row in tables.read(spark, path).select("id").collect())


def versions(path):
    return sorted(folder.name for folder in Path(path, "_data").iterdir())


class Stop(RuntimeError):
    pass


def stop(*_args, **_kwargs):
    raise Stop


def half(self, manifest):
    """A manifest of which only half was written."""
    text = manifest.text()
    Path(self.path, "_manifests", f"{self.number:09d}").write_text(text[: len(text) // 2])
    raise Stop


@pytest.mark.parametrize("step, how", [("commit", stop), ("_publish", stop), ("_publish", half)])
@pytest.mark.parametrize("partition", [None, "day"])
def test_a_replacement_that_stops_leaves_the_old_rows(spark, tmp_path, monkeypatch, step, how, partition):
    path = str(tmp_path / "table")
    rows = spark.range(6).withColumn("day", (F.col("id") % 3).cast("string"))
    tables.rebuild(rows, path, partition)
    tables.rebuild(rows.filter("id > 0"), path, partition)
    with monkeypatch.context() as patched:
        patched.setattr(snapshots.Write, step, how)
        with pytest.raises(Stop):
            tables.rebuild(rows.filter("id > 3"), path, partition)
        assert ids(spark, path) == [1, 2, 3, 4, 5]
        if partition:
            with pytest.raises(Stop):
                tables.replace_slices(rows.filter("id = 5"), path, ["day"], ["2", "0"])
            assert ids(spark, path) == [1, 2, 3, 4, 5]
    assert tables.rebuild(tables.read(spark, path).filter("id > 2"), path, partition).count() == 3
    tables.rebuild(tables.read(spark, path), path, partition)
    assert ids(spark, path) == [3, 4, 5]
    assert len(versions(path)) == 2 and len(list(Path(path, "_manifests").glob("[0-9]*"))) == 2


def test_a_write_that_stops_while_it_cleans_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    rows = spark.range(6).withColumn("day", (F.col("id") % 3).cast("string"))
    tables.rebuild(rows, path, "day")
    with monkeypatch.context() as patched:
        patched.setattr(snapshots.Write, "_sweep", stop)
        for gone in ("0", "1"):
            with pytest.raises(Stop):
                tables.replace_slices(rows.filter("id = 5"), path, ["day"], [gone])
    assert ids(spark, path) == [5]
    tables.replace_slices(rows.filter("id < 2"), path, ["day"], [])
    assert ids(spark, path) == [0, 1, 5] and len(versions(path)) == 2
    tables.rebuild(rows, path, "day")
    tables.rebuild(rows, path, "day")
    assert ids(spark, path) == [0, 1, 2, 3, 4, 5] and len(versions(path)) == 2


def test_the_first_write_of_a_table_that_stops(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    for how in (stop, half):
        with monkeypatch.context() as patched, pytest.raises(Stop):
            (tmp_path / "table/_manifests").mkdir(parents=True, exist_ok=True)
            patched.setattr(snapshots.Write, "_publish", how)
            tables.rebuild(spark.range(3), path)
        assert drops.if_present(tables.read, spark, path) is None
    tables.rebuild(spark.range(2), path)
    assert ids(spark, path) == [0, 1] and len(versions(path)) == 1


def test_a_reader_that_began_before_a_replacement(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(4).withColumn("day", F.col("id").cast("string"))
    before = tables.rebuild(rows, path, "day")
    tables.replace_slices(rows.limit(0), path, ["day"], ["1"])
    assert before.count() == 4 and ids(spark, path) == [0, 2, 3]
    again = tables.read(spark, path)
    tables.rebuild(rows.filter("id = 1"), path, "day")
    assert again.count() == 3 and ids(spark, path) == [1]


def test_slices_types_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame(
        [(1, "007", date(2024, 1, 5)), (2, "a/b=c", date(2024, 1, 6)), (3, None, None)], "id long, file string, day date"
    )
    table = tables.rebuild(rows, path, ["day", "file"])
    assert sorted(map(tuple, table.select(*rows.columns).collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    assert dict(table.dtypes) == dict(rows.dtypes)
    more = spark.createDataFrame([(4, "x", None), (5, "007", date(2024, 1, 7))], rows.schema)
    tables.replace_slices(more, path, ["day", "file"], [None, date(2024, 1, 5)])
    assert ids(spark, path) == [2, 4, 5]
    emptied = tables.replace_slices(more.limit(0), path, ["day", "file"], [None, date(2024, 1, 6), date(2024, 1, 7)])
    assert emptied.count() == 0 and dict(emptied.dtypes) == dict(rows.dtypes)
    with pytest.raises(ValueError, match="partitioned"):
        tables.replace_slices(more, path, ["file"], ["x"])


def test_two_writers_of_one_table(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.rebuild(spark.range(2), path)
    one, other = snapshots.Write(spark, path), snapshots.Write(spark, path)
    for write, rows in ((one, spark.range(3)), (other, spark.range(4))):
        write.stage(rows)
    other.commit()
    with pytest.raises(snapshots.Conflict):
        one.commit()
    assert ids(spark, path) == [0, 1, 2, 3]


def test_unchanged_files_are_not_opened(spark, tmp_path, monkeypatch):
    """Known files are skipped by length and time, a changed one is read again, alone."""
    for day in range(2):
        hospital.write_day(tmp_path / "drops", day)
    lake, opened = Lake(str(tmp_path / "lake"), hospital.SALT), []
    plain = ingest.read_drop
    monkeypatch.setattr(ingest, "read_drop", lambda spark, paths, *rest: opened.append(paths) or plain(spark, paths, *rest))

    def bring():
        opened.clear()
        return {row.source: row.n_files for row in ingest.ingest(spark, str(tmp_path / "drops"), lake).collect()}

    assert bring()["sejours"] == 2 and all(isinstance(paths, str) for paths in opened)
    assert bring() == {} and not opened
    changed = tmp_path / "drops/sejours" / hospital.DAYS[1] / "sejours.csv"
    lines = changed.read_text().splitlines()
    changed.write_text("\n".join(lines[:4]) + "\n")
    assert bring() == {"sejours": 1}
    assert [[Path(path).parent.name for path in paths] for paths in opened] == [[hospital.DAYS[1]]]
    stays = tables.read(spark, lake.path(FILES["sejours"]))
    assert stays.filter(F.col("business_date") == hospital.DAYS[1]).count() == 3
    assert stays.filter(F.col("business_date") == hospital.DAYS[0]).count() == len(hospital.stays(0))


def test_a_batch_that_stops_lands_again(spark, tmp_path, monkeypatch):
    hospital.write_day(tmp_path / "drops", 0)
    lake = Lake(str(tmp_path / "lake"), hospital.SALT)

    def bring():
        return {row.source: row.n_files for row in ingest.ingest(spark, str(tmp_path / "drops"), lake, files=[FILES["sejours"]]).collect()}

    for target, name in ((snapshots.Write, "_publish"), (ingest, "record")):
        with monkeypatch.context() as patched, pytest.raises(Stop):
            patched.setattr(target, name, stop)
            bring()
    assert lake.ledger(spark).count() == 0
    assert bring() == {"sejours": 1} and bring() == {}
    assert tables.read(spark, lake.path(FILES["sejours"])).count() == len(hospital.stays(0))
    assert lake.ledger(spark).count() == 1


def test_many_dates_are_one_job_per_table(spark, tmp_path, monkeypatch):
    """A build of twelve dates writes as often as one of two, and equals the full build."""
    written = []
    stage = snapshots.Write.stage
    monkeypatch.setattr(snapshots.Write, "stage", lambda self, rows: written.append(self.path) or stage(self, rows))

    def built(days):
        root = tmp_path / f"of-{days}"
        house = Warehouse(spark, str(root / "drops"), str(root / "house"), "a-secret-salt", as_of_year=2026)
        header = "stay_id,patient_id,service_code,admission_ts,discharge_ts,admission_mode,discharge_mode\n"
        drop(root / "drops/referentiels/2026-01-01/services.csv", "service_code,service_label\nCARDIO,Cardiologie\n")
        drop(root / "drops/referentiels/2026-01-01/ccam.csv", "code_ccam,libelle,tarif_euros\nX,Acte,7\n")
        for day in range(1, days + 1):
            stay = f"s{day},p{day},CARDIO,2026-01-{day:02d} 10:00:00,2026-01-{day:02d} 20:00:00,urgence,domicile\n"
            drop(root / f"drops/sejours/2026-01-{day:02d}/sejours.csv", header + stay)
            late = f"{tmp_path}/acts-{days}-{day}"
            acts = spark.sql(f"SELECT 'late' AS stay_id, 'X' AS code_ccam, timestamp'2026-01-{day:02d} 11:00:00' AS acte_ts")
            acts.coalesce(1).write.parquet(late)
            part = next(Path(late).glob("*.parquet"))
            target = root / f"drops/actes/2026-01-{day:02d}/actes.parquet"
            target.parent.mkdir(parents=True)
            target.write_bytes(part.read_bytes())
        house.ingest()
        house.transform()
        assert house.table("silver/actes").count() == 0
        drop(root / "drops/sejours/2026-02-01/sejours.csv", header + "late,p1,CARDIO,2026-01-01 10:00:00,,urgence,\n")
        written.clear()
        house.replay("2026-02-01")
        writes = sorted(path.removeprefix(str(root)) for path in written)
        assert house.table("silver/actes").count() == house.table("gold/fact_acte").count() == days
        return writes

    assert built(2) == built(12)


def drop(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_a_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(PySparkException):
        tables.rebuild(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert drops.if_present(tables.read, spark, path) is None


def read_by(df):
    """The drop dates that a plan reads, by its partition filters."""
    return {str(row.business_date) for row in df.select("business_date").distinct().collect()}


def test_a_day_reads_its_own_snapshot_and_partials(spark, tmp_path, monkeypatch):
    """A new day merges into the kept state without the older snapshots of patients, and makes
    its own partials; marts equal those computed from all facts."""
    daily = Warehouse(spark, str(tmp_path / "drops"), str(tmp_path / "house"), "a-secret-salt", as_of_year=2026, k=1)
    stated, parts = [], []
    state, made = silver.patient_state, Warehouse.parts
    monkeypatch.setattr(silver, "patient_state", lambda rows: stated.append(read_by(rows)) or state(rows))
    monkeypatch.setattr(Warehouse, "parts", lambda self, days=None: parts.append(days) or made(self, days))

    def equal():
        facts = {name: daily.table(f"gold/{name}") for name in GOLD_TABLES}
        cleaned = {name: daily.table(f"silver/{name}") for name in SILVER_TABLES}
        kept = ("alertes_constantes", "actes_service", "actes_type", "montant_t2a", "prevalence", "cohorte_age_sexe")
        for name, mart in kpis.marts(facts, cleaned, 1).items():
            if not name.endswith(kept):
                continue
            assert sorted(map(repr, mart.collect())) == sorted(map(repr, daily.marts()[name].collect())), name
        plain = silver.patients(daily.dated("bronze/patients"), 2026)
        kept = daily.table("silver/patients")
        assert sorted(map(repr, plain.kept.collect())) == sorted(map(repr, kept.collect()))

    for day in range(3):
        hospital.write_day(tmp_path / "drops", day)
        daily.replay(hospital.DAYS[day])
    assert stated[1:] == [{day} for day in hospital.DAYS[1:3]]
    # the first day is a full build; a later one also takes in days whose facts it completes
    assert parts[0] is None and all(date.fromisoformat(day) in some for day, some in zip(hospital.DAYS[1:], parts[1:], strict=True))
    again = tmp_path / "drops/patients" / hospital.DAYS[1] / "patients.csv"
    lines = again.read_text().splitlines()
    again.write_text("\n".join(lines[:-3]) + "\n")
    daily.replay(hospital.DAYS[1])
    assert stated[-1] == set(hospital.DAYS[:3])
    equal()
