"""The warehouse job: ingest, build the layers in order, verify, publish.

Layers are written as Parquet at each boundary. A later step reads the tables, so a lost
executor repeats only its own step, and each table is computed once. Tables of events are
kept by drop date: a day's run replaces the slices of that day, of every date landed since the
last complete build, and of days whose facts belong to stays that these brought or changed,
all of them in one job per table; other slices keep their files. What a build covers is
recorded once its gold is written.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.operators import quality, reconcile
from tidemark.operators.dedupe import merged_state
from tidemark.operators.measures import K_MIN
from tidemark.plans import bronze, checks, gold, kpis, silver
from tidemark.plans.model import AUDIENCES, DATE, DROP_FILES, STRING, DropFile, schema
from tidemark.session import inline, side_by_side
from tidemark.sources import audit, drops, snapshots, tables
from tidemark.sources.drops import if_present
from tidemark.sources.ingest import FILE, Lake, ingest, pseudonymise, together
from tidemark.sources.publish import publish

LAYERS = ("bronze", "clean", "silver", "gold")
DROPPED = "business_date"
EVENTS = ("sejours", "monitoring", "diagnostics", "actes")
JOURNAL = "clean/rejects"
# The lake's files: those the last complete build covered, those the build in progress found.
COVERED, FOUND = "meta/covered", "meta/found"
LAKE_FILES = schema(path=STRING, business_date=DATE)
# What marts add up, made of one drop date's rows of a table each.
PARTS = {
    "gold/part_alertes": ("silver/monitoring", kpis.alert_parts),
    "gold/part_actes": ("gold/fact_acte", kpis.act_parts),
    "gold/part_patients": ("silver/diagnostics", kpis.patient_pairs),
}
# The newest values of every patient, into which a date's snapshot merges.
STATE = "bronze/patient_state"
# Tables kept by drop date.
DATED = {f"{layer}/{name}" for layer in ("bronze", "silver") for name in EVENTS} | {
    "bronze/patients",
    "gold/fact_acte",
    JOURNAL,
    *PARTS,
}

# Partition column (computed from the named one) and sort order of the large tables.
LAYOUT = {
    "bronze/monitoring": ("jour", "ts", "yyyyMMdd", ["stay_id", "ts"]),
    "silver/monitoring": ("jour", "ts", "yyyyMMdd", ["stay_id", "ts"]),
    "bronze/actes": ("mois", "acte_ts", "yyyyMM", ["stay_id", "acte_ts"]),
    "silver/actes": ("mois", "acte_date", "yyyyMM", ["service_code", "acte_date", "stay_id"]),
    "gold/fact_sejour": ("mois", "admission_date", "yyyyMM", ["service_code", "admission_date", "stay_id"]),
    "gold/fact_acte": ("mois", "acte_date", "yyyyMM", ["service_code", "acte_date", "stay_id"]),
}
CLUSTERED = {
    "bronze/patients": ["patient_hash"],
    STATE: ["patient_hash"],
    "bronze/sejours": ["stay_id"],
    "bronze/diagnostics": ["stay_id", "code_cim10"],
    "silver/patients": ["patient_hash"],
    "silver/sejours": ["stay_id"],
    "silver/diagnostics": ["stay_id", "code_cim10"],
    "gold/dim_patient": ["patient_hash"],
    JOURNAL: ["rule"],
}
SILVER_TABLES = (
    "patients",
    "services",
    "sejours",
    "monitoring",
    "diagnostics",
    "actes",
    "pathologies",
    "ccam",
)
# Of each step: the bronze table it is given and its name in the journal.
STEPS = {"patients": ("patients", "patients"), "services": ("ref_services", "referentiels")} | {
    name: (name, name) for name in EVENTS
}
GOLD_TABLES = ("dim_service", "dim_cim10", "dim_ccam", "dim_patient", "fact_sejour", "fact_acte")


@dataclass
class Warehouse:
    """A warehouse below ``root`` fed from the drop tree ``drops``."""

    spark: SparkSession
    drops: str
    root: str
    salt: str = field(repr=False)
    as_of_year: int = field(default_factory=lambda: datetime.now(UTC).year)
    k: int = K_MIN
    files: tuple[DropFile, ...] = DROP_FILES
    json_lines: bool = False

    @property
    def lake(self) -> Lake:
        return Lake(self.root, self.salt)

    @property
    def runs(self) -> str:
        return f"{self.root}/meta/runs"

    def stored(self, name: str) -> DataFrame:
        return tables.read(self.spark, f"{self.root}/{name}")

    def dated(self, name: str, days: Sequence[date] | None = None) -> DataFrame:
        """A table of events with its drop date; of some days, or all."""
        df = self.stored(name)
        if name in LAYOUT:
            df = df.drop(LAYOUT[name][0])
        df = df.withColumn(DROPPED, F.col(DROPPED).cast("date"))
        return df if days is None else df.filter(F.col(DROPPED).isin(*days))

    def table(self, name: str) -> DataFrame:
        if name in DATED:
            return self.dated(name).drop(DROPPED)
        return self.stored(name).drop(*[LAYOUT[name][0]] if name in LAYOUT else [])

    def between(self, name: str, first: date, last: date) -> DataFrame:
        """The rows of a partitioned table from ``first`` to ``last``; other partitions are
        not read."""
        partition, origin, pattern, _ = LAYOUT[name]
        bounds = [F.date_format(F.lit(day), pattern).cast("int") for day in (first, last)]
        days = F.to_date(origin).between(first, last)
        found = self.stored(name).filter(F.col(partition).between(*bounds) & days)
        return found.drop(partition, *[DROPPED] if name in DATED else [])

    def layout(self, name: str, df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
        """The rows with their partition columns, those columns, and the order in files."""
        partition, cluster = [DROPPED] if name in DATED else [], CLUSTERED.get(name, [])
        if name in LAYOUT:
            column, origin, pattern, cluster = LAYOUT[name]
            df = df.selectExpr("*", f"date_format({origin}, '{pattern}') AS {column}")
            partition = [*partition, column]
        return df, partition, cluster

    def save(self, name: str, df: DataFrame) -> None:
        df, partition, cluster = self.layout(name, df)
        if partition:
            tables.write_partitioned(df, f"{self.root}/{name}", partition, cluster)
        else:
            tables.write_clustered(df, f"{self.root}/{name}", cluster)

    def save_days(self, name: str, days: Sequence[date | None], df: DataFrame) -> None:
        """Replace drop dates of a table in one job, None being the rows without one; ``df``
        holds their new rows."""
        df, partition, cluster = self.layout(name, df)
        tables.replace_slices(df, f"{self.root}/{name}", partition, days, cluster)

    def save_all(self, built: dict[str, DataFrame]) -> None:
        """Write tables that do not read one another."""
        side_by_side(partial(self.save, name, df) for name, df in built.items())

    def layer(self, layer: str, names) -> dict[str, DataFrame]:
        return {name: self.table(f"{layer}/{name}") for name in names}

    # --- steps ---------------------------------------------------------------------

    def ingest(self, *dates: str) -> DataFrame:
        """Bring drops into the lake in one batch, all dates when none given.

        Every given date has its own audit row.
        """
        with ExitStack() as rows:
            for date in dates or [""]:
                rows.enter_context(audit.tracked(self.spark, self.runs, "ingest", "lake", date))
            return ingest(
                self.spark, self.drops, self.lake, dates or None, self.files, self.json_lines
            )

    def unclaimed(self) -> DataFrame:
        """``path, length`` of files in the drop tree that no kind of drop file names, so that
        nothing dropped is passed over unseen."""
        found = drops.listing(self.spark, self.drops).select("path", "length")
        known = F.lit(False)
        for file in self.files:
            name = re.escape(file.pattern).replace(r"\*", "[^/]*")
            known = known | F.col("path").rlike(rf"/{re.escape(file.source)}/[^/]*/{name}$")
        return found.filter(~known)

    def landed(self, file: DropFile) -> DataFrame:
        """What the lake holds of one kind of file; no rows before the first one arrives."""
        present = if_present(tables.read, self.spark, self.lake.path(file))
        if present is not None:
            return present.drop(FILE)
        columns = [*(file.stored or file.schema).fields, StructField("business_date", DateType())]
        empty = self.spark.createDataFrame([], StructType(columns))
        return pseudonymise(empty, self.salt) if file.identifying else empty

    def typed(self, name: str) -> DataFrame:
        """A bronze table as the lake gives it; events carry their drop date."""
        source, typed = bronze.TABLES[name]
        lake = self.landed({file.name: file for file in self.files}[source])
        return typed(lake, DROPPED) if name in EVENTS else typed(lake)

    def build_bronze(self) -> None:
        self.save_all({f"bronze/{name}": self.typed(name) for name in bronze.TABLES})
        self.save(STATE, silver.patient_state(self.dated("bronze/patients")))

    def entities(self) -> dict[str, silver.Cleaned]:
        """What is built from all drops together."""
        raw = self.layer("bronze", ("ref_services", "ref_service_desc"))
        newest = self.table(STATE).select("patient_hash", *silver.patient_columns())
        return {
            "patients": silver.judged_patients(newest, self.as_of_year),
            "services": silver.services(raw["ref_services"], raw["ref_service_desc"]),
        }

    def events(self, days: Sequence[date] | None = None) -> dict[str, silver.Cleaned]:
        """Events of some drop dates, or all. Their stays may have been dropped on any date."""
        raw = {name: self.dated(f"bronze/{name}", days) for name in EVENTS}
        stays = self.table("bronze/sejours")
        refs = self.layer("bronze", ("ref_services", "ref_cim10", "ref_ccam"))
        carried = [DROPPED]
        return {
            "sejours": silver.sejours(raw["sejours"], refs["ref_services"], carried),
            "monitoring": silver.monitoring(raw["monitoring"], carried),
            "diagnostics": silver.diagnostics(
                raw["diagnostics"], stays, refs["ref_cim10"], carried=carried
            ),
            "actes": silver.actes(raw["actes"], stays, refs["ref_ccam"], carried=carried),
        }

    def cleaned(self) -> dict[str, silver.Cleaned]:
        return self.entities() | self.events()

    def build_clean(self, steps: dict[str, silver.Cleaned] | None = None) -> None:
        """The quarantine journal of all sources, by drop date; entities have none."""
        self.save(JOURNAL, quality.journal([s.rejects for s in (steps or self.cleaned()).values()]))

    def observed(self) -> dict[str, DataFrame]:
        return {
            "silver/pathologies": silver.pathologies(
                self.table("bronze/ref_cim10"), self.table("silver/diagnostics")
            ),
            "silver/ccam": silver.ccam(self.table("bronze/ref_ccam"), self.table("silver/actes")),
        }

    def build_silver(self, steps: dict[str, silver.Cleaned] | None = None) -> None:
        steps = steps or self.cleaned()
        self.save_all({f"silver/{name}": step.kept for name, step in steps.items()})
        self.save_all(self.observed())

    def star(self) -> dict[str, DataFrame]:
        """Gold but for the procedures, which are kept by drop date."""
        clean = self.layer("silver", SILVER_TABLES)
        return {
            "gold/dim_service": clean["services"],
            "gold/dim_cim10": clean["pathologies"],
            "gold/dim_ccam": clean["ccam"],
            "gold/dim_patient": gold.dim_patient(clean["patients"], clean["sejours"]),
            "gold/fact_sejour": gold.fact_sejour(clean["sejours"], clean["diagnostics"]),
        }

    def procedures(self, days: Sequence[date] | None = None) -> DataFrame:
        return gold.fact_acte(self.dated("silver/actes", days), self.table("silver/ccam"), [DROPPED])

    def parts(self, days: Sequence[date] | None = None) -> dict[str, DataFrame]:
        """The partials of some drop dates, or all."""
        return {name: part(self.dated(source, days), [DROPPED]) for name, (source, part) in PARTS.items()}

    def build_gold(self) -> None:
        self.save_all(self.star() | {"gold/fact_acte": self.procedures()})
        self.save_all(self.parts())

    # --- what builds cover ---------------------------------------------------------

    @property
    def unfinished(self) -> str:
        """Dates that builds since the last complete one set out to build."""
        return f"{self.root}/meta/unfinished"

    def note_found(self) -> None:
        """List what the lake holds: each file's slice and the version that has it. Every write
        is a version of its own, so changed content shows, also where a crash kept it out of
        the ledger."""
        held = []
        for file in self.files:
            now = snapshots.current(self.spark, self.lake.path(file))
            for name, version in now.slices.items() if now else ():
                day = re.match(rf"{DROPPED}=(\d{{4}}-\d{{2}}-\d{{2}})/", name)
                held.append((f"{file.source}/{file.name}/{version}/{name}", date.fromisoformat(day[1]) if day else None))
        tables.rebuild(inline(self.spark, held, LAKE_FILES), f"{self.root}/{FOUND}")

    def uncover(self) -> None:
        """Until the next complete build, no table can be relied on."""
        tables.remove(self.spark, f"{self.root}/{COVERED}")

    def cover(self) -> None:
        """Record the files found by a build that is complete."""
        tables.rebuild(self.stored(FOUND), f"{self.root}/{COVERED}")
        tables.remove(self.spark, self.unfinished)

    def uncovered(self) -> set[date | None]:
        """Drop dates whose files came, changed or went since the last complete build."""
        before, now = self.stored(COVERED), self.stored(FOUND)
        changed = before.exceptAll(now).union(now.exceptAll(before))
        return {row[DROPPED] for row in changed.select(DROPPED).distinct().collect()}

    # --- one day -------------------------------------------------------------------

    def extendable(self) -> bool:
        """Whether the last full build was completed, every table is there and the references
        say what they said before; a changed reference may judge any row of any day anew."""
        names = DATED | {f"bronze/{name}" for name in bronze.TABLES} | {STATE, COVERED}
        found = {name: if_present(self.stored, name) for name in names}
        if any(df is None or (name in DATED and DROPPED not in df.columns) for name, df in found.items()):
            return False
        references = [name for name in bronze.TABLES if name.startswith("ref_")]
        return not any(side_by_side(partial(self.reference_changed, name) for name in references))

    def reference_changed(self, name: str) -> bool:
        before, now = self.table(f"bronze/{name}"), self.typed(name)
        return not (before.exceptAll(now).isEmpty() and now.exceptAll(before).isEmpty())

    def days_to_refresh(self, days: set[date], stays: DataFrame) -> set[date | None]:
        """``days``, those of unfinished builds, and the drop dates of facts whose stay
        ``days`` add, change or take away; ``stays`` are typed ones of the lake.

        Only the stay column of the facts is read; one row per date reaches the driver.
        """
        columns = ["stay_id", "patient_hash", "service_code"]
        of_days = F.col(DROPPED).isin(*days)
        before = self.dated("bronze/sejours").filter(of_days).select(*columns)
        now = stays.filter(of_days).select(*columns)
        changed = before.exceptAll(now).union(now.exceptAll(before)).select("stay_id").distinct()
        facts = self.dated("bronze/diagnostics").select("stay_id", DROPPED)
        facts = facts.union(self.dated("bronze/actes").select("stay_id", DROPPED))
        met = facts.join(changed, "stay_id", "left_semi").select(DROPPED)
        begun = tables.read_or_empty(self.spark, self.unfinished, schema(business_date=DATE))
        return days | {row[DROPPED] for row in met.union(begun).distinct().collect()}

    def _build_day(self, day: date) -> None:
        """Bring every table up to date after drops of one date, and of any other date landed
        since the last complete build."""
        if not self.extendable():
            self._build()
            return
        self.note_found()
        landed = {name: self.typed(name) for name in ("patients", *EVENTS)}
        brought = self.uncovered() | {day}
        found = brought if None in brought else self.days_to_refresh(brought, landed["sejours"])
        if None in found:  # rows without a drop date
            self._build()
            return
        days = sorted(found)
        came = sorted(brought)
        later = self.only_adds_patients(came)
        begun = inline(self.spark, [(each,) for each in days], schema(business_date=DATE))
        tables.append(begun.coalesce(1), self.unfinished)
        side_by_side(
            partial(self.save_days, f"bronze/{name}", came, df.filter(F.col(DROPPED).isin(*came)))
            for name, df in landed.items()
        )
        state = silver.patient_state(self.dated("bronze/patients", came if later else None))
        self.save(STATE, merged_state(self.table(STATE), state, "patient_hash") if later else state)
        steps = self.events(days)
        rejects = quality.journal([step.rejects for step in steps.values()])
        side_by_side(
            [
                *[partial(self.save_days, f"silver/{name}", days, step.kept) for name, step in steps.items()],
                partial(self.save_days, JOURNAL, days, rejects),
            ]
        )
        entities = self.entities()
        self.save_all({f"silver/{name}": step.kept for name, step in entities.items()})
        undated = quality.journal([step.rejects for step in entities.values()])
        self.save_days(JOURNAL, [None], undated.withColumn(DROPPED, F.lit(None).cast("date")))
        self.save_all(self.observed())
        self.save_all(self.star())
        self.save_days("gold/fact_acte", days, self.procedures(days))
        side_by_side(partial(self.save_days, name, days, df) for name, df in self.parts(days).items())
        self.cover()

    def only_adds_patients(self, days: Sequence[date]) -> bool:
        """Whether snapshots of ``days`` can be merged into the kept state: none of them replaces
        one that is in it, and no build was begun and left."""
        held = snapshots.current(self.spark, f"{self.root}/bronze/patients").slices
        names = {snapshots.slice_name(self.spark, [DROPPED], [day]) for day in days}
        begun = tables.read_or_empty(self.spark, self.unfinished, schema(business_date=DATE))
        return names.isdisjoint(held) and begun.isEmpty()

    # --- jobs ----------------------------------------------------------------------

    def count_steps(self, run_id: str) -> None:
        """Add what each step now holds to the audit, under the run that built it."""
        journal = self.table(JOURNAL)
        counted = [
            audit.step_counts(
                step,
                self.table(f"bronze/{given}"),
                self.table(f"silver/{step}"),
                journal.filter(F.col("source") == source),
            )
            for step, (given, source) in STEPS.items()
        ]
        rows = together(counted).withColumn("run_id", F.lit(run_id))
        tables.append(rows.coalesce(1), f"{self.root}/meta/steps")

    def steps(self) -> DataFrame:
        return self.stored("meta/steps")

    def _build(self, layer: str | None = None) -> None:
        if layer in (None, "bronze"):
            self.uncover()
        if layer:
            getattr(self, f"build_{layer}")()
            return
        self.note_found()
        self.build_bronze()
        steps = self.cleaned()
        self.build_clean(steps)
        self.build_silver(steps)
        self.build_gold()
        self.cover()

    def transform(self, layer: str | None = None) -> None:
        """Rebuild one layer or all; repeating it changes nothing."""
        if layer is not None and layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        with audit.tracked(self.spark, self.runs, "transform", layer or "all") as run_id:
            self._build(layer)
            if layer is None:
                self.count_steps(run_id)

    def marts(self) -> dict[str, DataFrame]:
        """The marts; those of readings, procedures and diagnoses add up the kept partials."""
        alerts, acts, pairs = (self.table(name) for name in PARTS)
        kept = {"monitoring": alerts, "diagnostics": pairs}
        return kpis.marts(self.layer("gold", GOLD_TABLES) | {"fact_acte": acts}, self.layer("silver", SILVER_TABLES) | kept, self.k)

    def checks(self, golden=None) -> dict[str, DataFrame]:
        return checks.all_checks(
            self.layer("bronze", bronze.TABLES),
            self.layer("silver", SILVER_TABLES),
            self.layer("gold", GOLD_TABLES),
            self.table("clean/rejects"),
            self.marts(),
            golden,
        )

    def verify(self, golden=None) -> DataFrame:
        with audit.tracked(self.spark, self.runs, "verify"):
            return reconcile.verify(self.checks(golden))

    def publish(self) -> dict[str, list[str]]:
        """Write each audience its own marts."""
        marts = self.marts()
        return {
            audience: publish(
                audience, {name: marts[name] for name in allowed}, f"{self.root}/published"
            )
            for audience, allowed in AUDIENCES.items()
        }

    def replay(self, date: str) -> None:
        """Ingest a date again and build it again; files the ledger knows do not land twice."""
        with audit.tracked(self.spark, self.runs, "replay", "", date) as run_id:
            ingest(self.spark, self.drops, self.lake, [date], self.files, self.json_lines)
            self._build_day(datetime.fromisoformat(date).date())
            self.count_steps(run_id)

    def run_daily(self, date: str | None = None, golden=None) -> DataFrame:
        """A whole day under one run: ingest, transform, verify."""
        date = date or datetime.now(UTC).date().isoformat()
        with audit.tracked(self.spark, self.runs, "run-daily", "", date) as run_id:
            ingest(self.spark, self.drops, self.lake, [date], self.files, self.json_lines)
            self._build_day(datetime.fromisoformat(date).date())
            self.count_steps(run_id)
            return reconcile.verify(self.checks(golden))

    def status(self, n: int = 15) -> DataFrame:
        return audit.last_runs(self.spark, self.runs, n)
