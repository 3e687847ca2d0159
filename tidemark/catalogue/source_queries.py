"""Scans, sinks, ingest, publishing, audit and streams.

Their files are written by Spark from the given tables, whole, into the cluster's shared
folder, and read back.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, functions as F

from tidemark.catalogue import oracle as o
from tidemark.catalogue.registry import Inputs, query
from tidemark.catalogue.rule_queries import PATIENT_REJECTS, SERVICE_REJECTS
from tidemark.functions.timestamps import day_key
from tidemark.operators.reconcile import tagged_union
from tidemark.plans import bronze, kpis, silver
from tidemark.plans.model import AUDIENCES, DIAGNOSTICS, DROP_FILES
from tidemark.plans.warehouse import Warehouse
from tidemark.session import side_by_side
from tidemark.sources import audit, drops, publish, splitting, tables
from tidemark.sources.ingest import Lake, ingest
from tidemark.streaming.alerts import maintain_daily_alerts
from tidemark.streaming.arrivals import ingest_arrivals

SALT = "tidemark-demo-salt"
FILES = {file.name: replace(file, pattern=f"*.{file.format}") for file in DROP_FILES}


def drop_csv(df: DataFrame, root: str, source: str, mode: str = "errorifexists") -> str:
    """Write rows as one CSV folder per drop date."""
    writer = df.hint("rebalance", "business_date").write.mode(mode).partitionBy("business_date")
    writer.option("header", True).option("escape", '"').csv(f"{root}/{source}")
    return root


RAW_STAYS = """SELECT stay_id, patient_hash AS patient_id, service_code,
                      strftime(admission_ts, '%Y-%m-%d %H:%M:%S') AS admission_ts,
                      strftime(discharge_ts, '%Y-%m-%d %H:%M:%S') AS discharge_ts,
                      admission_mode, nullif(discharge_mode, '') AS discharge_mode
               FROM ev_bronze"""


@query("src_1_csv_scan", o.sql(RAW_STAYS))
def _(t: Inputs) -> DataFrame:
    root = drop_csv(t.activity.raw_sejours, t.scratch("csv"), "sejours")
    return drops.read_csv(t.spark, f"{root}/sejours/*/*.csv", FILES["sejours"].schema)


@query("src_1_csv_quoted_fields", o.sql("SELECT nir, nom, prenom FROM ev_patients"))
def _(t: Inputs) -> DataFrame:
    """Fields holding commas, quotes and JSON come back as they were."""
    root = drop_csv(t.activity.raw_patients, t.scratch("csv"), "patients")
    patients = drops.read_csv(t.spark, f"{root}/patients/*/*.csv", FILES["patients"].schema)
    return patients.select("nir", "nom", "prenom")


@query(
    "src_1_csv_split_records",
    o.sql("SELECT nir, replace(nom, ', ', ',' || chr(10)) AS nom, prenom FROM ev_patients"),
)
def _(t: Inputs) -> DataFrame:
    """Every record runs over a line break in quotes, and files are still read in splits."""
    broken = F.replace("nom", F.lit(", "), F.lit(",\n"))
    root = drop_csv(t.activity.raw_patients.withColumn("nom", broken), t.scratch("csv"), "patients")
    paths = [f"{root}/patients/*/*.csv"]
    patients = splitting.split_csv(t.spark, paths, FILES["patients"].schema, drops.csv_options(True))
    return patients.select("nir", "nom", "prenom")


@query("src_2_parquet_scan", o.sql("SELECT stay_id, ts, heart_rate, spo2 FROM mon_bronze"))
def _(t: Inputs) -> DataFrame:
    root = t.scratch("parquet")
    dated = t.activity.bronze_monitoring.withColumn("business_date", F.to_date("ts"))
    dated.hint("rebalance", "business_date").write.partitionBy("business_date").parquet(root)
    return drops.read_parquet(t.spark, f"{root}/*/*.parquet").select("stay_id", "ts", "heart_rate", "spo2")


@query("src_2_types_by_day", o.sql("SELECT stay_id, ts, heart_rate, spo2 FROM mon_bronze"))
def _(t: Inputs) -> DataFrame:
    """Readings dropped as integers on odd days and as doubles on even ones, in one batch."""
    root, lake = t.scratch("drops"), Lake(t.scratch("lake"), SALT)
    dated = t.activity.bronze_monitoring.withColumn("business_date", F.to_date("ts"))
    odd = F.dayofmonth("business_date") % 2 == 1
    for days, kind in ((odd, "bigint"), (~odd, "double")):
        typed = dated.filter(days).withColumns({n: F.col(n).cast(kind) for n in ("heart_rate", "spo2")})
        typed = typed.withColumn("temp_c", F.col("temp_c").cast("double")).hint("rebalance", "business_date")
        typed.write.mode("append").partitionBy("business_date").parquet(f"{root}/monitoring")
    ingest(t.spark, root, lake, files=[FILES["monitoring"]])
    landed = tables.read(t.spark, lake.path(FILES["monitoring"]))
    return bronze.monitoring(landed).select("stay_id", "ts", "heart_rate", "spo2")


@query("src_3_json_array_scan", o.sql("SELECT stay_id, code_cim10, type FROM cl_diag"))
def _(t: Inputs) -> DataFrame:
    """One JSON array per line, and files holding one array each; every object is a row."""
    root, raw = t.scratch("json"), t.clinic.raw_diagnostics
    part = F.coalesce(F.pmod(F.xxhash64("stay_id"), F.lit(128)), F.lit(0))
    held = F.struct("stay_id", "diagnostics")
    lines = raw.filter(part >= 64).select(F.to_json(F.array(held)).alias("value"))
    lines.write.text(f"{root}/lines")
    whole = raw.filter(part < 64).groupBy(part.alias("part")).agg(F.collect_list(held).alias("all"))
    whole = whole.select("part", F.to_json("all", {"pretty": "true"}).alias("value"))
    whole.write.partitionBy("part").text(f"{root}/whole")
    read = drops.read_json(t.spark, f"{root}/lines", DIAGNOSTICS, multi_line=False)
    read = read.unionByName(drops.read_json(t.spark, f"{root}/whole/*", DIAGNOSTICS))
    return read.select("stay_id", F.explode("diagnostics").alias("d")).select(
        "stay_id", "d.code_cim10", "d.type"
    )


@query("src_3_json_split_array", o.sql("SELECT stay_id, code_cim10, type FROM cl_diag"))
def _(t: Inputs) -> DataFrame:
    """Files holding one printed array each, one file per task, read in splits of their lines."""
    root = t.scratch("json")
    printed = t.clinic.raw_diagnostics.select(
        F.to_json(F.struct("stay_id", "diagnostics"), {"pretty": "true"}).alias("value")
    )
    printed.mapInArrow(splitting.one_array, "value string").write.option("lineSep", " ").text(root)
    read = splitting.split_json(t.spark, [root], DIAGNOSTICS)
    return read.select("stay_id", F.explode("diagnostics").alias("d")).select(
        "stay_id", "d.code_cim10", "d.type"
    )


CUSTOMER_LINE = "c_custkey || '|' || c_name || '|' || coalesce(c_mktsegment, '')"


@query(
    "cry_2_file_digests",
    f"""WITH written AS (
            SELECT c_nationkey, {CUSTOMER_LINE} AS line,
                   (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 8 AS chunk, c_custkey
            FROM customer),
        chunks AS (
            SELECT c_nationkey, chunk, sha256(string_agg(sha256(line), '' ORDER BY c_custkey)) AS digest,
                   sum(strlen(line) + 1)::BIGINT AS size
            FROM written GROUP BY 1, 2)
        SELECT 'c_nationkey=' || c_nationkey AS folder, sum(size)::BIGINT AS length,
               sha256(sum(size)::BIGINT || ':' || string_agg(digest, '' ORDER BY chunk)) AS sha256
        FROM chunks GROUP BY c_nationkey""",
)
def _(t: Inputs) -> DataFrame:
    """One file per nation, in the order of its customers, digested in chunks of eight lines."""
    root = t.scratch("digests")
    lines = t.customer.select("c_nationkey", "c_custkey", F.expr(CUSTOMER_LINE).alias("value"))
    ordered = lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.select("value", "c_nationkey").write.partitionBy("c_nationkey").text(root)
    digests = splitting.file_digests(t.spark, [f"{root}/*"], chunk=8)
    return digests.select(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("folder"), "length", "sha256")


@query(
    "src_4_path_date",
    o.sql("SELECT stay_id, CAST(admission_ts AS DATE) AS business_date FROM ev_bronze"),
)
def _(t: Inputs) -> DataFrame:
    root = drop_csv(t.activity.raw_sejours, t.scratch("csv"), "sejours")
    stays = drops.read_csv(t.spark, f"{root}/sejours/*/*.csv", FILES["sejours"].schema)
    return drops.with_path_date(stays).select("stay_id", "business_date")


@query(
    "src_5_drop_dates",
    "SELECT DISTINCT CAST(ts AS DATE) AS business_date FROM events",
)
def _(t: Inputs) -> DataFrame:
    root = drop_csv(t.activity.raw_sejours, t.scratch("csv"), "sejours")
    return drops.drop_dates(t.spark, root)


def ingested(t: Inputs) -> Lake:
    """Events dropped as stays and ingested twice: the second time changes nothing."""
    root = drop_csv(t.activity.raw_sejours, t.scratch("drops"), "sejours")
    lake = Lake(t.scratch("lake"), SALT)
    for _ in range(2):
        ingest(t.spark, root, lake, files=[FILES["sejours"]])
    return lake


PER_DAY = "SELECT CAST(ts AS DATE) AS business_date, count(*) AS n FROM events GROUP BY 1"


@query(
    "src_6_incremental_ingest",
    o.sql(
        f"""SELECT stay_id, substr(sha256('{SALT}:' || patient_hash), 1, 16) AS patient_hash,
                   CAST(admission_ts AS DATE) AS business_date FROM ev_bronze"""
    ),
)
def _(t: Inputs) -> DataFrame:
    lake = tables.read(t.spark, ingested(t).path(FILES["sejours"]))
    return lake.select("stay_id", "patient_hash", "business_date")


@query("src_7_file_ledger", PER_DAY)
def _(t: Inputs) -> DataFrame:
    ledger = ingested(t).ledger(t.spark)
    return ledger.groupBy("business_date").agg(F.sum("rows").alias("n"))


@query("src_8_full_rebuild", o.sql("SELECT * FROM ev_stays"))
def _(t: Inputs) -> DataFrame:
    """Built from bronze, then rebuilt from itself through a staging folder."""
    path = t.scratch("table")
    table = tables.rebuild(t.activity.bronze_sejours, path)
    kept = silver.sejours(table, t.activity.ref_services).kept
    return tables.rebuild(kept, path)


@query("src_9_replace_wider", o.sql("SELECT * FROM cl_dim_service"))
def _(t: Inputs) -> DataFrame:
    """A table of two columns replaced by one of six."""
    path = t.scratch("services")
    tables.rebuild(t.clinic.ref_services, path)
    return tables.rebuild(t.clinic.services.kept, path)


DAYS = ("20240105", "20240111")


@query(
    "src_10_partition_day_scan",
    o.sql(
        f"""SELECT strftime(ts, '%Y%m%d') AS jour, count(*) AS n, count(heart_rate) AS n_hr
            FROM mon_silver WHERE strftime(ts, '%Y%m%d') BETWEEN '{DAYS[0]}' AND '{DAYS[1]}' GROUP BY 1"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """A day-partitioned table, days replaced one by one, of which a week is read."""
    path = t.scratch("monitoring")
    keyed = t.activity.bronze_monitoring.withColumn("jour", day_key(F.col("ts")))
    clean = t.activity.monitoring.kept.withColumn("jour", day_key(F.col("ts")))
    tables.write_partitioned(keyed, path, "jour", ["stay_id", "ts"])
    table = tables.write_partitioned(clean, path, "jour", ["stay_id", "ts"], only_given=True)
    week = table.withColumn("jour", F.col("jour").cast("string")).filter(F.col("jour").between(*DAYS))
    return week.groupBy("jour").agg(F.count("*").alias("n"), F.count("heart_rate").alias("n_hr"))


@query(
    "src_10_replace_many_days",
    o.sql(
        f"""SELECT jour, sum(n)::BIGINT AS n, sum(n_hr)::BIGINT AS n_hr FROM (
              SELECT strftime(ts, '%Y%m%d') AS jour, 1 AS n, CASE WHEN heart_rate IS NULL THEN 0 ELSE 1 END AS n_hr
              FROM mon_silver WHERE strftime(ts, '%Y%m%d') BETWEEN '{DAYS[0]}' AND '{DAYS[1]}'
              UNION ALL
              SELECT strftime(ts, '%Y%m%d'), 1, CASE WHEN heart_rate IS NULL THEN 0 ELSE 1 END
              FROM mon_bronze WHERE strftime(ts, '%Y%m%d') NOT BETWEEN '{DAYS[0]}' AND '{DAYS[1]}')
            GROUP BY 1"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """A week of a raw table replaced by clean rows, and shown, at once; other days stay."""
    path = t.scratch("monitoring")
    keyed = t.activity.bronze_monitoring.withColumn("jour", day_key(F.col("ts")))
    clean = t.activity.monitoring.kept.withColumn("jour", day_key(F.col("ts")))
    tables.write_partitioned(keyed, path, "jour", ["stay_id", "ts"])
    week = [str(day) for day in range(int(DAYS[0]), int(DAYS[1]) + 1)]
    table = tables.replace_slices(clean.filter(F.col("jour").isin(*week)), path, ["jour"], week, ["stay_id", "ts"])
    return table.groupBy(F.col("jour").cast("string").alias("jour")).agg(
        F.count("*").alias("n"), F.count("heart_rate").alias("n_hr")
    )


@query(
    "src_11_clustered_scan",
    o.sql("SELECT stay_id, code_ccam, acte_ts FROM cl_actes WHERE stay_id BETWEEN '5' AND '6'"),
)
def _(t: Inputs) -> DataFrame:
    path = t.scratch("actes")
    table = tables.write_clustered(t.clinic.bronze_actes, path, ["stay_id", "acte_ts"])
    return table.filter(F.col("stay_id").between("5", "6"))


@query("src_12_kpi_views", o.sql(o.mode_sortie("ev_fact")))
def _(t: Inputs) -> DataFrame:
    fact = t.activity.fact_sejour
    publish.register_views(
        {
            "kpi_pilotage_mode_sortie": kpis.mode_sortie(fact),
            "kpi_pilotage_dms": kpis.dms(fact, t.activity.dim_service),
        }
    )
    return t.spark.sql("SELECT * FROM kpi_pilotage_mode_sortie ORDER BY nb_sejours DESC")


AUDIENCE_SQL = " UNION ALL ".join(
    f"SELECT '{audience}' AS audience, '{name}' AS mart, count(*) AS n FROM ({o.MARTS[name]})"
    for audience, names in AUDIENCES.items()
    for name in names
)


@query("src_13_audience_publish", o.sql(AUDIENCE_SQL))
def _(t: Inputs) -> DataFrame:
    """Facts and dimensions are written once, and the marts published from them; each audience's
    folder holds its own, whose rows are counted from there."""
    c, house, root = t.clinic, t.scratch("gold"), t.scratch("published")
    built = {
        "fact_sejour": c.stay_measures,
        "fact_acte": c.fact_acte,
        "dim_service": c.dim_service,
        "dim_patient": c.dim_patient,
        "diagnostics": c.diagnostics.kept,
        "monitoring": t.activity.monitoring.kept,
    }
    side_by_side(partial(tables.rebuild, df, f"{house}/{name}") for name, df in built.items())
    gold = {name: tables.read(t.spark, f"{house}/{name}") for name in built}
    marts = kpis.marts(gold | {"dim_ccam": c.ref_ccam, "dim_cim10": c.ref_cim10}, gold, emergency_service="1")
    counts = []
    for audience, names in AUDIENCES.items():
        publish.publish(audience, {name: marts[name] for name in names}, root)
        for name in names:
            rows = tables.read(t.spark, f"{root}/{audience}/{name}")
            counts.append(
                rows.agg(F.count("*").alias("n")).select(
                    F.lit(audience).alias("audience"), F.lit(name).alias("mart"), "n"
                )
            )
    return tagged_union(counts)


def step_sql(step: str, given: str, kept: str, rejected: str) -> str:
    return f"""SELECT '{step}' AS step, (SELECT count(*) FROM {given}) AS rows_in,
                      (SELECT count(*) FROM {kept}) AS rows_kept,
                      (SELECT count(*) FROM {rejected}) AS journal_rows"""


@query(
    "src_14_audit_step_counts",
    o.sql(
        " UNION ALL ".join(
            [
                step_sql("patients", "cl_versions", "cl_patients", f"({PATIENT_REJECTS})"),
                step_sql("services", "cl_services", "cl_dim_service", f"({SERVICE_REJECTS})"),
                step_sql("sejours", "ev_bronze", "ev_stays", "ev_rejects"),
                step_sql(
                    "monitoring",
                    "mon_bronze",
                    "mon_silver",
                    f"(SELECT 1 FROM mon_bronze WHERE {o.OUT_OF_RANGE})",
                ),
                step_sql("diagnostics", "cl_diag", "cl_silver_diag", "cl_diag_rejects"),
                step_sql("actes", "cl_actes", "cl_silver_actes", "cl_acte_rejects"),
            ]
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    """A tracked job appends its six steps' counts; they are read back from the audit table."""
    a, c, path = t.activity, t.clinic, t.scratch("audit")
    steps = {
        "patients": (c.bronze_patients, c.patients),
        "services": (c.ref_services, c.services),
        "sejours": (a.bronze_sejours, a.sejours),
        "monitoring": (a.bronze_monitoring, a.monitoring),
        "diagnostics": (c.bronze_diagnostics, c.diagnostics),
        "actes": (c.bronze_actes, c.actes),
    }
    counted = [audit.step_counts(step, given, cleaned.kept, cleaned.rejects) for step, (given, cleaned) in steps.items()]
    with audit.tracked(t.spark, f"{path}/runs", "transform", "silver"):
        tables.append(tagged_union(counted).coalesce(1), f"{path}/steps")
    return t.spark.read.parquet(f"{path}/steps")


# --- streams --------------------------------------------------------------------------


@query("stm_1_incremental_arrival", PER_DAY)
def _(t: Inputs) -> DataFrame:
    """Two runs of the arrivals stream; the second finds nothing new."""
    root = drop_csv(t.activity.raw_sejours, t.scratch("drops"), "sejours")
    lake = Lake(t.scratch("lake"), SALT)
    for _ in range(2):
        ingest_arrivals(t.spark, root, FILES["sejours"], lake)
    landed = tables.read(t.spark, lake.path(FILES["sejours"]))
    return landed.groupBy("business_date").agg(F.count("*").alias("n"))


@query("stm_2_daily_alerts_stream", o.sql(o.alertes("mon_silver")))
def _(t: Inputs) -> DataFrame:
    root, target = t.scratch("readings"), t.scratch("alerts")
    t.activity.bronze_monitoring.write.parquet(root)
    schema = t.spark.read.parquet(root).schema
    readings = t.spark.readStream.schema(schema).parquet(root)
    maintain_daily_alerts(readings, target, t.scratch("alerts-checkpoint"))
    return tables.read(t.spark, target)


@query(
    "stm_3_replay_one_day",
    o.sql("SELECT strftime(ts, '%Y%m%d') AS jour, count(*) AS n FROM mon_silver GROUP BY 1"),
)
def _(t: Inputs) -> DataFrame:
    """One day built again over the same table: its partition is replaced, not added to."""
    path = t.scratch("monitoring")
    keyed = t.activity.monitoring.kept.withColumn("jour", day_key(F.col("ts")))
    tables.write_partitioned(keyed, path, "jour", ["stay_id"])
    again = keyed.filter(F.col("jour") == DAYS[0])
    table = tables.write_partitioned(again, path, "jour", ["stay_id"], only_given=True)
    return table.groupBy(F.col("jour").cast("string").alias("jour")).agg(F.count("*").alias("n"))


@query(
    "stm_3_warehouse_replay",
    o.sql("SELECT stay_id, service_code, admission_ts, los_hours FROM ev_stays"),
)
def _(t: Inputs) -> DataFrame:
    """Stays dropped day by day and built whole; then late stays of two dates arrive, one date is
    only ingested, and the other is replayed by the warehouse."""
    stays, day = t.activity.raw_sejours, F.col("business_date").cast("string")
    late = day.isin("2024-01-05", "2024-01-06") & (F.pmod(F.xxhash64("stay_id"), F.lit(3)) == 0)
    late = F.coalesce(late, F.lit(False))
    root = drop_csv(stays.filter(~late), t.scratch("drops"), "sejours")
    listed = t.activity.ref_services.withColumn("business_date", F.lit("2024-01-01"))
    drop_csv(listed, root, "services")
    files = tuple(replace(file, source=name) for name, file in FILES.items())
    house = Warehouse(t.spark, root, t.scratch("house"), SALT, files=files)
    house.ingest()
    house.transform()
    drop_csv(stays.filter(late), root, "sejours", "append")
    house.ingest("2024-01-06")
    house.replay("2024-01-05")
    return house.table("silver/sejours").select("stay_id", "service_code", "admission_ts", "los_hours")
