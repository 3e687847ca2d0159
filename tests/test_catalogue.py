"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import compare

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.catalogue import REGISTRY
from tidemark.catalogue.registry import TABLE_NAMES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLE_NAMES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(REGISTRY) <= set(queries())
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_its_sql(spark, db, name):
    got = queries()[name](spark, str(FOLDER)).toPandas()
    cursor = db.execute(oracle_sql()[name])
    wanted = pd.DataFrame(cursor.fetchall(), columns=[column[0] for column in cursor.description])
    assert sorted(got.columns) == sorted(wanted.columns)
    assert compare.normal(got) == compare.normal(wanted)


def test_entry(spark):
    assert entry(spark).count() > 0


# Queries that look for hot keys while they run.
HEATED = (
    "join_1_link_facts join_1_link_hot_customers join_7_orphans win_1_next_event win_1_next_event_hot_keys kpi_3_readmission_30d "
    "kpi_7_prevalence_k5 kpi_10_acts_per_service kpi_13_billing_by_service bld_4_diagnostics bld_5_procedures bld_8_fact_stays "
    "rul_14_rejects_summary chk_9_golden_values chk_10_procedures_vs_silver src_14_audit_step_counts"
).split()


@pytest.mark.parametrize("setting", ["enabled", "coalescePartitions.enabled"])
@pytest.mark.parametrize("name", [name for name in sorted(REGISTRY) if any(name.startswith(part) for part in HEATED)])
def test_query_without_adaptive_execution(spark, db, name, setting):
    """Many shuffle partitions stay empty, and nothing is planned anew while the query runs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(f"spark.sql.adaptive.{setting}", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        test_query_agrees_with_its_sql(spark, db, name)
    finally:
        spark.conf.set(f"spark.sql.adaptive.{setting}", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
