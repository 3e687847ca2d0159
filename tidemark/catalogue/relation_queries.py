"""Joins, aggregates, windows, sorts and unions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalogue import oracle as o
from tidemark.catalogue.registry import Inputs, query
from tidemark.functions.coding import text_or_blank
from tidemark.functions.numbers import half_even, percent, ratio
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.linking import (
    enrich_with_gaps,
    lookup,
    observed_codes,
    only_known,
    only_unknown,
    with_defaults,
)
from tidemark.operators.measures import next_event, share_of_total, subjects_per_group, top
from tidemark.operators.reconcile import scalar_mismatch, tagged, tagged_union
from tidemark.operators.skew import heat, hot_keys, link
from tidemark.plans import gold, kpis
from tidemark.sources import audit, tables

# --- joins ----------------------------------------------------------------------------


@query(
    "join_1_link_facts",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def _(t: Inputs) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return link(lines, orders, "l_orderkey")


@query(
    "join_1_link_hot_customers",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def _(t: Inputs) -> DataFrame:
    """The same link with its hot keys forced, so that customers are dealt and repeated."""
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    hot = heat(orders, ["c_custkey"], hot_rows=10)
    named = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return link(orders, named, "c_custkey", "inner", hot).select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "join_2_fact_dimension",
    """SELECT s_suppkey, n_name, coalesce(r_name, '') AS r_name
       FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
       LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON r_regionkey = n_regionkey""",
)
def _(t: Inputs) -> DataFrame:
    regions = t.region.filter(F.col("r_name") != "ASIA").withColumnRenamed("r_regionkey", "n_regionkey")
    suppliers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    located = lookup(lookup(suppliers, t.nation, "n_nationkey"), regions, "n_regionkey")
    return with_defaults(located, {"r_name": ""}).select("s_suppkey", "n_name", "r_name")


@query(
    "join_3_enrich_with_gaps",
    """SELECT c_custkey, c_name, coalesce(o.priority, '(none)') AS priority, o.n_orders,
              CAST(o.o_custkey IS NOT NULL AS INTEGER) AS has_orders
       FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS priority,
                                       count(*) AS n_orders
                                FROM orders WHERE o_totalprice > 400000 GROUP BY 1) o
            ON o.o_custkey = c_custkey""",
)
def _(t: Inputs) -> DataFrame:
    big = (
        t.orders.filter(F.col("o_totalprice") > 400000)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderpriority").alias("priority"), F.count("*").alias("n_orders"))
    )
    listed = t.customer.select("c_custkey", "c_name")
    return enrich_with_gaps(
        listed, big, "c_custkey", ["priority"], ["n_orders"], "has_orders", "(none)"
    )


@query(
    "join_4_semi_reference",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def _(t: Inputs) -> DataFrame:
    return only_known(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query(
    "join_5_observed_codes",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey IN
         (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""",
)
def _(t: Inputs) -> DataFrame:
    returned = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    codes = returned.select(F.col("l_partkey").alias("p_partkey"))
    return observed_codes(t.part.select("p_partkey", "p_name"), codes, "p_partkey")


@query(
    "join_6_anti_reference",
    """SELECT doc_id, lang FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def _(t: Inputs) -> DataFrame:
    return only_unknown(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query(
    "join_7_orphans",
    """SELECT l_orderkey, count(*) AS n_lines FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
       GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    real = t.orders.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("l_orderkey"))
    orphans = link(t.lineitem.select("l_orderkey"), real, "l_orderkey", "left_anti")
    return orphans.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))


@query(
    "join_8_preaggregated",
    """SELECT a.o_orderpriority, n_orders, n_lines, n_lines / n_orders AS per_order FROM
         (SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1) a JOIN
         (SELECT o_orderpriority, count(*) AS n_lines FROM lineitem
          JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) b USING (o_orderpriority)""",
)
def _(t: Inputs) -> DataFrame:
    """Lines are counted per order before they meet the orders, totals before they meet."""
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    priority = t.orders.select("o_orderkey", "o_orderpriority")
    lines = (
        per_order.join(priority, "o_orderkey")
        .groupBy("o_orderpriority")
        .agg(F.sum("n").alias("n_lines"))
    )
    orders = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"))
    per = ratio(F.col("n_lines"), F.col("n_orders"))
    return orders.join(lines, "o_orderpriority").withColumn("per_order", per)


@query(
    "join_9_scalar_subquery",
    """SELECT c_custkey, (SELECT max(year(o_orderdate)) FROM orders) - 1900 - c_nationkey AS age
       FROM customer""",
)
def _(t: Inputs) -> DataFrame:
    latest = t.orders.agg(F.max(F.year("o_orderdate")).cast("bigint")).scalar()
    return t.customer.select("c_custkey", (latest - 1900 - F.col("c_nationkey")).alias("age"))


# --- aggregates -----------------------------------------------------------------------


@query(
    "agg_1_counts",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, (SELECT count(*) FROM lineitem) AS n_all
       FROM lineitem GROUP BY 1, 2""",
)
def _(t: Inputs) -> DataFrame:
    grouped = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return grouped.withColumn("n_all", t.lineitem.agg(F.count("*")).scalar())


@query(
    "agg_2_count_if",
    """SELECT l_shipdate AS day, count(*) FILTER (WHERE l_discount > 0.05) AS n_deals
       FROM lineitem GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    deals = F.count_if(F.col("l_discount") > 0.05).alias("n_deals")
    return t.lineitem.groupBy(F.col("l_shipdate").alias("day")).agg(deals)


@query("agg_3_average", "SELECT l_suppkey, avg(l_quantity) AS mean_quantity FROM lineitem GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("mean_quantity"))


@query(
    "agg_4_average_if",
    """SELECT l_suppkey, avg(l_quantity) FILTER (WHERE l_discount > 0.09) AS mean_quantity
       FROM lineitem GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    """A group without any matching row has no mean."""
    matching = F.when(F.col("l_discount") > 0.09, F.col("l_quantity"))
    return t.lineitem.groupBy("l_suppkey").agg(F.avg(matching).alias("mean_quantity"))


@query(
    "agg_5_sum",
    """SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
       FROM orders GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    cents = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.groupBy("o_custkey").agg(F.sum(cents).alias("cents"))


@query("agg_6_max", "SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))


@query(
    "agg_7_exact_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1",
)
def _(t: Inputs) -> DataFrame:
    return subjects_per_group(t.lineitem, ["l_returnflag"], "l_partkey", "n_parts")


@query(
    "agg_8_latest_non_null",
    """SELECT o_custkey,
              last(nullif(o_orderstatus, 'P') ORDER BY o_orderdate, o_orderkey)
                  FILTER (WHERE o_orderstatus <> 'P') AS status,
              last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS totalprice
       FROM orders GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    """The newest known status may be older than the newest price."""
    return latest_per_key(
        t.orders,
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        {"status": F.nullif("o_orderstatus", F.lit("P")), "totalprice": F.col("o_totalprice")},
    )


@query(
    "agg_9_any_value",
    "SELECT l_orderkey, min(l_returnflag) AS flag, min(l_partkey) AS part FROM lineitem GROUP BY 1",
)
def _(t: Inputs) -> DataFrame:
    """'Any' value of a group, made the smallest so that it never changes."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_returnflag").alias("flag"), F.min("l_partkey").alias("part")
    )


@query(
    "agg_10_conditional_pick",
    """SELECT l_orderkey, coalesce(min(CASE WHEN l_linenumber = 1 THEN l_returnflag END), '') AS flag
       FROM lineitem GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    first = F.min(F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")))
    return t.lineitem.groupBy("l_orderkey").agg(text_or_blank(first).alias("flag"))


@query(
    "agg_11_ratio_of_aggregates",
    f"""SELECT l_suppkey, {o.half_even("100.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*)", 1)}
               AS returned_pct FROM lineitem GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    returned = percent(F.count_if(F.col("l_returnflag") == "R"), F.count("*"), 1)
    return t.lineitem.groupBy("l_suppkey").agg(returned.alias("returned_pct"))


@query("agg_12_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t: Inputs) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "agg_13_hierarchy_rollup",
    """SELECT coalesce(r_name, '') AS r_name, count(*) AS n_customers,
              count(*) FILTER (WHERE c_acctbal < 0) AS n_negative
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    """Customers to nations to regions: each level is summed from the one below."""
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    per_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("neg")
    )
    located = lookup(lookup(per_nation, t.nation, "n_nationkey"), regions, "n_regionkey")
    return (
        with_defaults(located, {"r_name": ""})
        .groupBy("r_name")
        .agg(F.sum("n").alias("n_customers"), F.sum("neg").alias("n_negative"))
    )


# --- windows --------------------------------------------------------------------------

NEXT = """SELECT stay_id, lead(admission_ts) OVER (PARTITION BY patient_hash
                                                   ORDER BY admission_ts, stay_id) AS following
          FROM ev_bronze"""


def following(t: Inputs, hot=None) -> DataFrame:
    stays = t.activity.bronze_sejours.select("stay_id", "patient_hash", "admission_ts")
    ahead = next_event(stays, "patient_hash", "admission_ts", "stay_id", "following", hot)
    return ahead.select("stay_id", "following")


@query("win_1_next_event", o.sql(NEXT))
def _(t: Inputs) -> DataFrame:
    return following(t)


@query("win_1_next_event_hot_keys", o.sql(NEXT))
def _(t: Inputs) -> DataFrame:
    """The same with the stays of busy patients cut into ordered pieces."""
    return following(t, hot_keys(t.activity.bronze_sejours, ["patient_hash"], hot_rows=20))


@query(
    "win_2_share_of_total",
    f"""SELECT l_partkey, count(*) AS n,
               {o.half_even('100.0 * count(*) / sum(count(*)) OVER ()', 3)} AS share
        FROM lineitem GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    counted = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return share_of_total(counted, "n", "share", 3)


# --- sorts and limits -----------------------------------------------------------------


@query(
    "sort_1_multi_key",
    """SELECT n_regionkey, n_name, c_mktsegment, count(*) AS n FROM customer
       JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3
       ORDER BY n_regionkey, n DESC, n_name, c_mktsegment""",
)
def _(t: Inputs) -> DataFrame:
    counted = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(
        F.count("*").alias("n")
    )
    return (
        counted.join(t.nation, "n_nationkey")
        .select("n_regionkey", "n_name", "c_mktsegment", "n")
        .orderBy(F.asc_nulls_last("n_regionkey"), F.desc("n"), "n_name", "c_mktsegment")
    )


@query("sort_2_desc_nulls_last", o.sql(f"SELECT service_code, actes_par_lit FROM ({o.DENSITE})"))
def _(t: Inputs) -> DataFrame:
    density = kpis.densite_actes_lit(t.clinic.fact_acte, t.clinic.dim_service)
    return density.select("service_code", "actes_par_lit").orderBy(
        F.desc_nulls_last("actes_par_lit"), "service_code"
    )


@query(
    "topk_1_top15",
    """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15""",
)
def _(t: Inputs) -> DataFrame:
    counted = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return top(counted, 15, F.desc("n"), "l_partkey")


@query(
    "topk_2_last_n",
    """SELECT event_id, event_type, user_id FROM events ORDER BY ts DESC, event_id LIMIT 15""",
)
def _(t: Inputs) -> DataFrame:
    return top(t.events, 15, F.desc("ts"), "event_id").select("event_id", "event_type", "user_id")


@query(
    "topk_2_last_runs",
    """SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS action, started_at
       FROM (SELECT *, date_trunc('second', ts) AS started_at FROM events)
       ORDER BY started_at DESC, run_id LIMIT 15""",
)
def _(t: Inputs) -> DataFrame:
    """The newest rows of an audit table with one row per event."""
    path = t.scratch("runs")
    started = F.date_trunc("second", "ts")
    rows = t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("action"),
        F.lit("all").alias("layer"),
        F.to_date("ts").alias("business_date"),
        started.alias("started_at"),
        started.alias("finished_at"),
        F.lit("success").alias("status"),
        F.lit("").alias("error"),
    )
    tables.append(rows, path)
    return audit.last_runs(t.spark, path).select("run_id", "action", "started_at")


# --- unions ---------------------------------------------------------------------------


@query(
    "set_1_tagged_union",
    """SELECT 'orders' AS origin, CAST(o_orderkey AS VARCHAR) AS code FROM orders
       WHERE o_totalprice < 5000
       UNION ALL
       SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < -900""",
)
def _(t: Inputs) -> DataFrame:
    cheap = t.orders.filter(F.col("o_totalprice") < 5000)
    poor = t.customer.filter(F.col("c_acctbal") < -900)
    return tagged_union(
        [
            tagged(cheap, "origin", "orders", {"code": F.col("o_orderkey").cast("string")}),
            tagged(poor, "origin", "customer", {"code": F.col("c_custkey").cast("string")}),
        ]
    )


@query(
    "scalar_reconcile",
    """SELECT n_lines, n_orders FROM (SELECT (SELECT count(*) FROM lineitem) AS n_lines,
                                             (SELECT count(*) FROM orders) AS n_orders)
       WHERE n_lines <> n_orders""",
)
def _(t: Inputs) -> DataFrame:
    return scalar_mismatch(
        t.lineitem.agg(F.count("*").alias("n_lines")), t.orders.agg(F.count("*").alias("n_orders"))
    )


@query("fact_with_principal", o.sql("SELECT stay_id, code AS diag_principal FROM cl_principal"))
def _(t: Inputs) -> DataFrame:
    return gold.principal_codes(t.clinic.diagnostics.kept)


@query(
    "mean_days_from_hours",
    o.sql(
        f"""SELECT patient_hash, {o.half_even('avg(los_hours) / 24', 2)} AS mean_days
            FROM ev_stays GROUP BY 1"""
    ),
)
def _(t: Inputs) -> DataFrame:
    mean = half_even(F.avg("los_hours") / 24, 2)
    return t.activity.sejours.kept.groupBy("patient_hash").agg(mean.alias("mean_days"))
