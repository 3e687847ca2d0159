"""Projections, filters and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.catalogue import oracle as o
from tidemark.catalogue.bindings import SEX_BY_EVENT, chosen
from tidemark.catalogue.registry import Inputs, query
from tidemark.functions import coding, identity, numbers, timestamps
from tidemark.operators.measures import k_anonymous
from tidemark.plans import kpis

SALT = "tidemark-demo-salt"


@query("prj_1_select_rename", "SELECT n_nationkey AS service_code, n_name AS service_label FROM nation")
def _(t: Inputs) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("service_code"), F.col("n_name").alias("service_label")
    )


@query("prj_2_drop_identifiers", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t: Inputs) -> DataFrame:
    """Columns the table does not have are no error."""
    return t.customer.drop("c_name", "c_acctbal", "c_phone")


ODD_TEXT = """CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'n/a'
                             WHEN 'error' THEN k || '.5' ELSE '' || k END"""


def odd_text() -> Column:
    """Whole numbers by event type, others blank, words or fractions."""
    k = F.col("k").cast("string")
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "")
        .when(kind == "click", "n/a")
        .when(kind == "error", F.concat(k, F.lit(".5")))
        .otherwise(k)
    )


@query(
    "prj_3_tolerant_int",
    o.sql(
        f"""SELECT event_id, CASE WHEN regexp_matches(txt, '^[0-9]+$') THEN try_cast(txt AS INTEGER) END
                   AS from_text,
                   CASE WHEN half = floor(half) THEN CAST(half AS INTEGER) END AS from_number
            FROM (SELECT event_id, {ODD_TEXT} AS txt, k / 2.0 AS half FROM ev)"""
    ),
)
def _(t: Inputs) -> DataFrame:
    return t.activity.events.select(
        "event_id",
        numbers.int_from_text(odd_text()).alias("from_text"),
        numbers.int_from_number(F.col("k") / 2).alias("from_number"),
    )


@query(
    "cast_1_or_null_family",
    o.sql(
        f"""SELECT event_type, count(whole) AS n_int, count(*) FILTER (WHERE whole <= 65535) AS n_year,
                   count(TRY_CAST(txt AS FLOAT)) AS n_float
            FROM (SELECT event_type, txt, CASE WHEN regexp_matches(txt, '^[0-9]+$')
                                               THEN TRY_CAST(txt AS INTEGER) END AS whole
                  FROM (SELECT event_type, {ODD_TEXT} AS txt FROM ev)) GROUP BY 1"""
    ),
)
def _(t: Inputs) -> DataFrame:
    whole = numbers.int_from_text(F.col("txt"))
    return (
        t.activity.events.select("event_type", odd_text().alias("txt"))
        .groupBy("event_type")
        .agg(
            F.count(whole).alias("n_int"),
            F.count(coding.within_or_null(whole, 0, 65535)).alias("n_year"),
            F.count(numbers.float_from_number(F.col("txt"))).alias("n_float"),
        )
    )


LAYOUTS = {
    "view": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    "click": ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
    "purchase": ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S"),
    "signup": ("yyyyMMddHHmmss", "%Y%m%d%H%M%S"),
}


def timestamp_query(name: str) -> None:
    body = """SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS parsed FROM ev"""

    def run(t: Inputs) -> DataFrame:
        written = F.lit("not a date")
        for kind, (layout, _) in LAYOUTS.items():
            written = F.when(F.col("event_type") == kind, F.date_format("ts", layout)).otherwise(written)
        return t.activity.events.select(
            "event_id", timestamps.parse_timestamp(written).alias("parsed")
        )

    query(name, o.sql(body))(run)


timestamp_query("prj_4_parse_timestamps")


@query(
    "dt_6_best_effort_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS TIMESTAMP) END AS parsed
       FROM orders""",
)
def _(t: Inputs) -> DataFrame:
    """Order dates written as days only, with a time, or as the name of a priority."""
    written = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return t.orders.select("o_orderkey", timestamps.parse_timestamp(written).alias("parsed"))


@query(
    "prj_5_literal_tag",
    "SELECT 'customer' AS source, CAST(c_custkey AS VARCHAR) AS natural_key FROM customer",
)
def _(t: Inputs) -> DataFrame:
    return t.customer.select(
        F.lit("customer").alias("source"), F.col("c_custkey").cast("string").alias("natural_key")
    )


@query(
    "prj_6_boolean_flags",
    o.sql(
        """SELECT stay_id, CAST(discharge_ts IS NOT NULL AS INTEGER) AS is_closed,
                  CAST(admission_mode = 'urgence' AS INTEGER) AS is_urgence FROM ev_bronze"""
    ),
)
def _(t: Inputs) -> DataFrame:
    return t.activity.bronze_sejours.select(
        "stay_id",
        coding.flag(F.col("discharge_ts").isNotNull()).alias("is_closed"),
        coding.flag(F.col("admission_mode") == "urgence").alias("is_urgence"),
    )


# --- filters --------------------------------------------------------------------------


@query(
    "flt_1_null_tolerant_conjunction",
    o.sql(
        """SELECT stay_id FROM ev_bronze
           WHERE (discharge_ts IS NULL OR discharge_ts >= admission_ts)
             AND (discharge_ts IS NULL OR date_diff('day', admission_ts, discharge_ts) <= 1)"""
    ),
)
def _(t: Inputs) -> DataFrame:
    admission, discharge = F.col("admission_ts"), F.col("discharge_ts")
    return t.activity.bronze_sejours.filter(
        (discharge.isNull() | (discharge >= admission))
        & (discharge.isNull() | (timestamps.calendar_days(admission, discharge) <= 1))
    ).select("stay_id")


@query("flt_2_between", o.sql("SELECT stay_id, heart_rate, spo2, temp_c FROM mon_silver"))
def _(t: Inputs) -> DataFrame:
    return t.activity.monitoring.kept.select("stay_id", "heart_rate", "spo2", "temp_c")


@query("flt_2_not_between", o.sql("SELECT stay_id FROM mon_bronze WHERE heart_rate NOT BETWEEN 20 AND 250"))
def _(t: Inputs) -> DataFrame:
    return t.activity.bronze_monitoring.filter(coding.outside(F.col("heart_rate"), 20, 250)).select(
        "stay_id"
    )


@query("flt_3_three_valued_or", o.sql(f"SELECT stay_id, ts FROM mon_bronze WHERE {o.IS_ALERT}"))
def _(t: Inputs) -> DataFrame:
    return t.activity.bronze_monitoring.filter(kpis.is_alert()).select("stay_id", "ts")


@query(
    "flt_4_in_list",
    """SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_fast FROM orders
       WHERE o_orderstatus NOT IN ('P', 'X')""",
)
def _(t: Inputs) -> DataFrame:
    return t.orders.filter(~F.col("o_orderstatus").isin("P", "X")).select(
        "o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_fast")
    )


@query(
    "flt_5_comparisons_and_nulls",
    o.sql(
        """SELECT stay_id FROM mon_bronze WHERE heart_rate IS NULL
           UNION ALL
           SELECT stay_id FROM mon_bronze WHERE temp_c IS NOT NULL AND spo2 <> 100 AND spo2 >= 95"""
    ),
)
def _(t: Inputs) -> DataFrame:
    readings = t.activity.bronze_monitoring
    spo2 = F.col("spo2")
    high = readings.filter(F.col("temp_c").isNotNull() & (spo2 != 100) & (spo2 >= 95))
    return readings.filter(F.col("heart_rate").isNull()).select("stay_id").unionByName(
        high.select("stay_id")
    )


@query(
    "flt_6_having",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 600",
)
def _(t: Inputs) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).filter("n >= 600")


COHORT = """
    SELECT c_nationkey, c_mktsegment, o_orderpriority, count(DISTINCT c_custkey) AS n_customers
    FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal < 500
    GROUP BY ALL HAVING count(DISTINCT c_custkey) >= 5"""


@query("flt_7_k_anonymous_groups", COHORT)
def _(t: Inputs) -> DataFrame:
    poor = t.customer.filter(F.col("c_acctbal") < 500).select("c_custkey", "c_nationkey", "c_mktsegment")
    bought = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").distinct()
    keys = ["c_nationkey", "c_mktsegment", "o_orderpriority"]
    return k_anonymous(poor.join(bought, "c_custkey"), keys, "c_custkey", "n_customers", 5)


# --- scalar functions -----------------------------------------------------------------


@query(
    "str_1_normalise_code",
    o.sql(f"SELECT nir, {o.SEX.format('sex')} AS sex FROM ev_patients"),
)
def _(t: Inputs) -> DataFrame:
    raw = t.activity.events.select(
        F.col("event_id").alias("nir"), chosen(F.col("event_type"), SEX_BY_EVENT).alias("sex")
    )
    return raw.select("nir", coding.normalise_code(F.col("sex"), coding.SEX_SYNONYMS).alias("sex"))


@query(
    "str_2_concat_to_text",
    o.sql(
        """SELECT stay_id || '@' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS natural_key,
                  coalesce('hr=' || heart_rate || ' spo2=' || spo2, '') AS detail FROM mon_bronze"""
    ),
)
def _(t: Inputs) -> DataFrame:
    detail = F.concat(
        F.lit("hr="), F.col("heart_rate").cast("string"), F.lit(" spo2="), F.col("spo2").cast("string")
    )
    return t.activity.bronze_monitoring.select(
        F.concat("stay_id", F.lit("@"), timestamps.second_text(F.col("ts"))).alias("natural_key"),
        coding.text_or_blank(detail).alias("detail"),
    )


@query(
    "str_3_regex_extract",
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)/([a-z]+)/', 1) AS host,
               regexp_extract(url, '^https?://([^/]+)/([a-z]+)/', 2) AS lang FROM pages""",
)
def _(t: Inputs) -> DataFrame:
    pattern = "^https?://([^/]+)/([a-z]+)/"
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", pattern, 1).alias("host"),
        F.regexp_extract("url", pattern, 2).alias("lang"),
    )


@query(
    "str_4_year_prefix",
    o.sql(
        """SELECT nir, CASE WHEN sex = '?' THEN '' ELSE substr(birth_date, 1, 4) END AS birth_year
           FROM ev_patients"""
    ),
)
def _(t: Inputs) -> DataFrame:
    blanked = F.when(F.col("sex") == "?", F.lit("  ")).otherwise(F.concat(F.lit(" "), "birth_date"))
    return t.activity.raw_patients.select("nir", identity.year_prefix(blanked).alias("birth_year"))


@query(
    "cry_1_salted_pseudonym",
    f"""SELECT c_custkey, substr(sha256('{SALT}:' || c_custkey), 1, 16) AS customer_hash
        FROM customer""",
)
def _(t: Inputs) -> DataFrame:
    return t.customer.select(
        "c_custkey", identity.pseudonym(F.col("c_custkey").cast("string"), SALT).alias("customer_hash")
    )


@query("cry_2_content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def _(t: Inputs) -> DataFrame:
    return t.documents.select("doc_id", identity.content_hash(F.col("text")).alias("sha256"))


STAY_HOURS = o.hours("admission_ts", "discharge_ts")


@query(
    "dt_1_hours_between",
    o.sql(f"SELECT stay_id, {STAY_HOURS} AS los_hours FROM ev_bronze"),
)
def _(t: Inputs) -> DataFrame:
    los = timestamps.hours_between(F.col("admission_ts"), F.col("discharge_ts"))
    return t.activity.bronze_sejours.select("stay_id", los.alias("los_hours"))


@query(
    "dt_2_calendar_days",
    o.sql(
        """SELECT stay_id, CAST(date_diff('day', admission_ts, discharge_ts) AS INTEGER) AS days
           FROM ev_bronze"""
    ),
)
def _(t: Inputs) -> DataFrame:
    days = timestamps.calendar_days(F.col("admission_ts"), F.col("discharge_ts"))
    return t.activity.bronze_sejours.select("stay_id", days.alias("days"))


@query("dt_3_day_bucket", "SELECT CAST(ts AS DATE) AS jour, count(*) AS n FROM events GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.events.groupBy(timestamps.day(F.col("ts")).alias("jour")).agg(F.count("*").alias("n"))


@query("dt_4_to_second", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def _(t: Inputs) -> DataFrame:
    return t.events.select("event_id", timestamps.to_second(F.col("ts")).alias("ts"))


@query(
    "dt_5_year_of_latest",
    o.sql("SELECT CAST(year(max(admission_ts)) AS INTEGER) AS reference_year FROM cl_stays"),
)
def _(t: Inputs) -> DataFrame:
    from tidemark.plans.gold import reference_year

    return reference_year(t.clinic.sejours.kept)


@query(
    "dt_7_partition_keys",
    """SELECT strftime(l_shipdate, '%Y%m%d') AS jour, strftime(l_shipdate, '%Y%m') AS mois,
              count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def _(t: Inputs) -> DataFrame:
    shipped = F.col("l_shipdate")
    return t.lineitem.groupBy(
        timestamps.day_key(shipped).alias("jour"), timestamps.month_key(shipped).alias("mois")
    ).agg(F.count("*").alias("n"))


@query(
    "mth_1_half_even",
    o.sql(
        f"""SELECT stay_id, {o.half_even('los_hours / 24', 2)} AS los_days,
                   {o.half_even('los_hours / 24', 1)} AS los_tenths FROM ev_stays"""
    ),
)
def _(t: Inputs) -> DataFrame:
    days = F.col("los_hours") / 24
    return t.activity.sejours.kept.select(
        "stay_id",
        numbers.half_even(days, 2).alias("los_days"),
        numbers.half_even(days, 1).alias("los_tenths"),
    )


@query(
    "mth_2_safe_division",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS per_point,
              abs(l_discount - l_tax) AS gap FROM lineitem""",
)
def _(t: Inputs) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("per_point"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
    )


AGE = "(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 4000) AS INTEGER) - 5 END)"


@query(
    "cnd_1_age_band",
    f"SELECT {o.AGE_BAND.format(AGE)} AS age_band, count(*) AS n FROM orders GROUP BY 1",
)
def _(t: Inputs) -> DataFrame:
    age = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 4000).cast("int") - 5)
    return t.orders.groupBy(coding.age_band(age).alias("age_band")).agg(F.count("*").alias("n"))


@query(
    "cnd_2_range_to_null",
    o.sql(
        """SELECT patient_hash, version_seq,
                  CASE WHEN birth_year BETWEEN 1900 AND 2001 THEN birth_year END AS birth_year
           FROM cl_versions"""
    ),
)
def _(t: Inputs) -> DataFrame:
    return t.clinic.bronze_patients.select(
        "patient_hash",
        "version_seq",
        coding.within_or_null(F.col("birth_year"), 1900, 2001).alias("birth_year"),
    )


@query(
    "json_1_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              coalesce(json_extract_string(props, '$.absent'), '') AS absent FROM events""",
)
def _(t: Inputs) -> DataFrame:
    parsed = F.from_json("props", "k int, absent string")
    return t.events.select("event_id", parsed.alias("p")).select(
        "event_id", "p.k", coding.text_or_blank(F.col("p.absent")).alias("absent")
    )


@query("arr_1_explode_nested", o.sql("SELECT stay_id, code_cim10, type FROM cl_diag"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.bronze_diagnostics


@query(
    "arr_1_explode_embeddings",
    """SELECT vec_id, count(*) AS n, CAST(max(x) AS DOUBLE) AS largest
       FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY 1""",
)
def _(t: Inputs) -> DataFrame:
    return (
        t.embeddings.select("vec_id", F.explode("embedding").alias("x"))
        .groupBy("vec_id")
        .agg(F.count("*").alias("n"), F.max("x").cast("double").alias("largest"))
    )


@query(
    "bronze_vitals_typed",
    o.sql(
        """SELECT event_id AS stay_id, CASE WHEN value = floor(value) THEN CAST(value AS INTEGER) END
                  AS heart_rate, CAST(100 - k // 8 AS INTEGER) AS spo2 FROM ev"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """Readings whose whole numbers arrive as doubles; fractions are unreadable."""
    from tidemark.plans import bronze

    arrived = t.activity.events.select(
        F.col("event_id").alias("stay_id"),
        "ts",
        F.col("value").alias("heart_rate"),
        (F.lit(100) - F.floor(F.col("k") / 8)).cast("double").alias("spo2"),
        F.lit(37.0).alias("temp_c"),
    )
    return bronze.monitoring(arrived).select("stay_id", "heart_rate", "spo2")
