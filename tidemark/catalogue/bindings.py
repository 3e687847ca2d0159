"""The given tables read as the hospital model.

``Activity`` takes stays, patients and readings from ``events``; ``Clinic`` takes stays
from ``orders``, codes and procedures from ``lineitem`` and ``part``, services from
``nation``. Both are bronze: the layers above are built by ``tidemark.plans``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.timestamps import second_text, to_second
from tidemark.operators.linking import lookup
from tidemark.operators.skew import heat, hot_keys
from tidemark.plans import gold, silver
from tidemark.plans.model import text_schema
from tidemark.session import inline

# Reference list of the event types; "error" is not in it.
ACTIVITY_SERVICES = (
    ("click", "Clic"),
    ("purchase", "Achat"),
    ("signup", "Inscription"),
    ("view", "Vue"),
)
# Spellings of sex by event type and by order priority.
SEX_BY_EVENT = {"view": "m", "click": "Homme", "signup": "FEMALE", "purchase": "femme", "error": "?"}
SEX_BY_PRIORITY = {
    "1-URGENT": "m",
    "2-HIGH": "Homme",
    "3-MEDIUM": "FEMALE",
    "4-NOT SPECIFIED": "femme",
    "5-LOW": "?",
}
# The part types that have a label; the other types are unknown codes.
TYPE_LABELS = (
    ("STANDARD", "Courant"),
    ("ECONOMY", "Economique"),
    ("MEDIUM", "Moyen"),
    ("LARGE", "Grand"),
)
LABELLED_BRANDS = 23
AS_OF_YEAR = 2001


def text(name: str) -> Column:
    return F.col(name).cast("string")


def chosen(column: Column, values: dict[str, str]) -> Column:
    picked = F.lit(None).cast("string")
    for key, value in values.items():
        picked = F.when(column == key, F.lit(value)).otherwise(picked)
    return picked


class Activity:
    """Stays and readings from ``events``: 5 % open, 5 % inverted, one type unknown."""

    def __init__(self, given) -> None:
        self.given, self.spark = given, given.spark

    @cached_property
    def events(self) -> DataFrame:
        """``json_tuple`` generates rows: no filter above it parses the text once more."""
        return self.given.events.select("*", F.json_tuple("props", "k").alias("k")).select(
            text("event_id").alias("event_id"),
            to_second(F.col("ts")).alias("ts"),
            text("user_id").alias("user_id"),
            "event_type",
            "value",
            "props",
            F.col("k").cast("int").alias("k"),
        )

    @cached_property
    def bronze_sejours(self) -> DataFrame:
        k, is_open = F.col("k"), F.col("k") >= 95
        discharge = F.timestamp_add("MINUTE", (k - 5) * 37, F.col("ts"))
        mode = F.when(k < 35, "domicile").when(k < 60, "transfert").when(k < 80, "mutation")
        return self.events.select(
            F.col("event_id").alias("stay_id"),
            F.col("user_id").alias("patient_hash"),
            F.col("event_type").alias("service_code"),
            F.col("ts").alias("admission_ts"),
            F.when(~is_open, discharge).alias("discharge_ts"),
            F.when(F.col("value") > 100, "urgence").otherwise("programme").alias("admission_mode"),
            F.when(is_open, "").otherwise(mode.otherwise("deces")).alias("discharge_mode"),
        )

    @cached_property
    def ref_services(self) -> DataFrame:
        return inline(
            self.spark, ACTIVITY_SERVICES, text_schema("service_code", "service_label")
        )

    @cached_property
    def bronze_monitoring(self) -> DataFrame:
        k, kind = F.col("k"), F.col("event_type")
        return self.events.select(
            F.col("event_id").alias("stay_id"),
            "ts",
            F.when(kind != "signup", F.floor("value").cast("int") + 40).alias("heart_rate"),
            (F.lit(100) - F.floor(k / 8)).cast("int").alias("spo2"),
            F.when(kind != "view", (F.lit(29.5) + k * F.lit(0.16)).cast("float")).alias("temp_c"),
        )

    @cached_property
    def raw_sejours(self) -> DataFrame:
        """Stays as they are dropped: text only, one drop per admission day."""
        return self.bronze_sejours.select(
            "stay_id",
            F.col("patient_hash").alias("patient_id"),
            "service_code",
            second_text(F.col("admission_ts")).alias("admission_ts"),
            second_text(F.col("discharge_ts")).alias("discharge_ts"),
            "admission_mode",
            "discharge_mode",
            F.to_date("admission_ts").alias("business_date"),
        )

    @cached_property
    def raw_patients(self) -> DataFrame:
        """Patients as they are dropped: identifying text, quotes and commas included."""
        return self.events.select(
            F.col("user_id").alias("patient_id"),
            F.col("event_id").alias("nir"),
            F.concat_ws(", ", "event_type", "props").alias("nom"),
            F.col("event_type").alias("prenom"),
            F.concat((F.lit(1924) + F.col("k")).cast("string"), F.lit("-05-07")).alias("birth_date"),
            chosen(F.col("event_type"), SEX_BY_EVENT).alias("sex"),
            F.col("k").cast("string").alias("region_code"),
            F.to_date("ts").alias("business_date"),
        )

    @cached_property
    def sejours(self) -> silver.Cleaned:
        return silver.sejours(self.bronze_sejours, self.ref_services)

    @cached_property
    def monitoring(self) -> silver.Cleaned:
        return silver.monitoring(self.bronze_monitoring)

    @cached_property
    def fact_sejour(self) -> DataFrame:
        return gold.stay_measures(self.sejours.kept)

    @cached_property
    def hot_patients(self) -> list[int]:
        """Patients with very many stays, from the raw key column alone."""
        keys = self.given.events.select(text("user_id").alias("patient_hash"))
        return hot_keys(keys, ["patient_hash"])

    @property
    def dim_service(self) -> DataFrame:
        return self.ref_services


class Clinic:
    """Stays, codes, procedures, patients and services from the order tables.

    Orders in state P never reach the hospital: their lines are orphans.
    """

    def __init__(self, given) -> None:
        self.given, self.spark = given, given.spark

    @cached_property
    def bronze_sejours(self) -> DataFrame:
        nations = self.given.customer.select(
            F.col("c_custkey").alias("o_custkey"), text("c_nationkey").alias("service_code")
        )
        days = F.floor(F.col("o_totalprice") / 2000).cast("int") - 10
        admission = F.col("o_orderdate").cast("timestamp")
        is_open = F.col("o_totalprice") >= 480000
        mode = F.when(F.col("o_orderstatus") == "O", "transfert").otherwise("domicile")
        orders = self.given.orders.filter(F.col("o_orderstatus") != "P")
        return lookup(orders, nations, "o_custkey").select(
            text("o_orderkey").alias("stay_id"),
            text("o_custkey").alias("patient_hash"),
            F.coalesce("service_code", F.lit("")).alias("service_code"),
            admission.alias("admission_ts"),
            F.when(~is_open, F.timestamp_add("DAY", days, admission)).alias("discharge_ts"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "urgence")
            .otherwise("programme")
            .alias("admission_mode"),
            F.when(is_open, "").otherwise(mode).alias("discharge_mode"),
        )

    @cached_property
    def ref_services(self) -> DataFrame:
        """All nations but those of one region, whose stays have an unknown service."""
        regions = self.given.region.filter(F.col("r_name") != "MIDDLE EAST").select(
            F.col("r_regionkey").alias("n_regionkey")
        )
        return self.given.nation.join(regions, "n_regionkey", "left_semi").select(
            text("n_nationkey").alias("service_code"), F.col("n_name").alias("service_label")
        )

    @cached_property
    def ref_service_desc(self) -> DataFrame:
        """Nations with a rich supplier: the region is the category, suppliers are beds."""
        beds = (
            self.given.supplier.filter(F.col("s_acctbal") > 5000)
            .groupBy(F.col("s_nationkey").alias("n_nationkey"))
            .agg(F.count("*").cast("int").alias("capacite_lits"))
        )
        regions = self.given.region.withColumnRenamed("r_regionkey", "n_regionkey")
        located = lookup(lookup(beds, self.given.nation, "n_nationkey"), regions, "n_regionkey")
        return located.select(
            text("n_nationkey").alias("service_code"),
            F.col("r_name").alias("categorie"),
            "capacite_lits",
            F.concat(F.lit("Pole "), F.col("r_name")).alias("pole"),
        )

    @cached_property
    def raw_diagnostics(self) -> DataFrame:
        """Nested codes of each line: none, the brand, or the brand and the part type."""
        parts = self.given.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
        kind = F.when(F.col("l_linenumber") == 1, "principal").otherwise("associe")
        brand = F.struct(F.col("p_brand").alias("code_cim10"), kind.alias("type"))
        other = F.struct(F.col("p_type").alias("code_cim10"), F.lit("associe").alias("type"))
        none = F.array().cast("array<struct<code_cim10:string,type:string>>")
        lines = self.given.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
        return lookup(lines, parts, "l_partkey").select(
            text("l_orderkey").alias("stay_id"),
            F.when(F.col("l_linenumber") == 7, none)
            .when(F.col("l_returnflag") == "R", F.array(brand, other))
            .otherwise(F.array(brand))
            .alias("diagnostics"),
        )

    @cached_property
    def bronze_diagnostics(self) -> DataFrame:
        return self.raw_diagnostics.select("stay_id", F.explode("diagnostics").alias("d")).select(
            "stay_id", "d.code_cim10", "d.type"
        )

    @cached_property
    def ref_cim10(self) -> DataFrame:
        number = F.col("id").cast("string")
        brands = self.spark.range(1, LABELLED_BRANDS + 1).select(
            F.concat(F.lit("Brand#"), number).alias("code_cim10"),
            F.concat(F.lit("Famille "), number).alias("libelle"),
        )
        return brands.unionByName(
            inline(self.spark, TYPE_LABELS, text_schema("code_cim10", "libelle"))
        )

    @cached_property
    def hot_stays(self) -> dict[int, int]:
        """Stays with very many lines, found once for codes and procedures alike."""
        return heat(self.given.lineitem.select(text("l_orderkey").alias("stay_id")), ["stay_id"])

    @cached_property
    def bronze_actes(self) -> DataFrame:
        return self.given.lineitem.select(
            text("l_orderkey").alias("stay_id"),
            text("l_partkey").alias("code_ccam"),
            F.col("l_shipdate").cast("timestamp").alias("acte_ts"),
        )

    @cached_property
    def ref_ccam(self) -> DataFrame:
        """Parts up to size 45 with their price in cents; larger ones are unknown codes."""
        return self.given.part.filter(F.col("p_size") <= 45).select(
            text("p_partkey").alias("code_ccam"),
            F.col("p_name").alias("libelle"),
            F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("tarif_euros"),
        )

    @cached_property
    def bronze_patients(self) -> DataFrame:
        """Each order is a version of its customer; the order key breaks same-day ties."""
        year = F.lit(1880) + F.floor(F.col("o_totalprice") / 3000).cast("int")
        return self.given.orders.select(
            text("o_custkey").alias("patient_hash"),
            F.when(F.col("o_orderstatus") != "P", year).alias("birth_year"),
            chosen(F.col("o_orderpriority"), SEX_BY_PRIORITY).alias("sex"),
            F.col("o_orderstatus").alias("region_code"),
            F.to_date("o_orderdate").alias("business_date"),
            F.col("o_orderkey").alias("version_seq"),
        )

    @cached_property
    def patients(self) -> silver.Cleaned:
        return silver.patients(self.bronze_patients, AS_OF_YEAR, ("business_date", "version_seq"))

    @cached_property
    def services(self) -> silver.Cleaned:
        return silver.services(self.ref_services, self.ref_service_desc)

    @cached_property
    def sejours(self) -> silver.Cleaned:
        return silver.sejours(self.bronze_sejours, self.ref_services)

    @cached_property
    def diagnostics(self) -> silver.Cleaned:
        return silver.diagnostics(
            self.bronze_diagnostics, self.bronze_sejours, self.ref_cim10, self.hot_stays
        )

    @cached_property
    def actes(self) -> silver.Cleaned:
        return silver.actes(self.bronze_actes, self.bronze_sejours, self.ref_ccam, self.hot_stays)

    @cached_property
    def dim_service(self) -> DataFrame:
        return self.services.kept

    @cached_property
    def dim_cim10(self) -> DataFrame:
        return silver.pathologies(self.ref_cim10, self.diagnostics.kept)

    @cached_property
    def dim_ccam(self) -> DataFrame:
        return silver.ccam(self.ref_ccam, self.actes.kept)

    @cached_property
    def dim_patient(self) -> DataFrame:
        return gold.dim_patient(self.patients.kept, self.sejours.kept)

    @cached_property
    def fact_sejour(self) -> DataFrame:
        """One order is one stay, so no stay is hot on this side of the join."""
        return gold.fact_sejour(self.sejours.kept, self.diagnostics.kept, hot=[])

    @cached_property
    def stay_measures(self) -> DataFrame:
        return gold.stay_measures(self.sejours.kept)

    @cached_property
    def fact_acte(self) -> DataFrame:
        """Priced from the whole reference: for codes that occur, it equals its observed part."""
        return gold.fact_acte(self.actes.kept, self.ref_ccam)
