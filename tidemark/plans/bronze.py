"""Bronze: lake rows typed, nothing cleaned; unreadable values become NULL.

Text columns are never NULL here: a blank field is ''. Sources of events can carry columns of
the lake along, such as the drop date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coding import text_or_blank, within_or_null
from tidemark.functions.numbers import float_from_number, int_from_number, int_from_text
from tidemark.functions.timestamps import parse_timestamp, to_second
from tidemark.operators.dedupe import latest_per_key

# Fixed value: the largest year the typed column holds.
MAX_YEAR = 65535


def blanks(*names: str) -> list:
    return [text_or_blank(F.col(name)).alias(name) for name in names]


def patients(lake: DataFrame) -> DataFrame:
    """Every dropped version of every patient, with its drop date."""
    return lake.select(
        "patient_hash",
        within_or_null(int_from_text(F.col("birth_year")), 0, MAX_YEAR).alias("birth_year"),
        *blanks("sex", "region_code"),
        "business_date",
    )


def sejours(lake: DataFrame, *carried: str) -> DataFrame:
    return lake.select(
        *blanks("stay_id", "patient_hash", "service_code"),
        parse_timestamp(F.col("admission_ts")).alias("admission_ts"),
        parse_timestamp(F.col("discharge_ts")).alias("discharge_ts"),
        *blanks("admission_mode", "discharge_mode"),
        *carried,
    )


def monitoring(lake: DataFrame, *carried: str) -> DataFrame:
    return lake.select(
        *blanks("stay_id"),
        to_second(F.col("ts")).alias("ts"),
        int_from_number(F.col("heart_rate")).alias("heart_rate"),
        int_from_number(F.col("spo2")).alias("spo2"),
        float_from_number(F.col("temp_c")).alias("temp_c"),
        *carried,
    )


def diagnostics(lake: DataFrame, *carried: str) -> DataFrame:
    """One row per coded diagnosis; a stay with an empty list gives none."""
    return lake.select("stay_id", F.explode("diagnostics").alias("_d"), *carried).select(
        *blanks("stay_id"),
        text_or_blank(F.col("_d.code_cim10")).alias("code_cim10"),
        text_or_blank(F.col("_d.type")).alias("type"),
        *carried,
    )


def actes(lake: DataFrame, *carried: str) -> DataFrame:
    return lake.select(
        *blanks("stay_id", "code_ccam"), to_second(F.col("acte_ts")).alias("acte_ts"), *carried
    )


def one_per_code(typed: DataFrame) -> DataFrame:
    """A reference dropped again, whole or in part, counts once per code, as last dropped."""
    key, *columns = (name for name in typed.columns if name != "business_date")
    return latest_per_key(typed, key, ["business_date"], columns)


def ref_services(lake: DataFrame) -> DataFrame:
    return one_per_code(lake.select(*blanks("service_code", "service_label"), "business_date"))


def ref_cim10(lake: DataFrame) -> DataFrame:
    return one_per_code(lake.select(*blanks("code_cim10", "libelle"), "business_date"))


def ref_service_desc(lake: DataFrame) -> DataFrame:
    return one_per_code(
        lake.select(
            *blanks("service_code", "categorie"),
            int_from_text(F.col("capacite_lits")).alias("capacite_lits"),
            *blanks("pole"),
            "business_date",
        )
    )


def ref_ccam(lake: DataFrame) -> DataFrame:
    return one_per_code(
        lake.select(
            *blanks("code_ccam", "libelle"),
            int_from_text(F.col("tarif_euros"), "bigint").alias("tarif_euros"),
            "business_date",
        )
    )


# Table name, drop file it comes from, how it is typed.
TABLES = {
    "patients": ("patients", patients),
    "sejours": ("sejours", sejours),
    "monitoring": ("monitoring", monitoring),
    "diagnostics": ("diagnostics", diagnostics),
    "actes": ("actes", actes),
    "ref_services": ("services", ref_services),
    "ref_cim10": ("cim10", ref_cim10),
    "ref_service_desc": ("description_service", ref_service_desc),
    "ref_ccam": ("ccam", ref_ccam),
}
