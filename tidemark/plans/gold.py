"""Gold: the star schema. Dimensions copy silver references; facts carry their measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coding import age_band, flag
from tidemark.functions.numbers import half_even
from tidemark.functions.timestamps import day
from tidemark.operators.linking import lookup, with_defaults
from tidemark.operators.skew import heat, link
from tidemark.plans.model import EMERGENCY_MODE, PRINCIPAL


def reference_year(silver_sejours: DataFrame) -> DataFrame:
    """Year of the last admission: ages stay the same whenever they are computed."""
    return silver_sejours.agg(F.year(F.max("admission_ts")).alias("reference_year"))


def dim_patient(silver_patients: DataFrame, silver_sejours: DataFrame) -> DataFrame:
    age = reference_year(silver_sejours).scalar() - F.col("birth_year")
    return silver_patients.select(
        "patient_hash", "sex", "region_code", age.alias("age_years")
    ).withColumn("age_band", age_band(F.col("age_years")))


def principal_codes(silver_diagnostics: DataFrame) -> DataFrame:
    """One principal code per stay; the smallest when several are recorded."""
    return (
        silver_diagnostics.filter(F.col("type") == PRINCIPAL)
        .groupBy("stay_id")
        .agg(F.min("code_cim10").alias("diag_principal"))
    )


def stay_measures(silver_sejours: DataFrame) -> DataFrame:
    """Valid stays with their durations and flags; identical copies count once."""
    return silver_sejours.distinct().select(
        "stay_id",
        "patient_hash",
        "service_code",
        day(F.col("admission_ts")).alias("admission_date"),
        "admission_ts",
        "discharge_ts",
        "admission_mode",
        "discharge_mode",
        "los_hours",
        half_even(F.col("los_hours") / 24, 2).alias("los_days"),
        flag(F.col("discharge_ts").isNotNull()).alias("is_closed"),
        flag(F.col("admission_mode") == EMERGENCY_MODE).alias("is_urgence"),
    )


def fact_sejour(
    silver_sejours: DataFrame, silver_diagnostics: DataFrame, hot: Mapping[int, int] | Sequence[int] | None = None
) -> DataFrame:
    """One row per valid stay with its principal code, '' when it has none.

    Diagnoses are reduced to one row per stay before the join, so it cannot fan out. One
    shuffle by stay serves both merging copies and the join; only when some stay is hot are
    copies merged on their own first, before the shuffle.
    """
    hot = heat(silver_sejours, ["stay_id"]) if hot is None else hot
    stays = silver_sejours if hot else silver_sejours.repartition("stay_id")
    principal = principal_codes(silver_diagnostics)
    coded = link(stay_measures(stays), principal, "stay_id", "left", hot)
    return with_defaults(coded, {"diag_principal": ""})


def fact_acte(
    silver_actes: DataFrame, dim_ccam: DataFrame, carried: Sequence[str] = ()
) -> DataFrame:
    """One row per procedure with its tariff; a code without tariff counts 0."""
    priced = lookup(silver_actes, dim_ccam.select("code_ccam", "tarif_euros"), "code_ccam")
    return with_defaults(priced, {"tarif_euros": 0}).select(
        "stay_id",
        "patient_hash",
        "service_code",
        "acte_date",
        "acte_ts",
        "code_ccam",
        F.col("tarif_euros").cast("bigint").alias("tarif_euros"),
        *carried,
    )
