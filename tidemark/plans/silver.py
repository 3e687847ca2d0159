"""Silver: cleaned, deduplicated, linked rows, and what each rule rejected."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coding import SEX_SYNONYMS, any_of, normalise_code, outside, within_or_null
from tidemark.functions.numbers import number_text
from tidemark.functions.timestamps import calendar_days, day, hours_between, second_text
from tidemark.operators import quality
from tidemark.operators.dedupe import latest_per_key, latest_state
from tidemark.operators.linking import enrich_with_gaps, mark_known, observed_codes
from tidemark.operators.quality import Rule
from tidemark.operators.skew import heat, link
from tidemark.plans.model import (
    DETAILS,
    FIRST_BIRTH_YEAR,
    MAX_STAY_DAYS,
    NOT_DESCRIBED,
    PLAUSIBLE,
)


class Cleaned:
    """A silver table and the journal rows of its source, each planned when first used."""

    def __init__(self, kept: Callable[[], DataFrame], rejects: Callable[[], DataFrame]) -> None:
        self._kept, self._rejects = kept, rejects

    @cached_property
    def kept(self) -> DataFrame:
        return self._kept()

    @cached_property
    def rejects(self) -> DataFrame:
        return self._rejects()


def patient_columns() -> dict[str, Column]:
    return {
        "birth_year": F.col("birth_year"),
        "sex": normalise_code(F.col("sex"), SEX_SYNONYMS),
        "region_code": F.col("region_code"),
    }


def patient_state(bronze: DataFrame, version: Sequence[str] = ("business_date",)) -> DataFrame:
    """The newest known values of each patient and the drops they are from."""
    return latest_state(bronze, "patient_hash", version, patient_columns())


def patients(
    bronze: DataFrame, as_of_year: int, version: Sequence[str] = ("business_date",)
) -> Cleaned:
    """One row per patient from the newest known values.

    Years out of range are blanked and unknown sexes left '': both are journalled, the
    row stays.
    """
    return judged_patients(latest_per_key(bronze, "patient_hash", version, patient_columns()), as_of_year)


def judged_patients(newest: DataFrame, as_of_year: int) -> Cleaned:
    """``patients`` from the newest values, however they were kept."""
    year = F.col("birth_year")
    rules = [
        Rule(
            "sex_non_normalise",
            F.col("sex") == "",
            F.lit(DETAILS["sex_non_normalise"]),
            drops=False,
        ),
        Rule(
            "birth_year_aberrant",
            outside(year, FIRST_BIRTH_YEAR, as_of_year),
            F.concat(F.lit("birth_year="), year.cast("string")),
            drops=False,
        ),
    ]
    plausible = within_or_null(year, FIRST_BIRTH_YEAR, as_of_year)
    return Cleaned(
        lambda: newest.withColumn("birth_year", plausible).select(
            "patient_hash", "birth_year", "sex", "region_code"
        ),
        lambda: quality.rejects(newest, rules, "patients", F.col("patient_hash")),
    )


def services(ref_services: DataFrame, ref_service_desc: DataFrame) -> Cleaned:
    """Every listed service; one without description is kept, labelled and journalled."""
    table = enrich_with_gaps(
        ref_services,
        ref_service_desc,
        "service_code",
        labels=["categorie", "pole"],
        values=["capacite_lits"],
        described="is_described",
        missing=NOT_DESCRIBED,
    ).select("service_code", "service_label", "categorie", "capacite_lits", "pole", "is_described")
    rule = Rule(
        "service_sans_description",
        F.col("is_described") == 0,
        F.lit(DETAILS["service_sans_description"]),
        drops=False,
    )
    return Cleaned(
        lambda: table,
        lambda: quality.rejects(table, [rule], "referentiels", F.col("service_code")),
    )


def stay_rules() -> list[Rule]:
    """Rules of a stay whose ``_service_known`` mark is set."""
    admission, discharge = F.col("admission_ts"), F.col("discharge_ts")
    days = calendar_days(admission, discharge)
    return [
        Rule("admission_ts_invalide", admission.isNull(), F.lit(DETAILS["admission_ts_invalide"])),
        Rule(
            "sortie_avant_admission",
            discharge < admission,
            F.concat(
                F.lit("discharge="), second_text(discharge), F.lit(" < admission="), second_text(admission)
            ),
        ),
        Rule(
            "duree_sejour_aberrante",
            (discharge >= admission) & (days > MAX_STAY_DAYS),
            F.concat(F.lit("los="), days.cast("string"), F.lit(" j")),
        ),
        Rule(
            "service_hors_referentiel",
            admission.isNotNull() & ~F.col("_service_known"),
            F.col("service_code"),
        ),
    ]


def sejours(bronze: DataFrame, ref_services: DataFrame, carried: Sequence[str] = ()) -> Cleaned:
    """Stays with coherent dates and a known service; open stays are legitimate."""
    marked = mark_known(bronze, ref_services, "service_code", "_service_known")
    los = hours_between(F.col("admission_ts"), F.col("discharge_ts")).cast("double")
    return Cleaned(
        lambda: quality.kept(marked, stay_rules()).select(
            "stay_id",
            "patient_hash",
            "service_code",
            "admission_ts",
            "discharge_ts",
            "admission_mode",
            "discharge_mode",
            los.alias("los_hours"),
            *carried,
        ),
        lambda: quality.rejects(
            marked, stay_rules(), "sejours", F.col("stay_id"), carried=carried
        ),
    )


def vitals_rule() -> Rule:
    hr, spo2, temp = (F.col(name) for name in PLAUSIBLE)
    detail = F.concat(
        F.lit("hr="),
        hr.cast("string"),
        F.lit(" spo2="),
        spo2.cast("string"),
        F.lit(" temp="),
        number_text(temp),
    )
    broken = any_of([outside(F.col(name), low, high) for name, (low, high) in PLAUSIBLE.items()])
    return Rule("hors_plage_physiologique", broken, detail)


def monitoring(bronze: DataFrame, carried: Sequence[str] = ()) -> Cleaned:
    """Readings with no known vital out of range; they are never tied to a stay."""
    key = F.concat("stay_id", F.lit("@"), second_text(F.col("ts")))
    return Cleaned(
        lambda: quality.kept(bronze, [vitals_rule()]),
        lambda: quality.rejects(bronze, [vitals_rule()], "monitoring", key, carried=carried),
    )


def coded_facts(
    bronze: DataFrame,
    stays: DataFrame,
    reference: DataFrame,
    code: str,
    source: str,
    from_stay: Sequence[str],
    hot: Mapping[int, int] | Sequence[int] | None = None,
    carried: Sequence[str] = (),
) -> Cleaned:
    """Facts of a stay that exists, with a known code, plus columns of the stay.

    The stays are the *bronze* ones: a stay dropped for its dates still happened. Unknown
    codes are journalled before the link, so a repeated stay cannot repeat them. Orphans
    are found by an anti-join of two narrow columns, cheaper than staging the linked facts.
    ``hot`` (see ``skew.heat``) is looked for when a table is first used, unless given.
    """
    marked = mark_known(bronze, reference, code, "_code_known")
    parents = stays.select("stay_id", *from_stay)
    unknown_code = Rule(f"{code}_hors_referentiel", ~F.col("_code_known"), F.col(code))
    unknown_stay = Rule("sejour_inconnu", F.lit(True), F.col(code))

    @cache
    def heavy() -> Mapping[int, int] | Sequence[int]:
        return heat(bronze, ["stay_id"]) if hot is None else hot

    def kept() -> DataFrame:
        known = quality.kept(marked, [unknown_code]).drop("_code_known")
        return link(known, parents, "stay_id", "inner", heavy())

    def rejects() -> DataFrame:
        given = bronze.select("stay_id", code, *carried)
        orphans = link(given, parents.select("stay_id"), "stay_id", "left_anti", heavy())
        return quality.journal(
            [
                quality.rejects(rows, [rule], source, F.col("stay_id"), carried=carried)
                for rows, rule in ((orphans, unknown_stay), (marked, unknown_code))
            ]
        )

    return Cleaned(kept, rejects)


def diagnostics(
    bronze: DataFrame,
    bronze_sejours: DataFrame,
    ref_cim10: DataFrame,
    hot: Mapping[int, int] | Sequence[int] | None = None,
    carried: Sequence[str] = (),
) -> Cleaned:
    cleaned = coded_facts(
        bronze, bronze_sejours, ref_cim10, "code_cim10", "diagnostics", ["patient_hash"], hot, carried
    )
    columns = ["stay_id", "patient_hash", "code_cim10", "type", *carried]
    return Cleaned(lambda: cleaned.kept.select(*columns), lambda: cleaned.rejects)


def actes(
    bronze: DataFrame,
    bronze_sejours: DataFrame,
    ref_ccam: DataFrame,
    hot: Mapping[int, int] | Sequence[int] | None = None,
    carried: Sequence[str] = (),
) -> Cleaned:
    """Procedures take their service from the stay, here and only here."""
    from_stay = ["patient_hash", "service_code"]
    cleaned = coded_facts(
        bronze, bronze_sejours, ref_ccam, "code_ccam", "actes", from_stay, hot, carried
    )
    return Cleaned(
        lambda: cleaned.kept.select(
            "stay_id",
            "patient_hash",
            "service_code",
            "code_ccam",
            "acte_ts",
            day(F.col("acte_ts")).alias("acte_date"),
            *carried,
        ),
        lambda: cleaned.rejects,
    )


def pathologies(ref_cim10: DataFrame, silver_diagnostics: DataFrame) -> DataFrame:
    return observed_codes(ref_cim10, silver_diagnostics, "code_cim10").select("code_cim10", "libelle")


def ccam(ref_ccam: DataFrame, silver_actes: DataFrame) -> DataFrame:
    return observed_codes(ref_ccam, silver_actes, "code_ccam").select(
        "code_ccam", "libelle", "tarif_euros"
    )
