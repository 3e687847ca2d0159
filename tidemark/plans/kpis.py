"""The marts. Facts are aggregated on their own key first; labels join the few groups left.

Every result is ordered as a reader expects it, with a unique last key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coding import text_or_blank
from tidemark.functions.numbers import half_even, percent, ratio
from tidemark.functions.timestamps import day
from tidemark.operators.linking import lookup
from tidemark.operators.measures import (
    K_MIN,
    followed_within,
    k_anonymous,
    next_event,
    share_of_total,
    subjects_per_group,
)
from tidemark.plans.model import ALERT, EMERGENCY_SERVICE, PRINCIPAL, RETURN_DAYS

def closed() -> Column:
    return F.col("is_closed") == 1


def labelled(grouped: DataFrame, reference: DataFrame, key: str, *labels: str) -> DataFrame:
    """Attach labels to grouped rows; a key without reference row gets ''."""
    joined = lookup(grouped, reference.select(key, *labels), key)
    return joined.withColumns({name: text_or_blank(F.col(name)) for name in labels})


def dms(fact_sejour: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Mean length of stay per service, closed stays only."""
    hours = F.col("los_hours")
    per_service = (
        fact_sejour.filter(closed() & hours.isNotNull())
        .groupBy("service_code")
        .agg(F.count("*").alias("nb_sejours"), F.avg(hours).alias("_mean"))
    )
    return (
        labelled(per_service, dim_service, "service_code", "service_label")
        .select(
            "service_code",
            "service_label",
            "nb_sejours",
            half_even(F.col("_mean") / 24, 2).alias("dms_jours"),
            half_even(F.col("_mean"), 1).alias("dms_heures"),
        )
        .orderBy(F.desc("dms_jours"), "service_code")
    )


def urgences_jour(fact_sejour: DataFrame, service: str = EMERGENCY_SERVICE) -> DataFrame:
    """Admissions of one service per day, how many are still in, mean hours of the others."""
    closed_hours = F.avg(F.when(F.col("discharge_ts").isNotNull(), F.col("los_hours")))
    return (
        fact_sejour.filter(F.col("service_code") == service)
        .groupBy("admission_date")
        .agg(
            F.count("*").alias("nb_passages"),
            F.count_if(F.col("discharge_ts").isNull()).alias("nb_encore_presents"),
            half_even(closed_hours, 1).alias("duree_moy_heures"),
        )
        .orderBy("admission_date")
    )


def readmission(
    fact_sejour: DataFrame, days: int = RETURN_DAYS, hot: Sequence[int] | None = None
) -> DataFrame:
    """Closed stays whose patient's next admission, open or not, is 0 to ``days`` days later."""
    ordered = next_event(
        fact_sejour.select("patient_hash", "stay_id", "admission_ts", "discharge_ts"),
        "patient_hash",
        "admission_ts",
        "stay_id",
        "prochaine_admission",
        hot,
    )
    again = followed_within(F.col("discharge_ts"), F.col("prochaine_admission"), days)
    returned, rate = f"nb_readmissions_{days}j", f"taux_readmission_{days}j_pct"
    return ordered.agg(F.count_if(again).alias(returned), F.count("*").alias("nb_sejours")).withColumn(
        rate, percent(F.col(returned), F.col("nb_sejours"), 2)
    )


def is_alert() -> Column:
    """Three-valued: a reading whose known vitals are all fine is not an alert."""
    return (
        (F.col("spo2") < ALERT["spo2_below"])
        | (F.col("heart_rate") < ALERT["heart_rate_below"])
        | (F.col("heart_rate") > ALERT["heart_rate_above"])
        | (F.col("temp_c") > ALERT["temp_c_above"])
    )


# Kept partials: what marts add up, by the columns ``carried`` (a drop date). A mart takes the
# facts or the partials made of them; a replaced date replaces its own partials only.


def alert_parts(silver_monitoring: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Readings and alerts per day."""
    return silver_monitoring.groupBy(*carried, day(F.col("ts")).alias("jour")).agg(
        F.count("*").alias("nb_releves"), F.count_if(is_alert()).alias("nb_alertes")
    )


def act_parts(fact_acte: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Procedures and their amount per service and code."""
    return fact_acte.groupBy(*carried, "service_code", "code_ccam").agg(
        F.count("*").alias("nb_actes"), F.sum("tarif_euros").alias("montant_euros")
    )


def patient_pairs(silver_diagnostics: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Who has which code: distinct counts are not sums, but pairs of several dates merge."""
    return silver_diagnostics.select(*carried, "code_cim10", "type", "patient_hash").distinct()


def acts_by(acts: DataFrame, key: str) -> DataFrame:
    """Procedures and their amount per key, from facts or their partials."""
    kept = "nb_actes" in acts.columns
    number = F.sum("nb_actes") if kept else F.count("*")
    amount = F.sum("montant_euros" if kept else "tarif_euros")
    return acts.groupBy(key).agg(number.alias("nb_actes"), amount.alias("montant_total_euros"))


def alertes_constantes(silver_monitoring: DataFrame) -> DataFrame:
    daily = (
        silver_monitoring.groupBy("jour").agg(*[F.sum(n).alias(n) for n in ("nb_releves", "nb_alertes")])
        if "nb_releves" in silver_monitoring.columns
        else alert_parts(silver_monitoring)
    )
    return (
        daily.withColumn("taux_alertes_pct", percent(F.col("nb_alertes"), F.col("nb_releves"), 1))
        .orderBy("jour")
    )


def mode_sortie(fact_sejour: DataFrame) -> DataFrame:
    per_mode = (
        fact_sejour.filter(closed())
        .groupBy(F.col("discharge_mode").alias("mode_sortie"))
        .agg(F.count("*").alias("nb_sejours"))
    )
    return share_of_total(per_mode, "nb_sejours", "part_pct").orderBy(
        F.desc("nb_sejours"), "mode_sortie"
    )


def charge_service(fact_sejour: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Admissions, open stays and patient-days per service.

    Patient-days are summed as whole hundredths: exact, whatever the order of addition.
    """
    hundredths = F.sum(F.rint(F.col("los_days") * 100).cast("bigint"))
    per_service = fact_sejour.groupBy("service_code").agg(
        F.count("*").alias("admissions"),
        F.count_if(~closed()).alias("sejours_en_cours"),
        half_even(hundredths / 100).alias("patients_jours"),
    )
    return (
        labelled(per_service, dim_service, "service_code", "service_label")
        .select("service_code", "service_label", "admissions", "sejours_en_cours", "patients_jours")
        .orderBy(F.desc("admissions"), "service_code")
    )


def prevalence(silver_diagnostics: DataFrame, dim_cim10: DataFrame, k: int = K_MIN) -> DataFrame:
    """Distinct patients per code over all diagnoses; codes under ``k`` patients are masked."""
    per_code = k_anonymous(silver_diagnostics, ["code_cim10"], "patient_hash", "nb_patients", k)
    named = dim_cim10.select("code_cim10", F.col("libelle").alias("libelle_cim10"))
    return (
        labelled(per_code, named, "code_cim10", "libelle_cim10")
        .select("code_cim10", "libelle_cim10", "nb_patients")
        .orderBy(F.desc("nb_patients"), "code_cim10")
    )


def cohorte_age_sexe(
    silver_diagnostics: DataFrame, dim_patient: DataFrame, k: int = K_MIN
) -> DataFrame:
    """Distinct patients per principal code, age band and sex, cells under ``k`` masked.

    (code, patient) pairs are made distinct before they meet the patients, after which
    counting rows is counting patients.
    """
    pairs = (
        silver_diagnostics.filter(F.col("type") == PRINCIPAL)
        .select("code_cim10", "patient_hash")
        .distinct()
    )
    known = dim_patient.select(
        "patient_hash", F.col("age_band").alias("tranche_age"), F.col("sex").alias("sexe")
    )
    return (
        pairs.join(known, "patient_hash")
        .groupBy("code_cim10", "tranche_age", "sexe")
        .agg(F.count("*").alias("nb_patients"))
        .filter(F.col("nb_patients") >= k)
        .orderBy("code_cim10", "tranche_age", "sexe")
    )


def activite_categorie(fact_sejour: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Roll services up to categories from per-service totals; hours are whole, sums exact."""
    per_service = fact_sejour.groupBy("service_code").agg(
        F.count("*").alias("_n"),
        F.count_if(closed()).alias("_closed"),
        F.sum(F.when(closed(), F.col("los_hours"))).alias("_hours"),
        F.count(F.when(closed(), F.col("los_hours"))).alias("_timed"),
    )
    mean = ratio(F.sum("_hours"), F.sum("_timed"))
    return (
        labelled(per_service, dim_service, "service_code", "categorie")
        .groupBy("categorie")
        .agg(
            F.sum("_n").alias("nb_sejours"),
            F.sum("_closed").alias("nb_sejours_clos"),
            half_even(mean / 24, 2).alias("dms_jours"),
        )
        .orderBy(F.desc("nb_sejours"), "categorie")
    )


def actes_service(fact_acte: DataFrame, fact_sejour: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Procedures per service and per stay: two facts, each aggregated before they meet."""
    acts = acts_by(fact_acte, "service_code").drop("montant_total_euros")
    stays = fact_sejour.groupBy("service_code").agg(F.count("*").alias("nb_sejours"))
    joined = acts.join(stays, "service_code", "left").na.fill(0, ["nb_sejours"])
    return (
        labelled(joined, dim_service, "service_code", "service_label")
        .select(
            "service_code",
            "service_label",
            "nb_actes",
            "nb_sejours",
            half_even(ratio(F.col("nb_actes"), F.col("nb_sejours")), 2).alias("actes_par_sejour"),
        )
        .orderBy(F.desc("nb_actes"), "service_code")
    )


def actes_type(fact_acte: DataFrame, dim_ccam: DataFrame) -> DataFrame:
    per_code = acts_by(fact_acte, "code_ccam")
    return (
        labelled(share_of_total(per_code, "nb_actes", "part_pct"), dim_ccam, "code_ccam", "libelle")
        .select("code_ccam", "libelle", "nb_actes", "part_pct")
        .orderBy(F.desc("nb_actes"), "code_ccam")
    )


def densite_actes_lit(fact_acte: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Procedures per bed; a service without known beds has none and comes last."""
    acts = acts_by(fact_acte, "service_code")
    beds = dim_service.select("service_code", "service_label", "capacite_lits")
    return (
        lookup(acts, beds, "service_code")
        .select(
            "service_code",
            text_or_blank(F.col("service_label")).alias("service_label"),
            "capacite_lits",
            "nb_actes",
            half_even(ratio(F.col("nb_actes"), F.col("capacite_lits")), 1).alias("actes_par_lit"),
        )
        .orderBy(F.desc_nulls_last("actes_par_lit"), "service_code")
    )


def montant_t2a(fact_acte: DataFrame, dim_service: DataFrame) -> DataFrame:
    billed = acts_by(fact_acte, "service_code")
    mean = ratio(F.col("montant_total_euros"), F.col("nb_actes"))
    return (
        labelled(billed, dim_service, "service_code", "service_label")
        .select(
            "service_code",
            "service_label",
            "nb_actes",
            "montant_total_euros",
            half_even(mean, 2).alias("tarif_moyen_euros"),
        )
        .orderBy(F.desc("montant_total_euros"), "service_code")
    )


def pyramide(cohortes: DataFrame) -> DataFrame:
    """Age by sex from the published cells only: masked cells stay masked, and a patient
    counts once per code."""
    return (
        cohortes.groupBy("tranche_age", "sexe")
        .agg(F.sum("nb_patients").alias("nb_patients"))
        .orderBy("tranche_age", "sexe")
    )


def unmasked_prevalence(silver_diagnostics: DataFrame, dim_cim10: DataFrame) -> DataFrame:
    """For administrators; on no audience's list."""
    return prevalence(silver_diagnostics, dim_cim10, k=1)


def rare_codes(silver_diagnostics: DataFrame, dim_cim10: DataFrame, k: int = K_MIN) -> DataFrame:
    """For administrators: the codes the published prevalence masks."""
    counted = subjects_per_group(silver_diagnostics, ["code_cim10"], "patient_hash", "nb_patients")
    named = dim_cim10.select("code_cim10", F.col("libelle").alias("libelle_cim10"))
    return (
        labelled(counted.filter(F.col("nb_patients") < k), named, "code_cim10", "libelle_cim10")
        .select("code_cim10", "libelle_cim10", "nb_patients")
        .orderBy("nb_patients", "code_cim10")
    )


def marts(
    gold: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    k: int = K_MIN,
    emergency_service: str = EMERGENCY_SERVICE,
) -> dict[str, DataFrame]:
    """The thirteen marts by name."""
    stays, acts = gold["fact_sejour"], gold["fact_acte"]
    services, codes = gold["dim_service"], gold["dim_ccam"]
    return {
        "kpi_pilotage_dms": dms(stays, services),
        "kpi_pilotage_urgences_jour": urgences_jour(stays, emergency_service),
        "kpi_pilotage_readmission_30j": readmission(stays),
        "kpi_pilotage_alertes_constantes": alertes_constantes(silver["monitoring"]),
        "kpi_pilotage_mode_sortie": mode_sortie(stays),
        "kpi_pilotage_charge_service": charge_service(stays, services),
        "kpi_pilotage_activite_categorie": activite_categorie(stays, services),
        "kpi_pilotage_actes_service": actes_service(acts, stays, services),
        "kpi_pilotage_actes_type": actes_type(acts, codes),
        "kpi_pilotage_densite_actes_lit": densite_actes_lit(acts, services),
        "kpi_pilotage_montant_t2a": montant_t2a(acts, services),
        "kpi_recherche_prevalence": prevalence(silver["diagnostics"], gold["dim_cim10"], k),
        "kpi_recherche_cohorte_age_sexe": cohorte_age_sexe(
            silver["diagnostics"], gold["dim_patient"], k
        ),
    }


# Each dashboard card's mart, columns, order ("-" is descending, NULLs last)
# and row limit.
CARDS = {
    "DMS par service (jours)": (
        "kpi_pilotage_dms",
        ["service_label", "dms_jours"],
        ["-dms_jours", "service_label"],
        None,
    ),
    "Passages aux urgences par jour": (
        "kpi_pilotage_urgences_jour",
        ["admission_date", "nb_passages", "nb_encore_presents"],
        ["admission_date"],
        None,
    ),
    "Taux de réadmission à 30 jours (%)": (
        "kpi_pilotage_readmission_30j",
        ["taux_readmission_30j_pct"],
        [],
        None,
    ),
    "Relevés de constantes en alerte par jour": (
        "kpi_pilotage_alertes_constantes",
        ["jour", "nb_alertes", "taux_alertes_pct"],
        ["jour"],
        None,
    ),
    "Charge par service (patients-jours)": (
        "kpi_pilotage_charge_service",
        ["service_label", "admissions", "patients_jours"],
        ["-patients_jours", "service_label"],
        None,
    ),
    "Répartition des modes de sortie": (
        "kpi_pilotage_mode_sortie",
        ["mode_sortie", "nb_sejours"],
        ["-nb_sejours", "mode_sortie"],
        None,
    ),
    "Prévalence par pathologie (cohortes ≥ 5)": (
        "kpi_recherche_prevalence",
        ["libelle_cim10", "nb_patients"],
        ["-nb_patients", "libelle_cim10"],
        15,
    ),
    "Activité et DMS par catégorie de service": (
        "kpi_pilotage_activite_categorie",
        ["categorie", "nb_sejours", "dms_jours"],
        ["-nb_sejours", "categorie"],
        None,
    ),
    "Nombre d'actes par service": (
        "kpi_pilotage_actes_service",
        ["service_label", "nb_actes", "actes_par_sejour"],
        ["-nb_actes", "service_label"],
        None,
    ),
    "Répartition des actes par type": (
        "kpi_pilotage_actes_type",
        ["libelle", "nb_actes"],
        ["-nb_actes", "libelle"],
        None,
    ),
    "Densité d'actes par lit": (
        "kpi_pilotage_densite_actes_lit",
        ["service_label", "actes_par_lit"],
        ["-actes_par_lit", "service_label"],
        None,
    ),
    "Montant facturé par service (T2A)": (
        "kpi_pilotage_montant_t2a",
        ["service_label", "montant_total_euros"],
        ["-montant_total_euros", "service_label"],
        None,
    ),
}
PYRAMID_CARD = "Description de cohorte : âge × sexe"


def card(name: str, published: dict[str, DataFrame]) -> DataFrame:
    """One dashboard card, from the published marts alone."""
    if name == PYRAMID_CARD:
        return pyramide(published["kpi_recherche_cohorte_age_sexe"])
    mart, columns, order, limit = CARDS[name]
    chosen = published[mart]
    if order:
        chosen = chosen.orderBy(
            *[F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc_nulls_last(key) for key in order]
        )
    return (chosen.limit(limit) if limit else chosen).select(*columns)
