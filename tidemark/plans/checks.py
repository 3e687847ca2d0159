"""Reconciliation checks over the layers: each returns its violating rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.linking import only_known, only_unknown
from tidemark.operators.reconcile import expected_mismatch, scalar_mismatch, tagged, tagged_union
from tidemark.operators.measures import K_MIN
from tidemark.plans.model import DOUBLE, EMERGENCY_SERVICE, STRING, schema
from tidemark.plans.silver import vitals_rule
from tidemark.session import inline

Tables = Mapping[str, DataFrame]

# Rules that remove a stay.
DROPPING_STAY_RULES = (
    "sortie_avant_admission",
    "admission_ts_invalide",
    "duree_sejour_aberrante",
    "service_hors_referentiel",
)

# Published results of the frozen data set, with the tolerance of means.
GOLDEN = (
    ("readmission_30j_numerateur", 780.0, 0.0),
    ("readmission_30j_denominateur", 6729.0, 0.0),
    ("prevalence_N39", 2234.0, 0.0),
    ("prevalence_I50", 2156.0, 0.0),
    ("prevalence_E11", 2177.0, 0.0),
    ("dms_REA_nb_sejours", 423.0, 0.0),
    ("dms_REA_jours", 9.05, 0.1),
    ("dms_NEURO_jours", 7.06, 0.1),
    ("alertes_2026-08-01", 25.0, 0.0),
    ("releves_2026-08-01", 351.0, 0.0),
    ("urgences_2026-08-01_passages", 46.0, 0.0),
)


def rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def fact_vs_silver_sejours(fact_sejour: DataFrame, silver_sejours: DataFrame) -> DataFrame:
    return scalar_mismatch(rows(fact_sejour, "fact"), rows(silver_sejours, "silver_sejours"))


def sejours_conservation(silver: DataFrame, bronze: DataFrame, rejects: DataFrame) -> DataFrame:
    """Kept stays that bronze does not know, or that a dropping rule also rejected."""
    dropped = rejects.filter(
        (F.col("source") == "sejours") & F.col("rule").isin(*DROPPING_STAY_RULES)
    ).select(F.col("natural_key").alias("stay_id"))
    kept = silver.select("stay_id")
    return only_unknown(kept, bronze, "stay_id").unionByName(only_known(kept, dropped, "stay_id"))


def patients_dedup(bronze_patients: DataFrame, silver_patients: DataFrame) -> DataFrame:
    distinct = bronze_patients.agg(F.count_distinct("patient_hash").alias("bronze_distinct"))
    return scalar_mismatch(distinct, rows(silver_patients, "silver_patients"))


def kanonymat(prevalence: DataFrame, cohortes: DataFrame, k: int = K_MIN) -> DataFrame:
    below = F.col("nb_patients") < k
    cell = F.concat_ws("/", "code_cim10", "tranche_age", "sexe")
    n = F.col("nb_patients")
    return tagged_union(
        [
            tagged(prevalence.filter(below), "vue", "prevalence", {"cle": F.col("code_cim10"), "n": n}),
            tagged(cohortes.filter(below), "vue", "cohorte_age_sexe", {"cle": cell, "n": n}),
        ]
    )


def coherence_temporelle(silver_sejours: DataFrame) -> DataFrame:
    wrong = (F.col("los_hours") < 0) | (F.col("discharge_ts") < F.col("admission_ts"))
    return silver_sejours.filter(wrong).select("stay_id", "admission_ts", "discharge_ts", "los_hours")


def urgences_reconciliation(
    urgences_jour: DataFrame, fact_sejour: DataFrame, service: str = EMERGENCY_SERVICE
) -> DataFrame:
    total = urgences_jour.agg(F.coalesce(F.sum("nb_passages"), F.lit(0)).alias("kpi_total"))
    counted = fact_sejour.agg(F.count_if(F.col("service_code") == service).alias("fait_total"))
    return scalar_mismatch(total, counted)


def monitoring_borne(silver_monitoring: DataFrame) -> DataFrame:
    return silver_monitoring.filter(vitals_rule().fires)


def code_chain(
    facts: DataFrame, observed: DataFrame, reference: DataFrame, code: str, labels: tuple[str, str]
) -> DataFrame:
    """Codes of facts missing from the observed list, and of that list from the reference."""
    columns = {"code": F.col(code)}
    missing, foreign = labels
    return tagged_union(
        [
            tagged(only_unknown(facts.select(code), observed, code), "anomalie", missing, columns),
            tagged(only_unknown(observed.select(code), reference, code), "anomalie", foreign, columns),
        ]
    )


def pathologies_integrite(
    diagnostics: DataFrame, pathologies: DataFrame, ref_cim10: DataFrame
) -> DataFrame:
    labels = ("diag_sans_patho", "patho_hors_referentiel")
    return code_chain(diagnostics, pathologies, ref_cim10, "code_cim10", labels)


def ccam_integrite(actes: DataFrame, ccam: DataFrame, ref_ccam: DataFrame) -> DataFrame:
    labels = ("acte_sans_ccam", "ccam_hors_referentiel")
    return code_chain(actes, ccam, ref_ccam, "code_ccam", labels)


def golden_values(marts: Tables) -> DataFrame:
    """The published figures as (repere, obtenu), one row per figure that exists."""

    def figure(mart: str, repere, value: str) -> DataFrame:
        return marts[mart].select(repere.alias("repere"), F.col(value).cast("double").alias("obtenu"))

    readmission, dms = "kpi_pilotage_readmission_30j", "kpi_pilotage_dms"
    alerts = "kpi_pilotage_alertes_constantes"
    service = F.concat(F.lit("dms_"), "service_code")
    return tagged_union(
        [
            figure(readmission, F.lit("readmission_30j_numerateur"), "nb_readmissions_30j"),
            figure(readmission, F.lit("readmission_30j_denominateur"), "nb_sejours"),
            figure(
                "kpi_recherche_prevalence", F.concat(F.lit("prevalence_"), "code_cim10"), "nb_patients"
            ),
            figure(dms, F.concat(service, F.lit("_nb_sejours")), "nb_sejours"),
            figure(dms, F.concat(service, F.lit("_jours")), "dms_jours"),
            figure(alerts, F.concat(F.lit("alertes_"), F.col("jour").cast("string")), "nb_alertes"),
            figure(alerts, F.concat(F.lit("releves_"), F.col("jour").cast("string")), "nb_releves"),
            figure(
                "kpi_pilotage_urgences_jour",
                F.concat(F.lit("urgences_"), F.col("admission_date").cast("string"), F.lit("_passages")),
                "nb_passages",
            ),
        ]
    )


def golden_mismatch(marts: Tables, golden=GOLDEN) -> DataFrame:
    """Published figures that are missing or off; a missing row fails too."""
    actual = golden_values(marts)
    expected = inline(
        actual.sparkSession, golden, schema(repere=STRING, attendu=DOUBLE, tolerance=DOUBLE)
    )
    return expected_mismatch(expected, actual, "repere", "tolerance", "obtenu", "attendu").select(
        "repere", "obtenu", "attendu"
    )


def fact_acte_vs_silver(fact_acte: DataFrame, silver_actes: DataFrame) -> DataFrame:
    return scalar_mismatch(rows(fact_acte, "fact_acte"), rows(silver_actes, "silver_actes"))


def actes_service_provenance(fact_acte: DataFrame, fact_sejour: DataFrame) -> DataFrame:
    """Procedures whose service is not their stay's.

    (stay, service) pairs are made distinct before the join and counted, so repeats of a
    busy stay never meet in one task.
    """
    pairs = fact_acte.groupBy("stay_id", F.col("service_code").alias("service_acte")).agg(
        F.count("*").alias("nb_actes")
    )
    stays = fact_sejour.select("stay_id", F.col("service_code").alias("service_sejour"))
    return pairs.join(stays, "stay_id").filter("service_acte != service_sejour")


def all_checks(
    bronze: Tables,
    silver: Tables,
    gold: Tables,
    rejects: DataFrame,
    marts: Tables,
    golden=None,
    emergency_service: str = EMERGENCY_SERVICE,
) -> dict[str, DataFrame]:
    """The checks by name; the golden one only where its frozen data set is loaded."""
    prevalence, cohortes = marts["kpi_recherche_prevalence"], marts["kpi_recherche_cohorte_age_sexe"]
    checks = {
        "01_fact_vs_silver_sejours": fact_vs_silver_sejours(gold["fact_sejour"], silver["sejours"]),
        "02_sejours_conservation": sejours_conservation(
            silver["sejours"], bronze["sejours"], rejects
        ),
        "03_patients_dedup": patients_dedup(bronze["patients"], silver["patients"]),
        "04_kanonymat": kanonymat(prevalence, cohortes),
        "05_coherence_temporelle": coherence_temporelle(silver["sejours"]),
        "06_urgences_reconciliation": urgences_reconciliation(
            marts["kpi_pilotage_urgences_jour"], gold["fact_sejour"], emergency_service
        ),
        "07_monitoring_borne": monitoring_borne(silver["monitoring"]),
        "08_pathologies_integrite": pathologies_integrite(
            silver["diagnostics"], silver["pathologies"], bronze["ref_cim10"]
        ),
        "10_fact_acte_vs_silver": fact_acte_vs_silver(gold["fact_acte"], silver["actes"]),
        "11_actes_service_provenance": actes_service_provenance(
            gold["fact_acte"], gold["fact_sejour"]
        ),
        "12_ccam_integrite": ccam_integrite(silver["actes"], silver["ccam"], bronze["ref_ccam"]),
    }
    if golden is not None:
        checks["09_corrige_niveau1"] = golden_mismatch(marts, golden)
    return dict(sorted(checks.items()))
