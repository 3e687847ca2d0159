"""Marts, dashboard cards and layer builders over the bound tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.catalogue import oracle as o
from tidemark.catalogue.bindings import AS_OF_YEAR
from tidemark.catalogue.registry import Inputs, query
from tidemark.operators.dedupe import merged_state
from tidemark.plans import gold, kpis, silver
from tidemark.sources import tables
from tidemark.sources.ingest import pseudonymise

SERVICE = "signup"
DROPPED = "business_date"
SALT = "tidemark-demo-salt"


@query("kpi_1_dms_by_service", o.sql(o.dms("ev_fact", "ev_services")))
def _(t: Inputs) -> DataFrame:
    return kpis.dms(t.activity.fact_sejour, t.activity.dim_service)


@query("kpi_2_passages_per_day", o.sql(o.urgences_jour("ev_fact", SERVICE)))
def _(t: Inputs) -> DataFrame:
    return kpis.urgences_jour(t.activity.fact_sejour, SERVICE)


@query("kpi_3_readmission_30d", o.sql(o.readmission("ev_fact", 30)))
def _(t: Inputs) -> DataFrame:
    return kpis.readmission(t.activity.fact_sejour, 30, t.activity.hot_patients)


@query("kpi_3_readmission_1d", o.sql(o.readmission("ev_fact", 1)))
def _(t: Inputs) -> DataFrame:
    return kpis.readmission(t.activity.fact_sejour, 1, t.activity.hot_patients)


@query("kpi_4_alerts_per_day", o.sql(o.alertes("mon_silver")))
def _(t: Inputs) -> DataFrame:
    return kpis.alertes_constantes(t.activity.monitoring.kept)


@query("kpi_5_discharge_share", o.sql(o.mode_sortie("ev_fact")))
def _(t: Inputs) -> DataFrame:
    return kpis.mode_sortie(t.activity.fact_sejour)


@query("kpi_6_load_by_service", o.sql(o.charge_service("ev_fact", "ev_services")))
def _(t: Inputs) -> DataFrame:
    return kpis.charge_service(t.activity.fact_sejour, t.activity.dim_service)


@query("kpi_7_prevalence_k5", o.sql(o.prevalence(5)))
def _(t: Inputs) -> DataFrame:
    return kpis.prevalence(t.clinic.diagnostics.kept, t.clinic.ref_cim10)


@query("kpi_8_cohort_k5", o.sql(o.cohorte(5)))
def _(t: Inputs) -> DataFrame:
    return kpis.cohorte_age_sexe(t.clinic.diagnostics.kept, t.clinic.dim_patient)


@query("kpi_9_activity_by_category", o.sql(o.ACTIVITE))
def _(t: Inputs) -> DataFrame:
    return kpis.activite_categorie(t.clinic.stay_measures, t.clinic.dim_service)


@query("kpi_10_acts_per_service", o.sql(o.ACTES_SERVICE))
def _(t: Inputs) -> DataFrame:
    return kpis.actes_service(t.clinic.fact_acte, t.clinic.stay_measures, t.clinic.dim_service)


@query("kpi_11_acts_by_type_share", o.sql(o.ACTES_TYPE))
def _(t: Inputs) -> DataFrame:
    return kpis.actes_type(t.clinic.fact_acte, t.clinic.ref_ccam)


@query("kpi_12_density_nulls_last", o.sql(o.DENSITE))
def _(t: Inputs) -> DataFrame:
    return kpis.densite_actes_lit(t.clinic.fact_acte, t.clinic.dim_service)


@query("kpi_13_billing_by_service", o.sql(o.MONTANT))
def _(t: Inputs) -> DataFrame:
    return kpis.montant_t2a(t.clinic.fact_acte, t.clinic.dim_service)


@query("kpi_14_cohort_pyramid", o.sql(o.PYRAMIDE))
def _(t: Inputs) -> DataFrame:
    return kpis.pyramide(kpis.cohorte_age_sexe(t.clinic.diagnostics.kept, t.clinic.dim_patient))


@query("kpi_16_unmasked_prevalence", o.sql(o.prevalence(1)))
def _(t: Inputs) -> DataFrame:
    return kpis.unmasked_prevalence(t.clinic.diagnostics.kept, t.clinic.ref_cim10)


RARE = 12


@query(
    "kpi_16_rare_codes",
    o.sql(
        f"""SELECT a.code_ccam AS code_cim10, coalesce(any_value(c.libelle), '') AS libelle_cim10,
                   count(DISTINCT patient_hash) AS nb_patients
            FROM cl_silver_actes a LEFT JOIN cl_dim_ccam c ON c.code_ccam = a.code_ccam
            GROUP BY 1 HAVING count(DISTINCT patient_hash) < {RARE}"""
    ),
)
def _(t: Inputs) -> DataFrame:
    codes = {"code_ccam": "code_cim10"}
    acts = t.clinic.actes.kept.withColumnsRenamed(codes)
    return kpis.rare_codes(acts, t.clinic.ref_ccam.withColumnsRenamed(codes), RARE)


# --- marts from partials kept by drop date ----------------------------------------------


def kept_by_date(t: Inputs, parts: DataFrame, part, days) -> DataFrame:
    """Partials of facts that carry a drop date, kept by it; those of ``days`` are first made of
    nothing, as if their facts had come late, and then replaced in one job."""
    path, given = t.scratch("parts"), F.col(DROPPED).isin(*days)
    tables.rebuild(part(parts.filter(~given), [DROPPED]), path, DROPPED)
    return tables.replace_slices(part(parts.filter(given), [DROPPED]), path, [DROPPED], days).drop(DROPPED)


WEEK = [date(2024, 1, day) for day in range(5, 12)]


@query("kpi_4_alerts_from_kept_parts", o.sql(o.alertes("mon_silver")))
def _(t: Inputs) -> DataFrame:
    readings = t.activity.monitoring.kept.withColumn(DROPPED, F.to_date("ts"))
    return kpis.alertes_constantes(kept_by_date(t, readings, kpis.alert_parts, WEEK))


@query("kpi_7_prevalence_from_kept_pairs", o.sql(o.prevalence(5)))
def _(t: Inputs) -> DataFrame:
    """Diagnoses of a patient lie in several drops; (code, patient) pairs of all dates merge."""
    day = F.date_add(F.lit(WEEK[0]), F.pmod(F.xxhash64("stay_id"), F.lit(10)).cast("int"))
    coded = t.clinic.diagnostics.kept.withColumn(DROPPED, F.coalesce(day, F.lit(WEEK[0])))
    return kpis.prevalence(kept_by_date(t, coded, kpis.patient_pairs, WEEK[:3]), t.clinic.ref_cim10)


@query("kpi_13_billing_from_kept_parts", o.sql(o.MONTANT))
def _(t: Inputs) -> DataFrame:
    acts = t.clinic.fact_acte.withColumn(DROPPED, F.trunc("acte_date", "year"))
    days = [date(1995, 1, 1), date(1997, 1, 1)]
    return kpis.montant_t2a(kept_by_date(t, acts, kpis.act_parts, days), t.clinic.dim_service)


# --- the mart each dashboard card reads, and the card itself ---------------------------


def mart(t: Inputs, name: str) -> DataFrame:
    """One clinic mart, planning nothing the mart does not need."""
    c = t.clinic
    plans = {
        "kpi_pilotage_dms": lambda: kpis.dms(c.stay_measures, c.dim_service),
        "kpi_pilotage_urgences_jour": lambda: kpis.urgences_jour(c.stay_measures, "1"),
        "kpi_pilotage_readmission_30j": lambda: kpis.readmission(c.stay_measures),
        "kpi_pilotage_alertes_constantes": lambda: kpis.alertes_constantes(t.activity.monitoring.kept),
        "kpi_pilotage_mode_sortie": lambda: kpis.mode_sortie(c.stay_measures),
        "kpi_pilotage_charge_service": lambda: kpis.charge_service(c.stay_measures, c.dim_service),
        "kpi_pilotage_activite_categorie": lambda: kpis.activite_categorie(
            c.stay_measures, c.dim_service
        ),
        "kpi_pilotage_actes_service": lambda: kpis.actes_service(
            c.fact_acte, c.stay_measures, c.dim_service
        ),
        "kpi_pilotage_actes_type": lambda: kpis.actes_type(c.fact_acte, c.ref_ccam),
        "kpi_pilotage_densite_actes_lit": lambda: kpis.densite_actes_lit(c.fact_acte, c.dim_service),
        "kpi_pilotage_montant_t2a": lambda: kpis.montant_t2a(c.fact_acte, c.dim_service),
        "kpi_recherche_prevalence": lambda: kpis.prevalence(c.diagnostics.kept, c.ref_cim10),
        "kpi_recherche_cohorte_age_sexe": lambda: kpis.cohorte_age_sexe(
            c.diagnostics.kept, c.dim_patient
        ),
    }
    return plans[name]()


def register_cards() -> None:
    for position, (name, (source, columns, order, limit)) in enumerate(kpis.CARDS.items(), 1):
        keys = [f"{key[1:]} DESC NULLS LAST" if key.startswith("-") else key for key in order]
        body = f"SELECT {', '.join(columns)} FROM ({o.MARTS[source]})"
        if order:
            body += f" ORDER BY {', '.join(keys)}"
        if limit:
            body += f" LIMIT {limit}"

        def run(t: Inputs, name=name, source=source) -> DataFrame:
            return kpis.card(name, {source: mart(t, source)})

        query(f"kpi_15_card_{position:02d}_{source.removeprefix('kpi_')}", o.sql(body))(run)


register_cards()


@query("kpi_15_card_13_pyramide", o.sql(o.PYRAMIDE))
def _(t: Inputs) -> DataFrame:
    name = "kpi_recherche_cohorte_age_sexe"
    return kpis.card(kpis.PYRAMID_CARD, {name: mart(t, name)})


# --- layer builders -------------------------------------------------------------------


@query("bld_1_patients", o.sql("SELECT * FROM cl_patients"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.patients.kept


@query("bld_1_patients_from_kept_state", o.sql("SELECT * FROM cl_patients"))
def _(t: Inputs) -> DataFrame:
    """The newest values of two thirds of the versions as a written state, into which the other
    third merges, whichever are newer."""
    version = ("business_date", "version_seq")
    part = F.pmod(F.xxhash64("version_seq"), F.lit(3))
    old = silver.patient_state(t.clinic.bronze_patients.filter(part > 0), version)
    kept = tables.rebuild(old, t.scratch("state"))
    new = silver.patient_state(t.clinic.bronze_patients.filter(part == 0), version)
    newest = merged_state(kept, new, "patient_hash").select("patient_hash", *silver.patient_columns())
    return silver.judged_patients(newest, AS_OF_YEAR).kept


@query("bld_2_services", o.sql("SELECT * FROM cl_dim_service"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.services.kept


@query("bld_3_stays_events", o.sql("SELECT * FROM ev_stays"))
def _(t: Inputs) -> DataFrame:
    return t.activity.sejours.kept


@query("bld_3_stays_orders", o.sql("SELECT * FROM cl_stays"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.sejours.kept


@query("bld_4_diagnostics", o.sql("SELECT * FROM cl_silver_diag"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.diagnostics.kept


@query("bld_5_procedures", o.sql("SELECT * FROM cl_silver_actes"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.actes.kept


@query("bld_6_observed_pathologies", o.sql("SELECT * FROM cl_dim_cim10"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.dim_cim10


@query("bld_6_observed_procedures", o.sql("SELECT * FROM cl_dim_ccam"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.dim_ccam


@query("bld_7_dim_patient", o.sql("SELECT * FROM cl_dim_patient"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.dim_patient


@query("bld_8_fact_stays", o.sql("SELECT * FROM cl_fact"))
def _(t: Inputs) -> DataFrame:
    return t.clinic.fact_sejour


@query("bld_9_fact_procedures", o.sql("SELECT * FROM cl_fact_acte"))
def _(t: Inputs) -> DataFrame:
    """The observed tariffs are a table first, as in the warehouse, so the lookup can be split."""
    return gold.fact_acte(t.clinic.actes.kept, tables.rebuild(t.clinic.dim_ccam, t.scratch("ccam")))


HASHED = f"substr(sha256('{SALT}:' || patient_id), 1, 16) AS patient_hash"


@query(
    "bld_10_pseudonymise_patients",
    o.sql(
        f"""SELECT {HASHED}, substr(birth_date, 1, 4) AS birth_year, sex, region_code, business_date
            FROM ev_patients"""
    ),
)
def _(t: Inputs) -> DataFrame:
    return pseudonymise(t.activity.raw_patients, SALT)


@query(
    "bld_10_pseudonymise_stays",
    o.sql(
        f"""SELECT stay_id, {HASHED}, service_code, admission_mode, discharge_mode
            FROM (SELECT *, patient_hash AS patient_id FROM ev_bronze) s"""
    ),
)
def _(t: Inputs) -> DataFrame:
    hidden = pseudonymise(t.activity.raw_sejours, SALT)
    return hidden.select("stay_id", "patient_hash", "service_code", "admission_mode", "discharge_mode")


@query(
    "crossing_pseudonyms_still_join",
    o.sql("SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_patients FROM ev"),
)
def _(t: Inputs) -> DataFrame:
    patients = pseudonymise(t.activity.raw_patients, SALT).select("patient_hash")
    stays = pseudonymise(t.activity.raw_sejours, SALT).select("patient_hash").distinct()
    return stays.join(patients, "patient_hash", "left_semi").agg(F.count("*").alias("n_patients"))
