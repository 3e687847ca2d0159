"""Quality rules and reconciliation checks over the bound tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from tidemark.catalogue import oracle as o
from tidemark.catalogue.registry import Inputs, query
from tidemark.functions.coding import SEX_SYNONYMS, normalise_code
from tidemark.operators import quality, reconcile
from tidemark.plans import checks, gold, kpis, silver
from tidemark.plans.model import LONG, STRING, schema
from tidemark.session import inline, side_by_side, written

WITHOUT_TIME = ("source", "natural_key", "rule", "detail")


def entries(rejected: DataFrame, rule: str | None = None) -> DataFrame:
    chosen = rejected.filter(F.col("rule") == rule) if rule else rejected
    return chosen.select(*WITHOUT_TIME)


PATIENT_REJECTS = """
    SELECT 'patients' AS source, patient_hash AS natural_key, 'sex_non_normalise' AS rule,
           'sexe vide après normalisation' AS detail
    FROM cl_newest WHERE sex = ''
    UNION ALL
    SELECT 'patients', patient_hash, 'birth_year_aberrant', 'birth_year=' || birth_year
    FROM cl_newest WHERE birth_year NOT BETWEEN 1900 AND 2001"""
SERVICE_REJECTS = """
    SELECT 'referentiels' AS source, service_code AS natural_key,
           'service_sans_description' AS rule,
           'service absent de description_service.csv — conservé, catégorie/pôle « (non décrit) »'
               AS detail
    FROM cl_dim_service WHERE is_described = 0"""
VITAL_REJECTS = f"""
    SELECT 'monitoring' AS source, stay_id || '@' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS natural_key,
           'hors_plage_physiologique' AS rule,
           coalesce('hr=' || heart_rate || ' spo2=' || spo2 || ' temp='
                    || regexp_replace(CAST(temp_c AS VARCHAR), '\\.0$', ''), '') AS detail
    FROM mon_bronze WHERE {o.OUT_OF_RANGE}"""


@query("rul_1_dedupe", o.sql("SELECT * FROM cl_newest"))
def _(t: Inputs) -> DataFrame:
    """Latest version per patient, before years out of range are blanked."""
    from tidemark.operators.dedupe import latest_per_key

    columns = {
        "birth_year": F.col("birth_year"),
        "sex": normalise_code(F.col("sex"), SEX_SYNONYMS),
        "region_code": F.col("region_code"),
    }
    return latest_per_key(
        t.clinic.bronze_patients, "patient_hash", ["business_date", "version_seq"], columns
    )


def rule_query(name: str, rule: str, rejects_sql: str, rejected) -> None:
    body = f"SELECT * FROM ({rejects_sql}) WHERE rule = '{rule}'"
    query(name, o.sql(body))(lambda t: entries(rejected(t), rule))


EV, CLINIC = "SELECT * FROM ev_rejects", "SELECT * FROM cl_stay_rejects"
DIAG, ACTS = "SELECT * FROM cl_diag_rejects", "SELECT * FROM cl_acte_rejects"

rule_query("rul_2_sex", "sex_non_normalise", PATIENT_REJECTS, lambda t: t.clinic.patients.rejects)
rule_query(
    "rul_3_birth_year", "birth_year_aberrant", PATIENT_REJECTS, lambda t: t.clinic.patients.rejects
)
rule_query(
    "rul_4_undescribed_service",
    "service_sans_description",
    SERVICE_REJECTS,
    lambda t: t.clinic.services.rejects,
)


def unreadable(t: Inputs) -> DataFrame:
    """Stays whose admission text names no day: here, those entered as an event type."""
    admission = F.when(F.col("admission_mode") != "urgence", F.col("admission_ts"))
    return t.activity.bronze_sejours.withColumn("admission_ts", admission)


@query(
    "rul_5_unreadable_admission",
    o.sql(
        """SELECT 'sejours' AS source, stay_id AS natural_key, 'admission_ts_invalide' AS rule,
                  'date/heure admission illisible' AS detail
           FROM ev_bronze WHERE admission_mode = 'urgence'"""
    ),
)
def _(t: Inputs) -> DataFrame:
    cleaned = silver.sejours(unreadable(t), t.activity.ref_services)
    return entries(cleaned.rejects, "admission_ts_invalide")


rule_query("rul_6_inverted_dates", "sortie_avant_admission", EV, lambda t: t.activity.sejours.rejects)
rule_query(
    "rul_7_too_long", "duree_sejour_aberrante", CLINIC, lambda t: t.clinic.sejours.rejects
)
rule_query(
    "rul_8_unknown_service", "service_hors_referentiel", EV, lambda t: t.activity.sejours.rejects
)


@query("rul_9_implausible_vitals", o.sql(VITAL_REJECTS))
def _(t: Inputs) -> DataFrame:
    return entries(t.activity.monitoring.rejects)


rule_query("rul_10_diagnosis_orphan", "sejour_inconnu", DIAG, lambda t: t.clinic.diagnostics.rejects)
rule_query(
    "rul_11_unknown_diagnosis",
    "code_cim10_hors_referentiel",
    DIAG,
    lambda t: t.clinic.diagnostics.rejects,
)
rule_query("rul_12_procedure_orphan", "sejour_inconnu", ACTS, lambda t: t.clinic.actes.rejects)
rule_query(
    "rul_13_unknown_procedure",
    "code_ccam_hors_referentiel",
    ACTS,
    lambda t: t.clinic.actes.rejects,
)

JOURNAL = " UNION ALL ".join(
    f"SELECT source, natural_key, rule, detail FROM ({part})"
    for part in (PATIENT_REJECTS, SERVICE_REJECTS, CLINIC, VITAL_REJECTS, DIAG, ACTS)
)


def clinic_journal(t: Inputs) -> DataFrame:
    c = t.clinic
    steps = (c.patients, c.services, c.sejours, t.activity.monitoring, c.diagnostics, c.actes)
    return quality.journal([step.rejects for step in steps])


@query("set_2_rejects_journal", o.sql(JOURNAL))
def _(t: Inputs) -> DataFrame:
    return entries(clinic_journal(t))


@query(
    "rul_14_rejects_summary",
    o.sql(f"SELECT source, rule, count(*) AS n FROM ({JOURNAL}) GROUP BY 1, 2"),
)
def _(t: Inputs) -> DataFrame:
    return quality.summary(clinic_journal(t))


# --- checks ---------------------------------------------------------------------------
# On sound tables a check returns nothing, so each is also shown on tables that break it.


def verdict(checked: dict[str, DataFrame]) -> DataFrame:
    return reconcile.report(checked)


def verdict_sql(**counts: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST(({body}) AS BIGINT) AS n_violations"
        for name, body in counts.items()
    )


DIFFER = "SELECT CASE WHEN ({0}) <> ({1}) THEN 1 ELSE 0 END"


@query(
    "chk_1_fact_vs_silver",
    o.sql(
        verdict_sql(
            sound=DIFFER.format("SELECT count(*) FROM ev_fact", "SELECT count(*) FROM ev_stays"),
            broken=DIFFER.format("SELECT count(*) FROM ev_fact", "SELECT count(*) FROM ev_bronze"),
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    a = t.activity
    return verdict(
        {
            "sound": checks.fact_vs_silver_sejours(a.fact_sejour, a.sejours.kept),
            "broken": checks.fact_vs_silver_sejours(a.fact_sejour, a.bronze_sejours),
        }
    )


@query(
    "chk_2_stays_conservation",
    o.sql(
        """SELECT stay_id FROM ev_bronze
           WHERE stay_id IN (SELECT natural_key FROM ev_rejects)
           UNION ALL
           SELECT stay_id FROM ev_bronze b
           WHERE NOT EXISTS (SELECT 1 FROM ev_stays s WHERE s.stay_id = b.stay_id)"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """Bronze taken as kept and silver as given: every rejected stay must be found twice."""
    a = t.activity
    return checks.sejours_conservation(a.bronze_sejours, a.sejours.kept, a.sejours.rejects)


@query(
    "chk_3_patients_dedup",
    o.sql(
        verdict_sql(
            sound=DIFFER.format(
                "SELECT count(DISTINCT patient_hash) FROM cl_versions",
                "SELECT count(*) FROM cl_patients",
            ),
            broken=DIFFER.format(
                "SELECT count(DISTINCT patient_hash) FROM cl_versions",
                "SELECT count(*) FROM cl_versions",
            ),
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    c = t.clinic
    return verdict(
        {
            "sound": checks.patients_dedup(c.bronze_patients, c.patients.kept),
            "broken": checks.patients_dedup(c.bronze_patients, c.bronze_patients),
        }
    )


@query(
    "chk_4_kanonymity",
    o.sql(
        f"""SELECT 'prevalence' AS vue, code_cim10 AS cle, nb_patients AS n
            FROM ({o.prevalence(1)}) WHERE nb_patients < 5
            UNION ALL
            SELECT 'cohorte_age_sexe', code_cim10 || '/' || tranche_age || '/' || sexe, nb_patients
            FROM ({o.cohorte(1)}) WHERE nb_patients < 5"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """On the unmasked marts, so that the small cells are there to be found."""
    c = t.clinic
    return checks.kanonymat(
        kpis.prevalence(c.diagnostics.kept, c.ref_cim10, 1),
        kpis.cohorte_age_sexe(c.diagnostics.kept, c.dim_patient, 1),
    )


@query(
    "chk_5_time_coherence",
    o.sql(
        f"""SELECT stay_id, admission_ts, discharge_ts,
                   CAST({o.hours('admission_ts', 'discharge_ts')} AS DOUBLE) AS los_hours
            FROM ev_bronze WHERE discharge_ts < admission_ts"""
    ),
)
def _(t: Inputs) -> DataFrame:
    from tidemark.functions.timestamps import hours_between

    los = hours_between(F.col("admission_ts"), F.col("discharge_ts")).cast("double")
    return checks.coherence_temporelle(t.activity.bronze_sejours.withColumn("los_hours", los))


@query(
    "chk_6_emergency_reconciliation",
    o.sql(
        verdict_sql(
            sound="SELECT 0",
            broken=DIFFER.format(
                "SELECT count(*) FROM ev_fact WHERE service_code = 'signup'",
                "SELECT count(*) FROM ev_fact WHERE service_code = 'view'",
            ),
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    fact = t.activity.fact_sejour
    daily = kpis.urgences_jour(fact, "signup")
    return verdict(
        {
            "sound": checks.urgences_reconciliation(daily, fact, "signup"),
            "broken": checks.urgences_reconciliation(daily, fact, "view"),
        }
    )


@query("chk_7_vitals_bounds", o.sql(f"SELECT stay_id, ts FROM mon_bronze WHERE {o.OUT_OF_RANGE}"))
def _(t: Inputs) -> DataFrame:
    return checks.monitoring_borne(t.activity.bronze_monitoring).select("stay_id", "ts")


@query(
    "chk_8_diagnosis_chain",
    o.sql(
        """SELECT anomalie, code, count(*) AS n FROM (
             SELECT 'diag_sans_patho' AS anomalie, code_cim10 AS code FROM cl_diag
             WHERE code_cim10 NOT IN (SELECT code_cim10 FROM cl_cim10)
             UNION ALL
             SELECT 'patho_hors_referentiel', code_cim10 FROM cl_cim10
             WHERE code_cim10 NOT IN (SELECT p_type FROM part)) GROUP BY 1, 2"""
    ),
)
def _(t: Inputs) -> DataFrame:
    c = t.clinic
    types = t.part.select(F.col("p_type").alias("code_cim10")).distinct()
    found = checks.pathologies_integrite(c.bronze_diagnostics, c.ref_cim10, types)
    return found.groupBy("anomalie", "code").agg(F.count("*").alias("n"))


GOLDEN_ROWS = (
    ("dms_view_nb_sejours", 1.0, 0.0),
    ("dms_click_jours", 0.0, 1000.0),
    ("readmission_30j_numerateur", 1.0, 0.0),
    ("urgences_1990-01-01_passages", 46.0, 0.0),
)


@query(
    "chk_9_golden_values",
    o.sql(
        f"""SELECT repere, obtenu, attendu FROM (
              SELECT 'dms_view_nb_sejours' AS repere,
                     (SELECT CAST(nb_sejours AS DOUBLE) FROM ({o.dms('ev_fact', 'ev_services')})
                      WHERE service_code = 'view') AS obtenu, CAST(1 AS DOUBLE) AS attendu
              UNION ALL
              SELECT 'readmission_30j_numerateur',
                     (SELECT CAST(nb_readmissions_30j AS DOUBLE) FROM ({o.readmission('ev_fact', 30)})),
                     CAST(1 AS DOUBLE)
              UNION ALL
              SELECT 'urgences_1990-01-01_passages', NULL, CAST(46 AS DOUBLE))"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """Wrong and missing figures are reported, one within its tolerance is not."""
    a = t.activity
    nothing = inline(t.spark, (), schema(code_cim10=STRING, nb_patients=LONG))
    marts = {
        "kpi_pilotage_dms": kpis.dms(a.fact_sejour, a.dim_service),
        "kpi_pilotage_readmission_30j": kpis.readmission(a.fact_sejour, hot=a.hot_patients),
        "kpi_pilotage_alertes_constantes": kpis.alertes_constantes(a.monitoring.kept),
        "kpi_pilotage_urgences_jour": kpis.urgences_jour(a.fact_sejour, "signup"),
        "kpi_recherche_prevalence": nothing,
    }
    return checks.golden_mismatch(marts, GOLDEN_ROWS)


@query(
    "chk_10_procedures_vs_silver",
    o.sql(
        verdict_sql(
            sound=DIFFER.format(
                "SELECT count(*) FROM cl_fact_acte", "SELECT count(*) FROM cl_silver_actes"
            ),
            broken=DIFFER.format(
                "SELECT count(*) FROM cl_fact_acte", "SELECT count(*) FROM cl_actes"
            ),
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    c = t.clinic
    return verdict(
        {
            "sound": checks.fact_acte_vs_silver(c.fact_acte, c.actes.kept),
            "broken": checks.fact_acte_vs_silver(c.fact_acte, c.bronze_actes),
        }
    )


@query(
    "chk_11_procedure_service",
    o.sql(
        """SELECT l.stay_id, l.service_acte, b.service_code AS service_sejour, count(*) AS nb_actes
           FROM (SELECT CAST(l_orderkey AS VARCHAR) AS stay_id,
                        CAST(s_nationkey AS VARCHAR) AS service_acte
                 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) l
           JOIN cl_measures b ON b.stay_id = l.stay_id
           WHERE l.service_acte <> b.service_code GROUP BY 1, 2, 3"""
    ),
)
def _(t: Inputs) -> DataFrame:
    """Procedures given their supplier's nation, which is seldom their stay's service."""
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("service_code")
    )
    acts = t.lineitem.join(suppliers, "l_suppkey").select(
        F.col("l_orderkey").cast("string").alias("stay_id"), "service_code"
    )
    return checks.actes_service_provenance(acts, t.clinic.stay_measures)


@query(
    "chk_12_procedure_chain",
    o.sql(
        """SELECT anomalie, code, count(*) AS n FROM (
             SELECT 'acte_sans_ccam' AS anomalie, code_ccam AS code FROM cl_actes
             WHERE code_ccam NOT IN (SELECT code_ccam FROM cl_ccam)
             UNION ALL
             SELECT 'ccam_hors_referentiel', code_ccam FROM cl_ccam
             WHERE tarif_euros >= 95000) GROUP BY 1, 2"""
    ),
)
def _(t: Inputs) -> DataFrame:
    c = t.clinic
    cheap = c.ref_ccam.filter(F.col("tarif_euros") < 95000)
    found = checks.ccam_integrite(c.bronze_actes, c.ref_ccam, cheap)
    return found.groupBy("anomalie", "code").agg(F.count("*").alias("n"))


def chain_sql(facts: str, observed: str, reference: str, code: str) -> str:
    return f"""SELECT (SELECT count(*) FROM {facts} WHERE {code} NOT IN (SELECT {code} FROM {observed}))
                    + (SELECT count(*) FROM {observed} WHERE {code} NOT IN (SELECT {code} FROM {reference}))"""


REPORTED = (
    ("readmission_30j_numerateur", -1.0, 0.0),
    ("dms_1_jours", 0.0, 1000.0),
    ("urgences_1990-01-01_passages", 46.0, 0.0),
)


def all_written(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Independent tables, written side by side."""
    tables = side_by_side(partial(written, frame, name) for name, frame in frames.items())
    return dict(zip(frames, tables, strict=True))


@query(
    "chk_13_checks_report",
    o.sql(
        verdict_sql(
            **{
                "01_fact_vs_silver_sejours": DIFFER.format(
                    "SELECT count(*) FROM cl_fact", "SELECT count(*) FROM cl_stays"
                ),
                "02_sejours_conservation": """SELECT count(*) FROM cl_stays
                    WHERE stay_id NOT IN (SELECT stay_id FROM cl_bronze)
                       OR stay_id IN (SELECT natural_key FROM cl_stay_rejects)""",
                "03_patients_dedup": DIFFER.format(
                    "SELECT count(DISTINCT patient_hash) FROM cl_versions", "SELECT count(*) FROM cl_patients"
                ),
                "04_kanonymat": f"""SELECT (SELECT count(*) FROM ({o.prevalence(1)}) WHERE nb_patients < 5)
                    + (SELECT count(*) FROM ({o.cohorte(1)}) WHERE nb_patients < 5)""",
                "05_coherence_temporelle": """SELECT count(*) FROM cl_stays
                    WHERE los_hours < 0 OR discharge_ts < admission_ts""",
                "06_urgences_reconciliation": DIFFER.format(
                    f"SELECT coalesce(sum(nb_passages), 0) FROM ({o.urgences_jour('cl_measures', '1')})",
                    "SELECT count(*) FROM cl_fact WHERE service_code = '1'",
                ),
                "07_monitoring_borne": f"SELECT count(*) FROM mon_bronze WHERE {o.OUT_OF_RANGE}",
                "08_pathologies_integrite": chain_sql("cl_silver_diag", "cl_dim_cim10", "cl_cim10", "code_cim10"),
                "09_corrige_niveau1": f"""SELECT 1 + (SELECT count(*) FROM ({o.readmission('cl_measures', 30)})
                    WHERE nb_readmissions_30j <> -1)""",
                "10_fact_acte_vs_silver": DIFFER.format(
                    "SELECT count(*) FROM cl_fact_acte", "SELECT count(*) FROM cl_silver_actes"
                ),
                "11_actes_service_provenance": """SELECT count(*)
                    FROM (SELECT DISTINCT stay_id, service_code FROM cl_fact_acte) a
                    JOIN cl_fact f ON f.stay_id = a.stay_id WHERE a.service_code <> f.service_code""",
                "12_ccam_integrite": chain_sql("cl_silver_actes", "cl_dim_ccam", "cl_ccam", "code_ccam"),
            }
        )
    ),
)
def _(t: Inputs) -> DataFrame:
    """All twelve checks over one warehouse; unmasked cohorts, raw readings and wrong published
    figures break three of them. Silver and gold tables and marts are written once and read back."""
    c = t.clinic
    bronze = {
        "sejours": c.bronze_sejours,
        "patients": c.bronze_patients,
        "ref_cim10": c.ref_cim10,
        "ref_ccam": c.ref_ccam,
    }
    built = {
        "sejours": c.sejours.kept,
        "patients": c.patients.kept,
        "diagnostics": c.diagnostics.kept,
        "actes": c.actes.kept,
    }
    kept = all_written(built)
    built = {
        "fact_sejour": gold.fact_sejour(kept["sejours"], kept["diagnostics"], hot=[]),
        "fact_acte": gold.fact_acte(kept["actes"], c.ref_ccam),
        "measures": gold.stay_measures(kept["sejours"]),
    }
    facts = all_written(built)
    measures = facts.pop("measures")
    kept |= {
        "monitoring": t.activity.bronze_monitoring,
        "pathologies": silver.pathologies(c.ref_cim10, kept["diagnostics"]),
        "ccam": silver.ccam(c.ref_ccam, kept["actes"]),
    }
    dim_patient = gold.dim_patient(kept["patients"], kept["sejours"])
    marts = {
        "kpi_pilotage_readmission_30j": kpis.readmission(measures),
        "kpi_pilotage_dms": kpis.dms(measures, c.dim_service),
        "kpi_pilotage_alertes_constantes": kpis.alertes_constantes(t.activity.monitoring.kept),
        "kpi_pilotage_urgences_jour": kpis.urgences_jour(measures, "1"),
        "kpi_recherche_prevalence": kpis.prevalence(kept["diagnostics"], c.ref_cim10, 1),
        "kpi_recherche_cohorte_age_sexe": kpis.cohorte_age_sexe(kept["diagnostics"], dim_patient, 1),
    }
    return reconcile.report(
        checks.all_checks(bronze, kept, facts, c.sejours.rejects, all_written(marts), REPORTED, "1")
    )
