"""The same model in plain SQL, written apart from the library, to check it against."""

from __future__ import annotations

import re


def half_even(value: str, digits: int) -> str:
    scale = 10**digits
    return f"(round_even(CAST({value} AS DOUBLE) * {scale}, 0) / {scale})"


def hours(start: str, end: str) -> str:
    return f"date_diff('hour', {start}, {end})"


STAY_COLUMNS = (
    "stay_id, patient_hash, service_code, admission_ts, discharge_ts, admission_mode, discharge_mode"
)


def judged_stays(bronze: str, services: str) -> str:
    """Each stay with the one fault its times may have, and whether its service is listed."""
    return f"""
    SELECT *, coalesce(service_code IN (SELECT service_code FROM {services}), false) AS listed,
           CASE WHEN admission_ts IS NULL THEN 'admission_ts_invalide'
                WHEN admission_ts > discharge_ts THEN 'sortie_avant_admission'
                WHEN date_diff('day', admission_ts, discharge_ts) > 180 THEN 'duree_sejour_aberrante'
           END AS time_fault
    FROM {bronze}"""


def silver_stays(judged: str) -> str:
    return f"""
    SELECT {STAY_COLUMNS}, CAST({hours('admission_ts', 'discharge_ts')} AS DOUBLE) AS los_hours
    FROM {judged} WHERE listed AND time_fault IS NULL"""


def stay_rejects(judged: str) -> str:
    """A row per fault of a judged stay; its wording depends on the rule alone."""
    return f"""
    SELECT 'sejours' AS source, stay_id AS natural_key, rule,
           CASE rule
               WHEN 'admission_ts_invalide' THEN 'date/heure admission illisible'
               WHEN 'service_hors_referentiel' THEN service_code
               WHEN 'duree_sejour_aberrante'
                   THEN format('los={{}} j', date_diff('day', admission_ts, discharge_ts))
               ELSE format('discharge={{}} < admission={{}}',
                           strftime(discharge_ts, '%Y-%m-%d %H:%M:%S'),
                           strftime(admission_ts, '%Y-%m-%d %H:%M:%S'))
           END AS detail
    FROM (SELECT *, unnest([time_fault,
                            CASE WHEN NOT listed AND admission_ts IS NOT NULL
                                 THEN 'service_hors_referentiel' END]) AS rule
          FROM {judged})
    WHERE rule IS NOT NULL"""


def measures(silver: str) -> str:
    return f"""
    SELECT DISTINCT {STAY_COLUMNS}, los_hours, CAST(admission_ts AS DATE) AS admission_date,
           {half_even('los_hours / 24', 2)} AS los_days,
           CAST(discharge_ts IS NOT NULL AS INTEGER) AS is_closed,
           CAST(admission_mode = 'urgence' AS INTEGER) AS is_urgence
    FROM {silver}"""


def code_rejects(source: str, bronze: str, stays: str, reference: str, code: str) -> str:
    return f"""
    SELECT '{source}' AS source, b.stay_id AS natural_key, 'sejour_inconnu' AS rule,
           b.{code} AS detail
    FROM {bronze} b WHERE NOT EXISTS (SELECT 1 FROM {stays} s WHERE s.stay_id = b.stay_id)
    UNION ALL
    SELECT '{source}', b.stay_id, '{code}_hors_referentiel', b.{code}
    FROM {bronze} b WHERE NOT EXISTS (SELECT 1 FROM {reference} r WHERE r.{code} = b.{code})"""


OUT_OF_RANGE = (
    "heart_rate NOT BETWEEN 20 AND 250 OR spo2 NOT BETWEEN 50 AND 100 OR temp_c NOT BETWEEN 30 AND 45"
)
IS_ALERT = "spo2 < 92 OR heart_rate < 50 OR heart_rate > 100 OR temp_c > 38.5"
SEX = """CASE WHEN upper({0}) IN ('M', 'H', 'HOMME', 'MALE') THEN 'M'
              WHEN upper({0}) IN ('F', 'FEMME', 'FEMALE') THEN 'F' ELSE '' END"""
AGE_BAND = (
    "CASE WHEN {0} IS NULL THEN 'inconnu' "
    + " ".join(f"WHEN {{0}} < {start + 10} THEN '{start}-{start + 9}'" for start in range(0, 100, 10))
    + " ELSE '100+' END"
)

# Common table expressions, each named once; later ones build on earlier ones.
CTES: dict[str, str] = {
    "ev": """
    SELECT CAST(event_id AS VARCHAR) AS event_id, date_trunc('second', ts) AS ts,
           CAST(user_id AS VARCHAR) AS user_id, event_type, value, props,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events""",
    "ev_bronze": """
    SELECT event_id AS stay_id, user_id AS patient_hash, event_type AS service_code,
           ts AS admission_ts,
           CASE WHEN k < 95 THEN ts + to_minutes(CAST((k - 5) * 37 AS BIGINT)) END AS discharge_ts,
           CASE WHEN value > 100 THEN 'urgence' ELSE 'programme' END AS admission_mode,
           CASE WHEN k >= 95 THEN '' WHEN k < 35 THEN 'domicile' WHEN k < 60 THEN 'transfert'
                WHEN k < 80 THEN 'mutation' ELSE 'deces' END AS discharge_mode
    FROM ev""",
    "ev_services": """
    SELECT * FROM (VALUES ('click', 'Clic'), ('purchase', 'Achat'), ('signup', 'Inscription'),
                          ('view', 'Vue')) v(service_code, service_label)""",
    "ev_judged": judged_stays("ev_bronze", "ev_services"),
    "ev_stays": silver_stays("ev_judged"),
    "ev_rejects": stay_rejects("ev_judged"),
    "ev_fact": measures("ev_stays"),
    "mon_bronze": """
    SELECT event_id AS stay_id, ts,
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS INTEGER) + 40 END AS heart_rate,
           CAST(100 - k // 8 AS INTEGER) AS spo2,
           CASE WHEN event_type <> 'view'
                THEN CAST(CAST(29.5 AS DOUBLE) + k * CAST(0.16 AS DOUBLE) AS FLOAT) END AS temp_c
    FROM ev""",
    "mon_silver": f"""
    SELECT * FROM mon_bronze
    WHERE (heart_rate IS NULL OR heart_rate BETWEEN 20 AND 250)
      AND (spo2 IS NULL OR spo2 BETWEEN 50 AND 100)
      AND (temp_c IS NULL OR temp_c BETWEEN 30 AND 45)""",
    "ev_patients": f"""
    SELECT user_id AS patient_id, event_id AS nir, event_type || ', ' || props AS nom,
           event_type AS prenom, CAST(1924 + k AS VARCHAR) || '-05-07' AS birth_date,
           CASE event_type WHEN 'view' THEN 'm' WHEN 'click' THEN 'Homme' WHEN 'signup' THEN 'FEMALE'
                WHEN 'purchase' THEN 'femme' WHEN 'error' THEN '?' END AS sex,
           CAST(k AS VARCHAR) AS region_code, CAST(ts AS DATE) AS business_date
    FROM ev""",
    "cl_bronze": """
    SELECT CAST(o_orderkey AS VARCHAR) AS stay_id, CAST(o_custkey AS VARCHAR) AS patient_hash,
           coalesce(CAST(c_nationkey AS VARCHAR), '') AS service_code, o_orderdate AS admission_ts,
           CASE WHEN o_totalprice < 480000
                THEN o_orderdate + to_days(CAST(floor(o_totalprice / 2000) AS INTEGER) - 10)
           END AS discharge_ts,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgence' ELSE 'programme' END AS admission_mode,
           CASE WHEN o_totalprice >= 480000 THEN '' WHEN o_orderstatus = 'O' THEN 'transfert'
                ELSE 'domicile' END AS discharge_mode
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus <> 'P'""",
    "cl_services": """
    SELECT CAST(n_nationkey AS VARCHAR) AS service_code, n_name AS service_label
    FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'MIDDLE EAST'""",
    "cl_desc": """
    SELECT CAST(s_nationkey AS VARCHAR) AS service_code, r_name AS categorie,
           CAST(count(*) AS INTEGER) AS capacite_lits, 'Pole ' || r_name AS pole
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE s_acctbal > 5000 GROUP BY s_nationkey, r_name""",
    "cl_dim_service": """
    SELECT s.service_code, s.service_label, coalesce(d.categorie, '(non décrit)') AS categorie,
           d.capacite_lits, coalesce(d.pole, '(non décrit)') AS pole,
           CAST(d.service_code IS NOT NULL AS INTEGER) AS is_described
    FROM cl_services s LEFT JOIN cl_desc d ON d.service_code = s.service_code""",
    "cl_lines": """
    SELECT CAST(l_orderkey AS VARCHAR) AS stay_id, p_brand, p_type, l_linenumber, l_returnflag
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "cl_diag": """
    SELECT stay_id, p_brand AS code_cim10,
           CASE WHEN l_linenumber = 1 THEN 'principal' ELSE 'associe' END AS type
    FROM cl_lines WHERE l_linenumber <> 7
    UNION ALL
    SELECT stay_id, p_type, 'associe' FROM cl_lines WHERE l_linenumber <> 7 AND l_returnflag = 'R'""",
    "cl_cim10": """
    SELECT 'Brand#' || i AS code_cim10, 'Famille ' || i AS libelle FROM range(1, 24) t(i)
    UNION ALL
    SELECT * FROM (VALUES ('STANDARD', 'Courant'), ('ECONOMY', 'Economique'), ('MEDIUM', 'Moyen'),
                          ('LARGE', 'Grand')) v""",
    "cl_actes": """
    SELECT CAST(l_orderkey AS VARCHAR) AS stay_id, CAST(l_partkey AS VARCHAR) AS code_ccam,
           l_shipdate AS acte_ts
    FROM lineitem""",
    "cl_ccam": """
    SELECT CAST(p_partkey AS VARCHAR) AS code_ccam, p_name AS libelle,
           CAST(round(p_retailprice * 100) AS BIGINT) AS tarif_euros
    FROM part WHERE p_size <= 45""",
    "cl_versions": """
    SELECT CAST(o_custkey AS VARCHAR) AS patient_hash,
           CASE WHEN o_orderstatus <> 'P' THEN 1880 + CAST(floor(o_totalprice / 3000) AS INTEGER)
           END AS birth_year,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'm' WHEN '2-HIGH' THEN 'Homme'
                WHEN '3-MEDIUM' THEN 'FEMALE' WHEN '4-NOT SPECIFIED' THEN 'femme' WHEN '5-LOW' THEN '?'
           END AS sex,
           o_orderstatus AS region_code, CAST(o_orderdate AS DATE) AS business_date,
           o_orderkey AS version_seq
    FROM orders""",
    "cl_newest": f"""
    SELECT patient_hash,
           last(birth_year ORDER BY business_date, version_seq)
               FILTER (WHERE birth_year IS NOT NULL) AS birth_year,
           last({SEX.format('sex')} ORDER BY business_date, version_seq) AS sex,
           last(region_code ORDER BY business_date, version_seq) AS region_code
    FROM cl_versions GROUP BY patient_hash""",
    "cl_patients": """
    SELECT patient_hash, CASE WHEN birth_year BETWEEN 1900 AND 2001 THEN birth_year END AS birth_year,
           sex, region_code
    FROM cl_newest""",
    "cl_judged": judged_stays("cl_bronze", "cl_services"),
    "cl_stays": silver_stays("cl_judged"),
    "cl_stay_rejects": stay_rejects("cl_judged"),
    "cl_silver_diag": """
    SELECT d.stay_id, b.patient_hash, d.code_cim10, d.type
    FROM cl_diag d JOIN cl_bronze b ON b.stay_id = d.stay_id
    WHERE d.code_cim10 IN (SELECT code_cim10 FROM cl_cim10)""",
    "cl_diag_rejects": code_rejects("diagnostics", "cl_diag", "cl_bronze", "cl_cim10", "code_cim10"),
    "cl_silver_actes": """
    SELECT a.stay_id, b.patient_hash, b.service_code, a.code_ccam, a.acte_ts,
           CAST(a.acte_ts AS DATE) AS acte_date
    FROM cl_actes a JOIN cl_bronze b ON b.stay_id = a.stay_id
    WHERE a.code_ccam IN (SELECT code_ccam FROM cl_ccam)""",
    "cl_acte_rejects": code_rejects("actes", "cl_actes", "cl_bronze", "cl_ccam", "code_ccam"),
    "cl_dim_cim10": """
    SELECT code_cim10, libelle FROM cl_cim10
    WHERE code_cim10 IN (SELECT code_cim10 FROM cl_silver_diag)""",
    "cl_dim_ccam": """
    SELECT code_ccam, libelle, tarif_euros FROM cl_ccam
    WHERE code_ccam IN (SELECT code_ccam FROM cl_silver_actes)""",
    "cl_dim_patient": f"""
    SELECT patient_hash, sex, region_code, age_years, {AGE_BAND.format('age_years')} AS age_band
    FROM (SELECT *, CAST((SELECT year(max(admission_ts)) FROM cl_stays) - birth_year AS INTEGER)
                    AS age_years
          FROM cl_patients)""",
    "cl_measures": measures("cl_stays"),
    "cl_principal": """
    SELECT stay_id, min(code_cim10) AS code FROM cl_silver_diag WHERE type = 'principal'
    GROUP BY stay_id""",
    "cl_fact": """
    SELECT m.*, coalesce(p.code, '') AS diag_principal
    FROM cl_measures m LEFT JOIN cl_principal p ON p.stay_id = m.stay_id""",
    "cl_fact_acte": """
    SELECT a.stay_id, a.patient_hash, a.service_code, a.acte_date, a.acte_ts, a.code_ccam,
           coalesce(c.tarif_euros, 0) AS tarif_euros
    FROM cl_silver_actes a LEFT JOIN cl_dim_ccam c ON c.code_ccam = a.code_ccam""",
    "cl_billed": """
    SELECT service_code, count(*) AS acts, CAST(sum(tarif_euros) AS BIGINT) AS euros,
           (SELECT count(*) FROM cl_measures m WHERE m.service_code = a.service_code) AS stays
    FROM cl_fact_acte a GROUP BY service_code""",
}


def sql(body: str) -> str:
    """``body`` preceded by the expressions it names, directly or not."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"[a-z_0-9]+", open_texts.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            open_texts.append(CTES[name])
    parts = [f"{name} AS ({text})" for name, text in CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def dms(fact: str, services: str) -> str:
    return f"""
    SELECT f.service_code, coalesce(s.service_label, '') AS service_label, count(*) AS nb_sejours,
           {half_even('avg(los_hours) / 24', 2)} AS dms_jours,
           {half_even('avg(los_hours)', 1)} AS dms_heures
    FROM {fact} f LEFT JOIN {services} s ON s.service_code = f.service_code
    WHERE is_closed = 1 AND los_hours IS NOT NULL GROUP BY 1, 2"""


def urgences_jour(fact: str, service: str) -> str:
    return f"""
    SELECT admission_date, count(*) AS nb_passages,
           count(*) FILTER (WHERE discharge_ts IS NULL) AS nb_encore_presents,
           {half_even('avg(los_hours) FILTER (WHERE discharge_ts IS NOT NULL)', 1)} AS duree_moy_heures
    FROM {fact} WHERE service_code = '{service}' GROUP BY admission_date"""


def readmission(fact: str, days: int) -> str:
    n = f"nb_readmissions_{days}j"
    return f"""
    SELECT *, {half_even(f'100.0 * {n} / nullif(nb_sejours, 0)', 2)} AS taux_readmission_{days}j_pct
    FROM (SELECT count(*) FILTER (WHERE date_diff('day', discharge_ts, nxt) BETWEEN 0 AND {days}) AS {n},
                 count(*) AS nb_sejours
          FROM (SELECT discharge_ts,
                       lead(admission_ts) OVER (PARTITION BY patient_hash
                                                ORDER BY admission_ts, stay_id) AS nxt
                FROM {fact}))"""


def alertes(readings: str) -> str:
    return f"""
    SELECT *, {half_even('100.0 * nb_alertes / nb_releves', 1)} AS taux_alertes_pct
    FROM (SELECT CAST(ts AS DATE) AS jour, count(*) AS nb_releves,
                 count(*) FILTER (WHERE {IS_ALERT}) AS nb_alertes
          FROM {readings} GROUP BY 1)"""


def mode_sortie(fact: str) -> str:
    return f"""
    SELECT discharge_mode AS mode_sortie, count(*) AS nb_sejours,
           {half_even('100.0 * count(*) / sum(count(*)) OVER ()', 1)} AS part_pct
    FROM {fact} WHERE is_closed = 1 GROUP BY 1"""


def charge_service(fact: str, services: str) -> str:
    return f"""
    SELECT f.service_code, coalesce(s.service_label, '') AS service_label, count(*) AS admissions,
           count(*) FILTER (WHERE is_closed = 0) AS sejours_en_cours,
           {half_even('sum(CAST(round(los_days * 100) AS BIGINT)) / 100.0', 0)} AS patients_jours
    FROM {fact} f LEFT JOIN {services} s ON s.service_code = f.service_code GROUP BY 1, 2"""


def prevalence(k: int) -> str:
    return f"""
    SELECT d.code_cim10, coalesce(c.libelle, '') AS libelle_cim10,
           count(DISTINCT patient_hash) AS nb_patients
    FROM cl_silver_diag d LEFT JOIN cl_dim_cim10 c ON c.code_cim10 = d.code_cim10
    GROUP BY 1, 2 HAVING count(DISTINCT patient_hash) >= {k}"""


def cohorte(k: int) -> str:
    return f"""
    SELECT d.code_cim10, p.age_band AS tranche_age, p.sex AS sexe,
           count(DISTINCT d.patient_hash) AS nb_patients
    FROM cl_silver_diag d JOIN cl_dim_patient p ON p.patient_hash = d.patient_hash
    WHERE d.type = 'principal' GROUP BY 1, 2, 3 HAVING count(DISTINCT d.patient_hash) >= {k}"""


ACTIVITE = f"""
    SELECT coalesce(s.categorie, '') AS categorie, count(*) AS nb_sejours,
           count(*) FILTER (WHERE is_closed = 1) AS nb_sejours_clos,
           {half_even('avg(los_hours) FILTER (WHERE is_closed = 1) / 24', 2)} AS dms_jours
    FROM cl_measures f LEFT JOIN cl_dim_service s ON s.service_code = f.service_code GROUP BY 1"""


def of_service(column: str) -> str:
    """A column of the billed service's dimension row, looked up for the total."""
    return f"(SELECT {column} FROM cl_dim_service d WHERE d.service_code = b.service_code)"


BILLED = f"service_code, coalesce({of_service('service_label')}, '') AS service_label, acts AS nb_actes"
ACTES_SERVICE = f"""
    SELECT {BILLED}, stays AS nb_sejours, {half_even('acts / nullif(stays, 0)', 2)} AS actes_par_sejour
    FROM cl_billed b"""
DENSITE = f"""
    SELECT {BILLED}, {of_service('capacite_lits')} AS capacite_lits,
           {half_even(f"acts / {of_service('capacite_lits')}", 1)} AS actes_par_lit
    FROM cl_billed b"""
MONTANT = f"""
    SELECT {BILLED}, euros AS montant_total_euros, {half_even('euros / acts', 2)} AS tarif_moyen_euros
    FROM cl_billed b"""
ACTES_TYPE = f"""
    SELECT code_ccam, nb_actes,
           coalesce((SELECT libelle FROM cl_dim_ccam d WHERE d.code_ccam = t.code_ccam), '') AS libelle,
           {half_even('100.0 * nb_actes / (SELECT count(*) FROM cl_fact_acte)', 1)} AS part_pct
    FROM (SELECT code_ccam, count(*) AS nb_actes FROM cl_fact_acte GROUP BY code_ccam) t"""
PYRAMIDE = f"""
    SELECT tranche_age, sexe, CAST(sum(nb_patients) AS BIGINT) AS nb_patients
    FROM ({cohorte(5)}) GROUP BY 1, 2"""

# Every mart on the clinic tables.
MARTS = {
    "kpi_pilotage_dms": dms("cl_measures", "cl_dim_service"),
    "kpi_pilotage_urgences_jour": urgences_jour("cl_measures", "1"),
    "kpi_pilotage_readmission_30j": readmission("cl_measures", 30),
    "kpi_pilotage_alertes_constantes": alertes("mon_silver"),
    "kpi_pilotage_mode_sortie": mode_sortie("cl_measures"),
    "kpi_pilotage_charge_service": charge_service("cl_measures", "cl_dim_service"),
    "kpi_pilotage_activite_categorie": ACTIVITE,
    "kpi_pilotage_actes_service": ACTES_SERVICE,
    "kpi_pilotage_actes_type": ACTES_TYPE,
    "kpi_pilotage_densite_actes_lit": DENSITE,
    "kpi_pilotage_montant_t2a": MONTANT,
    "kpi_recherche_prevalence": prevalence(5),
    "kpi_recherche_cohorte_age_sexe": cohorte(5),
}
