"""The hospital model: drop files, table schemas and the fixed codes of its rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, LONG, FLOAT, DOUBLE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.FloatType(),
    T.DoubleType(),
)
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, STRING) for name in names])


def schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


@dataclass(frozen=True)
class DropFile:
    """One kind of file in the daily drops: ``<source>/<date>/<file>``.

    ``schema`` is the one files are read with, NULL when they carry their own; the lake
    keeps the types of ``stored``, since such files may change theirs from day to day.
    CSV fields may hold line breaks inside quotes; a file known to have none splits over
    tasks with ``multi_line`` off.
    """

    source: str
    name: str
    format: str
    schema: T.StructType | None
    stored: T.StructType | None
    pattern: str
    multi_line: bool = True

    @property
    def identifying(self) -> bool:
        return self.source in IDENTIFYING_SOURCES


def drop_file(
    source: str,
    name: str,
    format: str,
    columns: T.StructType | None = None,
    stored: T.StructType | None = None,
) -> DropFile:
    return DropFile(source, name, format, columns, stored, f"{name}.{format}")


IDENTIFYING_SOURCES = ("patients", "sejours")
IDENTIFIERS = ("nir", "nom", "prenom")

DIAGNOSTICS = T.StructType(
    [
        T.StructField("stay_id", STRING),
        T.StructField("diagnostics", T.ArrayType(text_schema("code_cim10", "type"))),
    ]
)
MONITORING = schema(stay_id=STRING, ts=TIMESTAMP, heart_rate=DOUBLE, spo2=DOUBLE, temp_c=DOUBLE)
ACTES = schema(stay_id=STRING, code_ccam=STRING, acte_ts=TIMESTAMP)

DROP_FILES = (
    drop_file(
        "patients",
        "patients",
        "csv",
        text_schema("patient_id", "nir", "nom", "prenom", "birth_date", "sex", "region_code"),
    ),
    drop_file(
        "sejours",
        "sejours",
        "csv",
        text_schema(
            "stay_id",
            "patient_id",
            "service_code",
            "admission_ts",
            "discharge_ts",
            "admission_mode",
            "discharge_mode",
        ),
    ),
    drop_file("diagnostics", "diagnostics", "json", DIAGNOSTICS),
    drop_file("monitoring", "monitoring", "parquet", stored=MONITORING),
    drop_file("actes", "actes", "parquet", stored=ACTES),
    drop_file("referentiels", "services", "csv", text_schema("service_code", "service_label")),
    drop_file("referentiels", "cim10", "csv", text_schema("code_cim10", "libelle")),
    drop_file(
        "referentiels",
        "description_service",
        "csv",
        text_schema("service_code", "categorie", "capacite_lits", "pole"),
    ),
    drop_file("referentiels", "ccam", "csv", text_schema("code_ccam", "libelle", "tarif_euros")),
)

LEDGER = schema(
    path=STRING, sha256=STRING, source=STRING, business_date=DATE, rows=LONG, ingested_at=TIMESTAMP
)
# New files of a batch, and drop files as they were listed when last read.
LANDED = schema(source=STRING, business_date=DATE, file=STRING, sha256=STRING, rows=LONG)
SEEN = schema(source=STRING, name=STRING, path=STRING, length=LONG, modified=TIMESTAMP, salted=STRING)
RUNS = schema(
    run_id=STRING,
    action=STRING,
    layer=STRING,
    business_date=DATE,
    started_at=TIMESTAMP,
    finished_at=TIMESTAMP,
    status=STRING,
    error=STRING,
)

# Thresholds and labels of the rules and measures.
MAX_STAY_DAYS = 180
FIRST_BIRTH_YEAR = 1900
PLAUSIBLE = {"heart_rate": (20, 250), "spo2": (50, 100), "temp_c": (30, 45)}
ALERT = {"spo2_below": 92, "heart_rate_below": 50, "heart_rate_above": 100, "temp_c_above": 38.5}
NOT_DESCRIBED = "(non décrit)"
EMERGENCY_SERVICE = "URGENCES"
EMERGENCY_MODE = "urgence"
PRINCIPAL = "principal"
RETURN_DAYS = 30

# Journal details that are the same for every row of a rule.
DETAILS = {
    "sex_non_normalise": "sexe vide après normalisation",
    "service_sans_description": (
        "service absent de description_service.csv — conservé, catégorie/pôle « (non décrit) »"
    ),
    "admission_ts_invalide": "date/heure admission illisible",
}

# The marts each audience may read.
AUDIENCES = {
    "pilotage": (
        "kpi_pilotage_dms",
        "kpi_pilotage_urgences_jour",
        "kpi_pilotage_readmission_30j",
        "kpi_pilotage_alertes_constantes",
        "kpi_pilotage_mode_sortie",
        "kpi_pilotage_charge_service",
        "kpi_pilotage_activite_categorie",
        "kpi_pilotage_actes_service",
        "kpi_pilotage_actes_type",
        "kpi_pilotage_densite_actes_lit",
        "kpi_pilotage_montant_t2a",
    ),
    "recherche": ("kpi_recherche_prevalence", "kpi_recherche_cohorte_age_sexe"),
}
