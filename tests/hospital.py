"""A small hospital's drops, written as files, with every edge row the rules know."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd

SALT = "a-salt-for-tests"
DAYS = ("2026-08-26", "2026-08-27", "2026-08-28")

SERVICES = """service_code,service_label
CARDIO,Cardiologie
URGENCES,Urgences
NEURO,Neurologie
"""
DESCRIPTIONS = """service_code,categorie,capacite_lits,pole
CARDIO,medecine,30,Coeur-Poumon
URGENCES,urgences,20,Urgences
"""
CIM10 = """code_cim10,libelle
I50,Insuffisance cardiaque
J18,"Pneumopathie, germe non precise"
N39,Infection urinaire
Q90,Trisomie 21
"""
CCAM = """code_ccam,libelle,tarif_euros
DZEA001,Coronarographie,450
YYYY010,Consultation de suivi,25
ZZZZ999,Jamais fait,1
"""
STAY_HEADER = "stay_id,patient_id,service_code,admission_ts,discharge_ts,admission_mode,discharge_mode"
PATIENT_HEADER = "patient_id,nir,nom,prenom,birth_date,sex,region_code"


def patients(day: int) -> list[str]:
    """Twelve patients in three snapshots; the last one drops a birth date."""
    lines = []
    for i in range(12):
        birth = f"{1930 + 5 * i}-03-04"
        if i == 1:
            birth = ("1940-01-01", "1941-01-01", "")[day]
        if i == 2:
            birth = "1899-01-01"
        if i == 3:
            birth = "2027-01-01"
        sex = ("m", "H", "Homme", "MALE", "femme", "Female")[i % 6] if i != 4 else "?"
        region = "75" if i != 1 else ("33", "75", "13")[day]
        lines.append(f'IPP{i:07d},1050775096{i:05d},"NOM, ""{i}""",Jean,{birth},{sex},{region}')
    return lines


def stays(day: int) -> list[str]:
    at = f"{DAYS[day]} 10:59:00"
    first = datetime.fromisoformat(at)

    def line(i, patient, service, admission, discharge, mode="urgence", out="domicile"):
        out = out if discharge else ""
        return f"S{day}{i:03d},IPP{patient:07d},{service},{admission},{discharge},{mode},{out}"

    def after(**delta):
        return (first + timedelta(**delta)).strftime("%Y-%m-%d %H:%M:%S")

    lines = [
        line(0, 0, "CARDIO", at, after(minutes=62)),
        line(1, 1, "URGENCES", at, ""),
        line(2, 2, "URGENCES", at, at),
        line(3, 3, "CARDIO", at, after(hours=-1)),
        line(4, 4, "NEURO", at, after(days=180)),
        line(5, 5, "NEURO", at, after(days=181)),
        line(6, 6, "CARDIO", "not a date", at),
        line(7, 7, "XXX", at, after(hours=3)),
        line(8, 8, "XXX", at, after(hours=-3)),
        line(9, 9, "CARDIO", at, after(hours=3), "programme", "transfert"),
    ]
    return lines + [line(10 + i, i, "CARDIO", after(hours=i), after(days=1)) for i in range(6)]


def diagnostics(day: int) -> list[dict]:
    def coded(stay, *codes):
        kinds = ["principal", "associe", "associe"]
        return {
            "stay_id": stay,
            "diagnostics": [{"code_cim10": c, "type": t} for c, t in zip(codes, kinds, strict=False)],
        }

    made = [
        coded(f"S{day}000", "I50", "J18", "N39"),
        coded(f"S{day}001"),
        coded(f"S{day}003", "Q90"),
        coded("S9999", "I50"),
        coded(f"S{day}002", "BAD"),
        coded("S9999", "BAD"),
    ]
    return made + [coded(f"S{day}{10 + i:03d}", "N39", "I50") for i in range(6)]


def monitoring(day: int) -> pd.DataFrame:
    ts = pd.Timestamp(f"{DAYS[day]} 06:00:00.750")
    readings = [
        (20, 91, 37.0), (250, 92, 37.0), (49, 95, 37.0), (50, 95, 37.0), (100, 95, 37.0),
        (101, 95, 37.0), (70, 95, 38.5), (70, 95, 38.6), (None, None, None), (None, 95, 30.0),
        (19, 95, 37.0), (251, 95, 37.0), (70, 49, 37.0), (70, 101, 37.0), (70, 95, 29.9),
        (70, 95, 45.1), (None, 49, None),
    ]
    return pd.DataFrame(
        [(f"S{day}{i:03d}", ts + pd.Timedelta(minutes=i), *r) for i, r in enumerate(readings)],
        columns=["stay_id", "ts", "heart_rate", "spo2", "temp_c"],
    )


def actes(day: int) -> pd.DataFrame:
    ts = pd.Timestamp(f"{DAYS[day]} 12:00:00")
    acts = [
        (f"S{day}000", "DZEA001"), (f"S{day}000", "YYYY010"), (f"S{day}003", "YYYY010"),
        (f"S{day}004", "YYYY010"), ("S9999", "DZEA001"), (f"S{day}000", "BAD"), ("S9999", "BAD"),
    ]
    return pd.DataFrame([(s, c, ts) for s, c in acts], columns=["stay_id", "code_ccam", "acte_ts"])


def write_text(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def write_day(root: Path, day: int) -> None:
    date = DAYS[day]
    write_text(root / "patients" / date / "patients.csv", "\n".join([PATIENT_HEADER, *patients(day)]) + "\n")
    write_text(root / "sejours" / date / "sejours.csv", "\n".join([STAY_HEADER, *stays(day)]) + "\n")
    write_text(
        root / "diagnostics" / date / "diagnostics.json", json.dumps(diagnostics(day), indent=1)
    )
    for source, frame in (("monitoring", monitoring(day)), ("actes", actes(day))):
        path = root / source / date / f"{source}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        frame.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    if day == 0:
        for name, text in (
            ("services", SERVICES),
            ("description_service", DESCRIPTIONS),
            ("cim10", CIM10),
            ("ccam", CCAM),
        ):
            write_text(root / "referentiels" / date / f"{name}.csv", text)


def write_all(root: Path) -> Path:
    for day in range(len(DAYS)):
        write_day(root, day)
    return root
