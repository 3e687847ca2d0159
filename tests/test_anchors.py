"""Published figures of the frozen data set, where its drops are at hand.

``TIDEMARK_ANCHOR_DROPS`` names the drop folder: stays of 28 days and the reference lists.
"""

from __future__ import annotations

import os
from datetime import date

import pytest

from tidemark.operators.reconcile import VerificationError
from tidemark.plans.checks import GOLDEN
from tidemark.plans.warehouse import Warehouse

DROPS = os.environ.get("TIDEMARK_ANCHOR_DROPS", "")
pytestmark = pytest.mark.skipif(not DROPS, reason="no folder with the frozen data set is named")


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    warehouse = Warehouse(spark, DROPS, str(tmp_path_factory.mktemp("anchors")), "a-secret-salt", as_of_year=2026)
    warehouse.ingest()
    warehouse.transform()
    return warehouse


def test_stays(house):
    assert house.table("bronze/sejours").count() == 6797
    assert house.table("silver/sejours").count() == house.table("gold/fact_sejour").count() == 6729
    rules = house.table("clean/rejects").filter("source = 'sejours'").groupBy("rule").count().collect()
    assert {row.rule: row["count"] for row in rules} == {"sortie_avant_admission": 68}
    assert house.table("silver/services").count() == 8 and house.table("bronze/ref_cim10").count() == 13


def test_readmissions_and_lengths_of_stay(house):
    marts = house.marts()
    returned = marts["kpi_pilotage_readmission_30j"].first()
    assert (returned.nb_readmissions_30j, returned.nb_sejours, returned.taux_readmission_30j_pct) == (780, 6729, 11.59)
    dms = {row.service_code: (row.nb_sejours, row.dms_jours, row.dms_heures) for row in marts["kpi_pilotage_dms"].collect()}
    assert dms["REA"] == (423, 9.05, 217.1)
    days = {code: stay[1] for code, stay in dms.items()}
    wanted = {"REA": 9.05, "NEURO": 7.06, "ONCO": 6.87, "PNEUMO": 6.20, "CARDIO": 5.31, "CHIR": 4.39, "PEDIA": 3.19, "URGENCES": 2.15}
    assert days == wanted


def test_passages_load_and_discharges(house):
    marts = house.marts()
    passages = {row.admission_date: row.nb_passages for row in marts["kpi_pilotage_urgences_jour"].collect()}
    assert sum(passages.values()) == 1423 and passages[date(2026, 8, 1)] == 46
    assert (min(passages.values()), max(passages.values())) == (9, 82)
    load = marts["kpi_pilotage_charge_service"].filter("service_code = 'CARDIO'").first().asDict()
    assert {1601, 7749} <= set(load.values())
    modes = {row.mode_sortie: (row.nb_sejours, row.part_pct) for row in marts["kpi_pilotage_mode_sortie"].collect()}
    assert modes == {"domicile": (3042, 50.3), "transfert": (1009, 16.7), "mutation": (1000, 16.5), "deces": (995, 16.5)}


def test_the_golden_check(house):
    """The figures that rest on stays hold; those whose sources did not ship are reported."""
    stays = [row for row in GOLDEN if row[0].startswith(("readmission", "dms_REA", "dms_NEURO", "urgences"))]
    assert len(stays) == 6
    house.verify(golden=stays)
    with pytest.raises(VerificationError, match="09_corrige_niveau1"):
        house.verify(golden=GOLDEN)
