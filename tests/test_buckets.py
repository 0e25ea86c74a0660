"""Tables stored by consignment number join without moving."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from parcelpay.names import FACTS
from parcelpay.plans import biker, hygiene
from parcelpay.plans import consignments as vendor
from parcelpay.plans import vehicle
from parcelpay.sources.buckets import co_located
from parcelpay.rules import VendorRules
from parcelpay.sources.star import star_tables
from tests.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return co_located(star_tables(spark, SMALL), str(tmp_path_factory.mktemp("stored")), 5)


@pytest.fixture(scope="module")
def remitted(spark, tmp_path_factory):
    return co_located(star_tables(spark, SMALL), str(tmp_path_factory.mktemp("remitted")), 5, VendorRules.v1())


REPORTS = {
    "biker_con_level": biker.biker_con_level,
    "biker_detailed": biker.biker_detailed,
    "vehicle_detailed": vehicle.vehicle_detailed,
    "hygiene_incentive_biker": hygiene.hygiene_incentive_biker,
}


@pytest.mark.parametrize("name", REPORTS)
def test_consignment_joins_move_nothing(stored, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = REPORTS[name](stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [") >= 1
    assert not re.search(r"Exchange hashpartitioning\((consignment|zzconsg_number|reference_number|cod_key|con_number)#", plan)
    assert "Bucketed: true" in plan


def test_weight_rows_are_settled_where_they_are_stored(remitted, conf):
    """Delivered facts, their prices, their remittances and their distinct rows: masters and remittances aside, nothing moves."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = vendor.weight_con_level(remitted.v1_slabs())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in plan.split("SortMergeJoin")[0]
    assert not re.search(r"Exchange hashpartitioning\((consignment_number|zzconsg_number|_cod_key|cod_key)#", plan)


@pytest.mark.parametrize("name", ["biker_con_level_co_located", "weight_con_level_co_located"])
def test_results_are_the_same(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert difference(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None


def test_rows_without_a_number_are_kept(spark, make, tmp_path):
    rows = [{"gpart": f"V{i}", "zzconsg_number": None if i % 2 else f"C{i}"} for i in range(20)]
    tables = co_located(make(**{FACTS: rows}), str(tmp_path), 3)
    assert tables[FACTS].count() == 20 and tables[FACTS].filter("zzconsg_number is null").count() == 10
