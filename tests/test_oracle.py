"""Every registered query against its SQL on the small data."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from parcelpay.plans.registry import REPORTS
from tests.compare import connect, difference
from tests.conftest import SMALL

NAMES = sorted(driver.oracle_sql())


def test_every_report_has_sql():
    assert set(REPORTS) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SMALL)
    assert difference(frame, duck, driver.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
