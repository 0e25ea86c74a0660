"""Published summaries: what changes, what is read again, and that the result is the one computed anew."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parcelpay.names import FACTS
from parcelpay.plans import consignments as vendor
from parcelpay.plans import handoff
from parcelpay.plans.registry import PUBLISHED_AT
from parcelpay.rules import VendorRules
from parcelpay.sources.sinks import shared_folder
from parcelpay.sources.star import star_tables
from tests.conftest import SMALL


@pytest.fixture
def tables(spark, tmp_path):
    t = star_tables(spark, SMALL)
    return t.with_frames(**{FACTS: handoff.partition_by_month(t[FACTS], f"{tmp_path}/facts")})


def changed(tables, since=PUBLISHED_AT):
    return handoff.changed_months(tables[FACTS], tables["cod_remittance"], VendorRules.v2(cod_sign=1), since)


def test_months_of_late_remittances_are_found(tables):
    found = {r["_month"]: r["parcels"] for r in changed(tables).collect()}
    assert "2023-01" not in found and found["2023-03"] > found.get("2023-02", 0)


def test_only_the_changed_months_are_read(tables, tmp_path):
    changed(tables).write.parquet(f"{tmp_path}/months")
    months = tables[FACTS].sparkSession.read.parquet(f"{tmp_path}/months")
    read = handoff.only_months(tables, FACTS, months)
    rows = vendor.combined_summary(read)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "zzcons_status" in line]
    assert scans and all("dynamicpruning" in line for line in scans)
    wanted = [r["_month"] for r in months.collect()]
    assert read[FACTS].count() == tables[FACTS].filter(F.col("_month").isin(wanted)).count()


def test_refreshing_replaces_the_changed_months_alone(spark, tables, tmp_path):
    report, path = vendor.combined_summary, f"{tmp_path}/summary"
    remittances = tables["cod_remittance"]
    before = tables.with_frames(cod_remittance=remittances.filter(~handoff.arrived(remittances, PUBLISHED_AT)))
    old = {tuple(r) for r in handoff.publish(report, before, path).collect()}
    january = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "summary").glob("*/*January*/*.parquet")}
    new = {tuple(r) for r in handoff.refresh(report, tables, FACTS, changed(tables), path).collect()}
    assert new == {tuple(r) for r in report(tables).collect()} != old
    assert january == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "summary").glob("*/*January*/*.parquet")} != {}


def test_unreadable_delivery_times_have_a_month_of_their_own(spark, make, tmp_path):
    rows = [{"gpart": "V", "zzconsg_number": f"C{i}", "zzcons_status": "DRS", "zzdelivery_date": d} for i, d in enumerate([None, "soon", "05-02-2023 10:00:00"])]
    facts = handoff.partition_by_month(make(**{FACTS: rows})[FACTS], f"{tmp_path}/facts")
    assert sorted(r["_month"] for r in facts.collect()) == ["2023-02", "unknown", "unknown"]


def test_shared_folders_are_new_ones(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and re.search("/x-[0-9a-f]+$", first)
