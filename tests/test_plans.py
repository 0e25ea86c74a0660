"""What the plans of the reports look like, and that results do not depend on how Spark joins."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from parcelpay.names import FACTS
from parcelpay.operators import ranking
from parcelpay.operators.lookups import BROADCAST_LIMIT_KEY, broadcast_within_limit, size_bound
from parcelpay.plans import consignments as vendor
from parcelpay.plans.registry import REPORTS
from parcelpay.rules import VendorRules
from parcelpay.sources.star import star_tables
from parcelpay.sources.tables import ReportTables
from tests.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture
def tables(spark):
    return star_tables(spark, SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_join_without_an_equality_key(tables, name):
    text = plan(REPORTS[name](tables))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Python" not in text


def test_delivered_filter_and_columns_reach_the_scan(tables):
    text = plan(REPORTS["assignment_check"](tables))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "zzcons_status" in line)
    assert "EqualTo(zzcons_status,DRS)" in scan
    columns = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {"gpart", "zzconsg_number", "zzcons_status", "zzdelivery_date"}


def test_weight_reports_shuffle_the_fact_once(tables, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(REPORTS["weight_con_level"](tables))
    assert text.count("SortMergeJoin") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(cod_key", text)) == 1
    # Above the remittance join there is no further exchange: the distinct uses its partitioning.
    assert not re.search(r"Exchange", text.split("SortMergeJoin")[0])


def test_day_view_counts_on_the_same_partitioning(tables, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(REPORTS["weight_detailed"](tables)).split("SortMergeJoin")[0]
    # Only the roll-up to days and the distinct of its rows.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert not re.search(r"Exchange hashpartitioning\([^)]*consignment_number", text)


def test_vehicle_branches_share_the_fact_shuffle(tables, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = REPORTS["vehicle_detailed"](tables)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet [gpart") == 1 and "ReusedExchange" in text


def test_broadcast_only_within_the_limit(spark, tables, conf):
    rates = tables["ndv_commercial_master"]
    size = size_bound(rates)
    assert size and size > 0
    conf(BROADCAST_LIMIT_KEY, str(size))
    assert "ResolvedHint" in explained(broadcast_within_limit(rates))
    conf(BROADCAST_LIMIT_KEY, str(size - 1))
    assert "ResolvedHint" not in explained(broadcast_within_limit(rates))


@pytest.mark.parametrize(
    "name", ["con_level_with_logs", "combined_summary", "biker_summary", "vehicle_detailed", "hygiene_incentive_biker"]
)
def test_results_without_broadcast_and_with_split_ranks(spark, conf, monkeypatch, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf(BROADCAST_LIMIT_KEY, "0")
    monkeypatch.setattr(ranking.rank_within, "__defaults__", _with_rows_per_task(50))
    frame = driver.queries()[name](spark, SMALL)
    assert difference(frame, connect(SMALL), driver.oracle_sql()[name]) is None


def _with_rows_per_task(rows):
    """Defaults of the rank with a low limit, so that groups of the small data count as large."""
    defaults = ranking.rank_within.__defaults__
    return (*defaults[:-1], rows)


@pytest.mark.parametrize("name", ["biker_detailed", "biker_summary", "hygiene_incentive_biker", "hygiene_incentive_vehicle"])
def test_rider_branches_share_the_fact_shuffle(tables, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = REPORTS[name](tables)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*zzcons_status", text)) == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("name", ["hygiene_incentive_biker", "biker_summary", "vehicle_summary"])
def test_assignments_are_not_dealt_by_rider(tables, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not re.search(r"Exchange hashpartitioning\(worker_code", plan(REPORTS[name](tables)))


def test_hot_consignment_number_is_split_at_run_time(spark, make, conf, tmp_path):
    """A third of the facts shares one number: the skewed join partition is split and the result stays whole."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "6")
    base = {
        "gpart": "V1", "dox_type": "Dox", "zzcons_status": "DRS", "zzdelivery_date": "05-02-2023 10:00:00",
        "handover_datetime": "05-02-2023 10:00:00", "product": "Premium",
    }
    rows = [base | {"zzconsg_number": "SAME" if i % 3 == 0 else f"C{i}", "zzdest_pincode": str(i), "zzcharge_weight": 3.0}
            for i in range(3000)]
    slab = {
        "vendor_code": "V1", "commercial_category": "Weight", "service_type": "Delivery", "doxtype": "Dox",
        "product_type_it": "Premium", "from_value": 0.0, "to_value": 10.0, "amount": 100.0,
    }
    cod = [{"con_number": "SAME", "delivery_date_timestamp": "05-02-2023 10:00:00", "utr_datetime": "09-02-2023 10:00:00"}]
    rows_by_table = make(
        **{FACTS: rows}, ndv_commercial_master=[slab], cod_remittance=cod,
        ndv_vendor_master=[{"vendor_code": "V1", "vendor_name": "One", "vendor_category": "DLV"}],
    )
    # From files, so that Spark knows the sizes.
    for name in (FACTS, "ndv_commercial_master", "cod_remittance", "ndv_vendor_master", "ndv_kpi_table",
                 "ndv_kpi_master"):
        rows_by_table[name].write.parquet(f"{tmp_path}/{name}")
    tables = ReportTables.parquet(spark, str(tmp_path))
    parcels = tables[FACTS].repartition(6, "zzdest_pincode")
    report = vendor.con_level_with_logs(tables.with_frames(**{FACTS: parcels}))
    df = report.agg(F.sum("net_payable").alias("paid"), F.count("*").alias("n"))
    # 2,000 numbers at 100, and 1,000 rows of the hot one at 100 less the penalty of 50.
    assert tuple(df.collect()[0]) == (250000.0, 3000)
    assert "skew=true" in plan(df).split("== Initial Plan ==")[0]


# ---- invariants between reports -------------------------------------------------------------------------------------


def sums(df, *columns):
    return [round(v or 0.0, 6) for v in df.agg(*[F.sum(c) for c in columns]).collect()[0]]


def test_net_is_the_sum_of_its_parts(tables):
    rows = REPORTS["con_level_with_logs"](tables)
    parts = [f"{k}_{s}" for k in ("fad", "td", "scd") for s in ("incentive", "penalty")]
    total = F.coalesce("commercial", F.lit(0.0)) + F.coalesce("codpenalty", F.lit(0.0))
    for part in parts:
        total = total + F.col(part)
    assert rows.filter(F.abs(F.col("net_payable") - total) > 1e-6).count() == 0


def test_month_totals_equal_the_days(tables):
    rules = VendorRules.v2(cod_sign=1)
    days = vendor.combined_detailed(tables, rules)
    months = vendor.combined_summary(tables, rules)
    assert sums(days, "net_payables", "commercials") == sums(months, "total_payables", "commercial_payable")


def test_biker_consignments_are_the_assigned_ones(tables):
    checked = REPORTS["assignment_check"](tables).filter("model = 'BIKER COMMERCIALS'").select("zzconsg_number").distinct()
    ranked = REPORTS["biker_con_level"](tables).select("consignment").distinct()
    assert checked.exceptAll(ranked).count() == 0 and ranked.exceptAll(checked).count() == 0
