"""Where inputs come from and where summaries go."""

from __future__ import annotations

import re
from datetime import date

import duckdb
import pytest

from parcelpay.operators.calendar import date_spine, month_calendar, week_calendar
from parcelpay.sources import star
from parcelpay.sources.fixture_sql import DUCKDB, SPARK, STAR_TABLES, code, padded, with_clause
from parcelpay.sources.schemas import SCHEMAS
from parcelpay.names import FACTS
from parcelpay.sources.sinks import publish_summary
from parcelpay.sources.tables import ReportTables
from tests.compare import connect
from tests.conftest import SMALL


@pytest.mark.parametrize("name", [FACTS, "cod_remittance", "biker_code_test", "ndv_commercial_master",
                                  "biker_master", "vehicle_hvdi", "sla_master_table"])
def test_derived_inputs_are_the_same_in_both_engines(spark, name):
    con = connect(SMALL)
    result = con.execute(f"{with_clause(DUCKDB, [name])} SELECT * FROM {name}")
    want = sorted(tuple(map(str, row)) for row in result.fetchall())
    frame = star.star_tables(spark, SMALL)[name]
    assert [f.name for f in spark.createDataFrame([], SCHEMAS[name]).schema] == sorted(
        frame.columns, key=[c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")].index
    )
    order = [c[0] for c in con.execute(f"{with_clause(DUCKDB, [name])} SELECT * FROM {name}").description]
    assert sorted(tuple(map(str, row)) for row in frame.select(*order).collect()) == want


def test_every_customer_and_supplier_is_used(spark):
    tables = star.star_tables(spark, SMALL)
    assert tables["biker_master"].count() == spark.read.parquet(f"{SMALL}/customer.parquet").count()
    assert tables["cluster_master"].count() == spark.read.parquet(f"{SMALL}/supplier.parquet").count()
    assert "events" not in STAR_TABLES


def test_lines_are_moved_once_to_become_parcels(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = star.derive(spark, SMALL, "parcel")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L, \d+\)", plan)) == 1
    # the other one moves the orders; no lines are sorted or aggregated before theirs
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Aggregate" not in plan.split("Exchange hashpartitioning(l_orderkey")[1].split("Exchange")[0]


def test_tables_are_written_only_to_a_shared_folder(spark, tmp_path):
    assert star.star_tables(spark, SMALL, "")["cluster_master"].inputFiles()[0].endswith("supplier.parquet")
    assert f"{tmp_path}/" in star.star_tables(spark, SMALL, f"{tmp_path}")["cluster_master"].inputFiles()[0]


def test_keys_stay_apart_beyond_their_width(spark):
    """Riders, centres and consignments of large tables keep keys of their own, in both engines."""
    numbers = [1, 99_999, 100_000, 100_009, 149_999, 1_499_990, 10**8 - 1, 10**8, 10**9 + 7, 4 * 10**12]
    for d, run in ((SPARK, lambda q: spark.sql(q).collect()), (DUCKDB, lambda q: duckdb.connect().execute(q).fetchall())):
        values = " UNION ALL ".join(f"SELECT CAST({n} AS BIGINT) AS o" for n in numbers)
        rows = run(f"SELECT {code('B', 'o')}, {padded(d.base36.format('o'), 8)} FROM ({values}) x")
        assert len({r[0] for r in rows}) == len({r[1] for r in rows}) == len(numbers)
        assert {len(r[1]) for r in rows if r[1] < "0ZZZZZZZ"} == {8}


def test_publishing_a_month_leaves_other_months(spark, tmp_path):
    months = lambda *m: spark.createDataFrame([(1.0, "2023", x) for x in m], "pay double, pay_out_year string, pay_out_month string")
    publish_summary(months("January", "March"), f"{tmp_path}/s")
    publish_summary(months("March"), f"{tmp_path}/s")
    assert sorted(r["pay_out_month"] for r in spark.read.parquet(f"{tmp_path}/s").collect()) == ["January", "March"]


def test_catalog_tables(spark, make):
    frames = make(cluster_master=[{"vendor_code": "V1", "cluster_city": "Town", "type": "Internal"}])
    frames["cluster_master"].createOrReplaceGlobalTempView("cluster_master")
    tables = ReportTables.catalog(spark, "global_temp")
    assert [r["vendor_code"] for r in tables["cluster_master"].collect()] == ["V1"]


def test_month_bounds_prune_fact_partitions(spark, make, tmp_path):
    rows = [{"gpart": f"V{m}", "zzcons_status": "DRS"} for m in (1, 2, 3)]
    fact = make(**{FACTS: rows})[FACTS]
    dated = fact.selectExpr("*", "make_date(2023, CAST(substr(gpart, 2) AS INT), 15) AS delivery_month")
    dated.write.partitionBy("delivery_month").parquet(f"{tmp_path}/fact")
    tables = ReportTables.of({FACTS: spark.read.parquet(f"{tmp_path}/fact"), "cluster_master": fact})
    bounded = tables.between_months("delivery_month", date(2023, 2, 20), date(2023, 3, 1))
    assert sorted(r["gpart"] for r in bounded[FACTS].collect()) == ["V2", "V3"]
    plan = bounded[FACTS]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery_month" in plan
    assert bounded["cluster_master"].count() == 3


def test_calendars(spark):
    spine = date_spine(spark, date(2022, 7, 1), date(2023, 3, 31))
    assert spine.count() == 274
    months = {r["pay_month"]: r for r in month_calendar(spine).collect()}
    # January 2023 has five Sundays; its first one still belongs to ISO week 52.
    assert months[1]["sunday_count"] == 5 and months[2]["sunday_count"] == 4
    assert 4 not in months
    weeks = {(r["pay_month"], r["year_week_numbers"]): r["week_days"] for r in week_calendar(spine).collect()}
    assert weeks[(1, 52)] == 0 and weeks[(1, 1)] == 6 and weeks[(2, 5)] == 4
