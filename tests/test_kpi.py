"""The KPI intervals of a day, with and without month bins."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

import __spark_entry__ as driver
from parcelpay.operators.kpi import KPI_NAMES, by_month, with_kpi
from parcelpay.operators.lookups import BROADCAST_LIMIT_KEY
from tests.compare import connect, difference
from tests.conftest import SMALL

DAYS = [date(2021, 11, 20) + timedelta(days=i) for i in range(0, 560, 7)] + [date(1999, 1, 1), date(2090, 5, 5), None]


def intervals():
    """Vendors with months of their own, overlaps, an interval without an end, one of a day, and ones that hold no day."""
    rng = random.Random(9)
    rows = [("busy", "Std", date(2022, 1 + m % 12, 1), date(2022, 1 + m % 12, 28), float(m)) for m in range(12)]
    rows += [("busy", "Std", date(2022, 3, 15), date(9999, 12, 31), 50.0), ("busy", "Std", date(2022, 5, 8), date(2022, 5, 8), 51.0)]
    rows += [("busy", "Std", date(2022, 9, 1), date(2022, 2, 1), 52.0), ("busy", "Std", None, date(2022, 2, 1), 53.0), ("busy", "Std", date(2022, 2, 1), None, 54.0)]
    for i in range(40):
        start = date(2022, 1, 1) + timedelta(days=rng.randrange(500))
        rows.append((f"v{i % 9}", "std", start, start + timedelta(days=rng.randrange(400)), float(i)))
    return rows


def frames(spark, folder):
    names = [c for n in KPI_NAMES for c in (n, f"{n}_percent")]
    ddl = "vendor_code string, product string, from_date date, to_date date, " + ", ".join(f"{n} double" for n in names)
    kpis = spark.createDataFrame([(*r[:4], *[r[4]] * len(names)) for r in intervals()], ddl)
    # from files, so that Spark knows the size
    kpis.write.parquet(f"{folder}/kpis")
    kpis = spark.read.parquet(f"{folder}/kpis")
    rng = random.Random(1)
    # two thirds of all facts are of one vendor
    facts = [("busy" if rng.random() < 0.67 else f"v{rng.randrange(11)}", "STD", rng.choice(DAYS), i) for i in range(2000)]
    return spark.createDataFrame(facts, "vendor_code string, product_key string, delivery_day date, number long"), kpis, facts


@pytest.mark.parametrize("limit", ["0", "100000000"])
def test_every_interval_that_holds_the_day_is_found_once(spark, conf, tmp_path, limit):
    conf(BROADCAST_LIMIT_KEY, limit)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows, kpis, facts = frames(spark, tmp_path)
    joined = with_kpi(rows, kpis, kpis)
    assert joined.columns == [*rows.columns, *[c for n in KPI_NAMES for c in (n, f"{n}_percent")]]
    want = []
    for vendor, product, day, number in facts:
        hits = [v for k, p, a, b, v in intervals() if k == vendor and p.upper() == product and None not in (day, a, b) and a <= day <= b]
        want += [(number, v) for v in hits] or [(number, None)]
    assert sorted(map(str, ((r.number, r.fad) for r in joined.collect()))) == sorted(map(str, want))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("_month_bin" in plan) == (limit == "0")
    if limit == "0":
        assert "Exchange hashpartitioning(vendor_code" in plan and "SortMergeJoin [vendor_code" in plan


def test_a_busy_vendor_is_spread_over_its_months(spark, tmp_path):
    rows, kpis, facts = frames(spark, tmp_path)
    dealt, binned = by_month(rows, "delivery_day", kpis)
    largest = max(r["count"] for r in dealt.groupBy("vendor_code", "_month_bin").count().collect())
    busy = sum(f[0] == "busy" for f in facts)
    assert busy > 1200 and largest < busy / 4
    # an interval without an end has no copies beyond the month after the last start
    assert binned.filter("to_date > '9000-01-01'").count() < 24


@pytest.mark.parametrize("name", ["combined_con_level", "weight_detailed"])
def test_reports_are_the_same_with_month_bins(spark, conf, name):
    conf(BROADCAST_LIMIT_KEY, "0")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert difference(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None
