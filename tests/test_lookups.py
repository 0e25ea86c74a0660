"""Band joins with and without the search index, against a plain search."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from parcelpay.operators.lookups import BAND_INDEX_KEY, SPLIT, STEPS, band_join, locate, piece_index
from tests.compare import connect, difference
from tests.conftest import SMALL

BANDS = [
    *[("v", float(i), float(i + 1), i) for i in range(1000)],
    ("w", 0.0, 5.0, 1), ("w", 5.0, 9.0, 2), ("w", 3.0, 4.0, 3), ("w", 3.0, 1e9, 4),
    ("x", None, 4.0, 3), ("x", 1.0, None, 4), ("n", 7.0, 2.0, 5), (None, 0.0, 9.0, 6),
]
FACTS = [
    *[("v", i / 4) for i in range(-5, 4020)], *[("w", i / 2) for i in range(-2, 30)],
    ("x", 2.0), ("n", 3.0), (None, 1.0), ("v", None), ("none", 1.0),
]


def frames(spark):
    return spark.createDataFrame(FACTS, "key string, val double"), spark.createDataFrame(BANDS, "k string, lo double, hi double, amt int")


@pytest.mark.parametrize("index", ["true", "false"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_facts_meet_the_bands_that_hold_them(spark, conf, index, how):
    conf(BAND_INDEX_KEY, index)
    facts, bands = frames(spark)
    out = band_join(facts, bands, [("key", F.col("k"))], [("val", F.col("lo"), F.col("hi"))], {"amount": F.col("amt")}, how)
    want = []
    for key, value in FACTS:
        hits = [a for k, low, high, a in BANDS if k == key is not None and None not in (value, low, high) and low <= value <= high]
        want += [(key, value, a) for a in hits] or ([(key, value, None)] if how == "left" else [])
    assert out.columns == ["key", "val", "amount"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_a_fact_meets_no_more_bands_than_touch_its_piece(spark):
    facts, bands = frames(spark)
    facts = facts.filter("key = 'v' and val between 0 and 1000")
    side = bands.select(F.col("k").alias("_key0"), F.col("lo").alias("_low0"), F.col("hi").alias("_high0"), "amt")
    located, pieces = piece_index(facts, side, [("key", "_key0")], "val", bands, "left")
    met = located.join(pieces, (F.col("key") == F.col("_key0")) & (F.col("_piece") == F.col("_piece_of")))
    hits = met.filter("val between _low0 and _high0").count()
    assert hits == facts.count() + 999  # inner limits lie in two bands
    assert met.count() <= 2 * facts.count()


def test_more_limits_than_the_search_tells_apart(spark):
    n = SPLIT**STEPS + 500
    row = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("limits"))
    rows = row.select("limits", F.explode(F.array(*[F.lit(v) for v in (0, 1, 7, SPLIT**STEPS - 1, SPLIT**STEPS, n, None)])).alias("v"))
    found = {r.v: r.piece for r in locate(rows, "limits", "v", "piece").collect()}
    top = SPLIT**STEPS - 1
    assert found == {0: 0, 1: 1, 7: 7, top: top, top + 1: top, n: top, None: None}


@pytest.mark.parametrize(
    "name", ["weight_con_level", "combined_summary", "biker_detailed", "vehicle_summary", "sla_colours", "kpi_percents", "rider_hvdi"]
)
def test_reports_are_the_same_through_the_index(spark, conf, name):
    conf(BAND_INDEX_KEY, "true")
    frame = driver.queries()[name](spark, SMALL)
    assert difference(frame, connect(SMALL), driver.oracle_sql()[name]) is None


def test_reports_without_broadcast_through_the_index(spark, conf):
    conf(BAND_INDEX_KEY, "true")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.parcelpay.broadcastLimitBytes", "0")
    frame = driver.queries()["weight_detailed"](spark, SMALL)
    assert difference(frame, connect(SMALL), driver.oracle_sql()["weight_detailed"]) is None
