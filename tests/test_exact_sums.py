"""Money adds up to the same whatever the order of rows and partial sums."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum
from parcelpay.names import FACTS
from parcelpay.plans import biker
from parcelpay.plans import consignments as vendor
from parcelpay.plans import vehicle
from parcelpay.sources.star import star_tables
from tests.conftest import SMALL

PARTITIONS = (1, 7, 211)


def test_sum_is_exact_in_any_order(spark):
    rng = random.Random(4)
    amounts = [round(rng.uniform(-1e6, 1e6), 6) for _ in range(5000)] + [0.1] * 1000 + [None]
    want = float(sum((Fraction(round(a * 10**6), 10**6) for a in amounts if a is not None), Fraction(0)))
    for n in PARTITIONS:
        rng.shuffle(amounts)
        rows = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(n)
        assert rows.agg(exact_sum(F.col("a"))).collect()[0][0] == want
    none = spark.createDataFrame([(None,)], "a double")
    assert none.agg(exact_sum(F.col("a"))).collect()[0][0] is None


@pytest.mark.parametrize(
    "report", [vendor.combined_detailed, vendor.combined_summary, biker.biker_summary, vehicle.vehicle_summary], ids=lambda r: r.__name__
)
def test_reports_over_fractional_amounts_are_bitwise_equal(spark, conf, report):
    """Amounts of a seventh and a third more than the fixtures', weights with a fraction, three ways of dealing the rows."""
    tables = star_tables(spark, SMALL)
    slabs = tables["ndv_commercial_master"].withColumns({c: F.round(F.col(c) * 8 / 7 + 1 / 3, 4) for c in ("amount", "add_amount")})
    rates = tables["commercials"].withColumns({c: F.round(F.col(c) * 8 / 7 + 1 / 3, 4) for c in ("commercials", "guaranteed_amount_biker")})
    loads = tables["vehicle_commercials"].withColumn("commercials", F.round(F.col("commercials") * 8 / 7, 4))
    facts = tables[FACTS].withColumn("zzcharge_weight", F.round(F.col("zzcharge_weight") + F.lit(0.1), 1))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    results = set()
    for n in PARTITIONS[:2]:
        conf("spark.sql.shuffle.partitions", str(n))
        dealt = facts.repartition(n, F.xxhash64("zzconsg_number", F.lit(n)))
        rows = report(tables.with_frames(**{FACTS: dealt, "ndv_commercial_master": slabs, "commercials": rates, "vehicle_commercials": loads}))
        results.add(tuple(sorted(repr(tuple(r)) for r in rows.collect())))
    assert len(results) == 1
