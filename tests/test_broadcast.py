"""Tables that are small as files and large in memory stay off the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelpay.operators.lookups import BROADCAST_ROWS_KEY, band_join, broadcast_within_limit, fits_broadcast, size_bound


def rates_of(spark, path, vendors=20_000):
    """A price list of each vendor: a few bytes a row as stored."""
    rows = spark.range(vendors * 15).select(
        F.concat(F.lit("V"), F.lpad(F.floor(F.col("id") / 15).cast("string"), 5, "0")).alias("vendor_code"), F.lit("Premium").alias("product"),
        F.lit("Both").alias("dox"), *[(F.col("id") % 15 + k).cast("double").alias(c) for k, c in enumerate(("low", "high", "amount", "step"))],
    )
    rows.repartitionByRange(1, "vendor_code").write.parquet(path)
    return spark.read.parquet(path)


def test_rows_in_memory_decide_as_well(spark, tmp_path, conf):
    rates = rates_of(spark, f"{tmp_path}/rates")
    conf(BROADCAST_ROWS_KEY, str(32 << 20))
    assert size_bound(rates) < 4 << 20  # far below the limit of files
    assert not fits_broadcast(rates) and fits_broadcast(rates.limit(5000))
    assert fits_broadcast(rates.select("low").limit(100), rates.limit(100))
    assert fits_broadcast(rates.select("vendor_code").distinct(), rates)  # as few rows as there are vendors
    assert "strategy=broadcast" not in broadcast_within_limit(rates)._jdf.queryExecution().analyzed().toString()
    conf(BROADCAST_ROWS_KEY, str(128 << 20))
    assert fits_broadcast(rates)


def test_the_shuffled_join_gives_the_same_rows(spark, tmp_path, conf):
    rates = rates_of(spark, f"{tmp_path}/rates", 4000)
    facts = spark.range(3000).select(F.concat(F.lit("V"), F.lpad((F.col("id") % 5000).cast("string"), 5, "0")).alias("vendor"), (F.col("id") % 16).cast("double").alias("w"))
    conf("spark.sql.autoBroadcastJoinThreshold", "10m")  # the file is smaller than that; its rows are not to go to the driver

    def joined():
        return band_join(facts, rates, [("vendor", F.col("vendor_code"))], [("w", F.col("low"), F.col("high"))], {"amount": F.col("amount")})

    small = joined()
    conf(BROADCAST_ROWS_KEY, "1000000")
    large = joined()
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, large.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
