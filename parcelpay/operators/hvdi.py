"""High-volume delivery incentives of riders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelpay.functions.times import month_label, year_number
from parcelpay.names import KIND
from parcelpay.operators.lookups import band_join
from parcelpay.rules import HVDI, SBU


def progressive_slabs(slabs: DataFrame) -> DataFrame:
    """Slabs with the pay already earned in the lower ones (`c_slab`).

    The second slab of a city and type starts at the lowest start of the whole table. Slabs are ranked per city as
    written and summed per city in capitals.
    """
    lowest = slabs.agg(F.min("no_of_consignments_from")).scalar()
    rank = F.rank().over(Window.partitionBy("pc_city", "pc_type").orderBy("no_of_consignments_to"))
    ranked = slabs.select(
        "pc_type",
        F.upper("pc_city").alias("pc_city"),
        F.col("no_of_consignments_from").alias("lower_limit"),
        F.col("no_of_consignments_to").alias("upper_limit"),
        "incentives",
        rank.alias("_rank"),
    )
    start = F.when(F.col("_rank") == 2, lowest).otherwise(F.col("lower_limit"))
    totals = ranked.withColumn("new_lower_limit", start).drop("_rank")
    totals = totals.withColumn(
        "slab_total", (F.col("upper_limit") - F.col("new_lower_limit") + 1) * F.col("incentives")
    )
    by_city = Window.partitionBy("pc_city", "pc_type").orderBy("upper_limit")
    running = F.sum("slab_total").over(by_city.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = totals.withColumn("cum_slab_total", running)
    return totals.withColumn("c_slab", F.lag("cum_slab_total", 1).over(by_city))


def rider_day_counts(rows: DataFrame) -> DataFrame:
    """Distinct consignments per rider, day and centre city at internal centres."""
    identity = [c for c in ("pc_code", "biker_code", "vendor_category", "model") if c in rows.columns]
    internal = rows.filter(F.col("cm_type") == "Internal")
    return internal.groupBy(*identity, "delivery_date", "pccity", "cm_type").agg(
        F.count_distinct("consignment").alias("no_of_consignments")
    )


def rider_hvdi(rows: DataFrame, slabs: DataFrame) -> DataFrame:
    """Incentive per rider and day; unknown where no slab holds the day's count.

    Days of one rider in two cities merge when everything else about them agrees.
    """
    counts = rider_day_counts(rows)
    paid = band_join(
        counts,
        progressive_slabs(slabs),
        equal=[("pccity", F.col("pc_city")), ("cm_type", F.col("pc_type"))],
        within=[("no_of_consignments", F.col("lower_limit"), F.col("upper_limit"))],
        keep={"rate": F.col("incentives"), "new_lower_limit": F.col("new_lower_limit"), "c_slab": F.col("c_slab")},
        sized_by=slabs,
    )
    above = (F.col("no_of_consignments") - F.col("new_lower_limit") + 1) * F.col("rate")
    return (
        paid.withColumns(
            {
                "payables": F.coalesce("c_slab", F.lit(0.0)) + above,
                "pay_out_month": month_label(F.col("delivery_date")),
                "pay_out_year": year_number(F.col("delivery_date")),
                "sbu": F.lit(SBU),
                KIND: F.lit(HVDI),
                "onboarding_date": F.lit(None).cast("date"),
            }
        )
        .drop("pccity")
        .distinct()
    )
