"""Vendor service KPIs and their percentages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.operators.lookups import band_join, fits_broadcast

# KPI names in the band table, by column of the KPI table.
KPI_NAMES = {"fad": "FAD", "td": "TD", "scd": "SCD"}


def kpi_percents(kpis: DataFrame, bands: DataFrame) -> DataFrame:
    """KPI intervals with the percentage of each score, from bands of the same product that cover the interval."""
    frame = kpis.select("vendor_code", "product", "from_date", "to_date", *KPI_NAMES)
    for column, name in KPI_NAMES.items():
        of_kpi = bands.filter(F.col("kpi_name") == name)
        frame = band_join(
            frame,
            of_kpi,
            equal=[("product", F.col("product"))],
            within=[
                (column, F.col("sla_from"), F.col("sla_to")),
                (("from_date", "to_date"), F.col("from_date"), F.col("to_date")),
            ],
            keep={f"{column}_percent": F.col("sla_percent")},
        )
    return frame


def with_kpi(facts: DataFrame, percents: DataFrame, kpi_table: DataFrame) -> DataFrame:
    """Left join of facts (columns vendor_code, product_key, delivery_day) with the KPI intervals that hold the day.

    `kpi_table` is the table behind `percents`, whose size bounds it. Where it is too large to broadcast, the month of
    delivery becomes one more equality key, so that neither a busy vendor's facts nor all of its intervals meet in one
    place.
    """
    scores = {c: F.col(c) for name in KPI_NAMES for c in (name, f"{name}_percent")}
    equal = [("vendor_code", F.col("vendor_code")), ("product_key", F.upper("product"))]
    held = [("delivery_day", F.col("from_date"), F.col("to_date"))]
    if fits_broadcast(kpi_table):
        return band_join(facts, percents, equal, held, scores, sized_by=kpi_table)
    facts, binned = by_month(facts, "delivery_day", percents)
    return band_join(facts, binned, [*equal, ("_month_bin", F.col("_bin"))], held, scores, sized_by=kpi_table).drop("_month_bin")


def by_month(facts: DataFrame, day: str, intervals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts with the `_month_bin` of their day, and intervals once per `_bin` they reach into.

    Bins are the months up to the last one in which any interval starts, and one for all that follows: which intervals
    hold there is settled by then. So an interval without an end has no more copies than the table has months of history,
    and a day meets each interval in one bin only.
    """
    month = lambda c: F.trunc(c, "month")
    follows = F.add_months(intervals.agg(F.max(month("from_date"))).scalar(), 1)
    whole = intervals.filter("from_date <= to_date")
    reached = F.sequence(month("from_date"), F.least(month("to_date"), follows), F.expr("INTERVAL 1 MONTH"))
    return facts.withColumn("_month_bin", F.least(month(day), follows)), whole.withColumn("_bin", F.explode(reached))
