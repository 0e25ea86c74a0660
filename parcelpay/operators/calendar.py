"""Calendars of the hygiene incentive. Their keys carry no year, so equal months of several years add up."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelpay.functions.times import month_number, week_of_month, weekday_from_sunday


def date_spine(spark: SparkSession, start: date, until: date | None) -> DataFrame:
    """One row `dt` per day from `start` to `until` (today when unset)."""
    end = F.current_date() if until is None else F.lit(until)
    days = F.sequence(F.lit(start), end, F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("dt"))


def week_calendar(spine: DataFrame) -> DataFrame:
    """Days other than Sundays per ISO week and month."""
    day = F.col("dt")
    return spine.groupBy(
        month_number(day).alias("pay_month"), F.weekofyear(day).cast("long").alias("year_week_numbers")
    ).agg(F.sum(F.when(weekday_from_sunday(day) > 0, 1).otherwise(0)).alias("week_days"))


def month_calendar(spine: DataFrame) -> DataFrame:
    """Weeks and Sundays per month."""
    day = F.col("dt")
    sundays = F.sum(F.when(weekday_from_sunday(day) == 0, 1).otherwise(0))
    weeks = spine.groupBy(month_number(day).alias("pay_month"), week_of_month(day).alias("week_num")).agg(
        sundays.alias("_sundays")
    )
    rank = F.rank().over(Window.partitionBy("pay_month").orderBy(F.col("week_num").desc()))
    return (
        weeks.withColumn("_rank", rank.cast("long"))
        .groupBy("pay_month")
        .agg(F.max("_rank").alias("month_week"), F.sum("_sundays").alias("sunday_count"))
    )
