"""Hygiene incentive: Sundays worked and consignments closed in time, per rider and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelpay.functions.times import full_month, month_number, week_of_month, weekday_from_sunday, within
from parcelpay.operators.calendar import date_spine, month_calendar, week_calendar
from parcelpay.operators.lookups import master_join
from parcelpay.operators.riders import assigned, workers
from parcelpay.rules import HYGIENE_LABELS, HygieneRules
from parcelpay.sources.tables import ReportTables

_RIDER = ["pc_code", "biker_code", "vendor_category"]


def internal_deliveries(tables: ReportTables) -> DataFrame:
    """Delivered consignments of riders of internal centres, which may repeat; the centre filter sits on the rider side."""
    riders = workers(tables, HYGIENE_LABELS)
    internal = tables["cluster_master"].filter(F.col("type") == "Internal")
    riders = master_join(riders, internal, "pc_code", "vendor_code", {})
    keep = {
        "pc_code": F.col("pc_code"),
        "biker_code": F.col("biker_code"),
        "vendor_category": F.col("pcc_master"),
        "onboarding_date": F.col("actvtn_date"),
        "model": F.col("model"),
    }
    # A centre has one row, so the join above keeps the riders' number.
    rows = assigned(tables, riders, keep, sized_by=tables["biker_master"])
    return rows.select(*keep, "consignment", "delivery_datetime", "handover_datetime", "delivery_date")


def rider_days(rows: DataFrame, rules: HygieneRules) -> DataFrame:
    """The state of a rider's day from which all roll-ups are taken: `failures`, the distinct consignments not closed in
    time, and `profiles`, the master rows (category, start, model) under which the rider delivered.

    A consignment counts once however many master rows a rider has. Counting distinct failures lets the map side drop
    every consignment closed in time, and the days' counts are disjoint, so months just add them up. A delivery without a
    day is in no month and goes.

    All three results are aggregates, and the filter, which every day passes, reads them all: so no roll-up's own columns
    or join keys reach below, each keeps the whole state, and they share its exchange.
    """
    late = within(F.col("delivery_datetime"), F.col("handover_datetime"), rules.window_seconds) == "No"
    # NULL times and numbers would not count inside a distinct, a struct of them does.
    failure = F.when(late, F.struct("consignment", "delivery_datetime", "handover_datetime"))
    profile = F.struct("vendor_category", "onboarding_date", "model")
    days = rows.filter("delivery_date is not null").groupBy("pc_code", "biker_code", "delivery_date").agg(
        F.count_distinct(failure).alias("failures"),
        F.collect_set(profile).alias("profiles"),
        F.max(month_number(F.col("delivery_date"))).alias("pay_out_month"),
    )
    return days.filter((F.col("failures") >= 0) & (F.size("profiles") > 0) & (F.col("pay_out_month") > 0))


def rider_weeks(days: DataFrame, rules: HygieneRules) -> DataFrame:
    """Weekdays and Sundays worked per rider, month and week, with the week's place counted from the last one.

    Only riders of the rules' models who were available for the whole month count.
    """
    day = F.col("delivery_date")
    eligible = F.col("model").isin(*rules.models) & (full_month(F.col("onboarding_date"), day) == "Yes")
    profiles = days.select("pc_code", "biker_code", "delivery_date", "pay_out_month", F.inline("profiles"))
    days = profiles.filter(eligible).select(*_RIDER, "model", "delivery_date", "pay_out_month").distinct()
    weekday = weekday_from_sunday(day)
    weeks = days.groupBy(
        *_RIDER,
        "model",
        "pay_out_month",
        week_of_month(day).alias("week_num"),
        F.weekofyear(day).cast("long").alias("year_week_number"),
    ).agg(
        F.sum(F.when(weekday > 0, 1).otherwise(0)).alias("weekdays"),
        F.sum(F.when(weekday == 0, 1).otherwise(0)).alias("weekends"),
    )
    rank = F.rank().over(Window.partitionBy("biker_code").orderBy(F.col("week_num").desc_nulls_first()))
    return weeks.withColumn("rank", rank.cast("long"))


def week_flags(weeks: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add whether every working day of the week was worked, and whether exactly one Sunday was."""
    # At most 12 months times 53 weeks.
    side = F.broadcast(calendar)
    on = (weeks["pay_out_month"] == side["pay_month"]) & (weeks["year_week_number"] == side["year_week_numbers"])
    rows = weeks.join(side, on, "left")
    return rows.withColumns(
        {
            "attendance_incentive": F.when(F.col("weekdays") == F.col("week_days"), 1).otherwise(0).cast("long"),
            "sunday_incentive": F.when(F.col("weekends") == 1, 1).otherwise(0).cast("long"),
        }
    ).drop("pay_month", "year_week_numbers", "week_days")


def closure_failures(days: DataFrame) -> DataFrame:
    """Consignments not closed in time per rider and month; riders without failures show 0."""
    return days.groupBy("pc_code", "biker_code", "pay_out_month").agg(F.sum("failures").alias("delivery_failure"))


def hygiene_incentive(tables: ReportTables, rules: HygieneRules) -> DataFrame:
    """Rider months with Sunday, closure and total incentive."""
    days = rider_days(internal_deliveries(tables), rules)
    spine = date_spine(days.sparkSession, rules.start, rules.as_of)
    months = week_flags(rider_weeks(days, rules), week_calendar(spine)).groupBy(*_RIDER, "pay_out_month", "model").agg(
        F.sum("sunday_incentive").alias("_sundays_worked")
    )
    # Twelve rows at most.
    calendar = F.broadcast(month_calendar(spine))
    months = months.join(calendar, months["pay_out_month"] == calendar["pay_month"], "left")
    failures = closure_failures(days)
    rows = months.join(failures, ["pc_code", "biker_code", "pay_out_month"], "left")
    share = F.try_divide(F.col("_sundays_worked").cast("double"), F.col("sunday_count"))
    closure = F.when(F.col("delivery_failure") == 0, F.lit(rules.rate)).otherwise(F.lit(0.0))
    return rows.select(
        *_RIDER,
        "pay_out_month",
        F.col("model").alias("model_type"),
        F.round(share * rules.rate, 0).alias("sunday_incentive"),
        closure.alias("consignment_closure_incentive"),
    ).withColumn("total_incentives", F.col("sunday_incentive") + F.col("consignment_closure_incentive"))


def hygiene_incentive_biker(tables: ReportTables, rules: HygieneRules | None = None) -> DataFrame:
    return hygiene_incentive(tables, rules or HygieneRules.biker())


def hygiene_incentive_vehicle(tables: ReportTables, rules: HygieneRules | None = None) -> DataFrame:
    return hygiene_incentive(tables, rules or HygieneRules.vehicle())
