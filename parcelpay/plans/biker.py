"""Rider reports: consignment, day and month level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum
from parcelpay.functions.times import distinct_days, month_label, year_number
from parcelpay.names import KIND
from parcelpay.operators.hvdi import rider_hvdi
from parcelpay.operators.riders import rider_consignments, rider_rank, with_availability, with_rider_rate
from parcelpay.rules import COMMERCIALS, BikerRules
from parcelpay.sources.tables import ReportTables

_DETAIL = [
    "delivery_date", "delivery_datetime", "handover_datetime", "pay_out_month", "pay_out_year", "pincode", "sbu",
    "model", "charge_weight", "consignment", "rank", "rate_per_shipment", KIND,
]


def _rated(rows: DataFrame, tables: ReportTables, **split) -> DataFrame:
    """Ranked and rated consignments. They stay partitioned by rider and day, or by `_part` when groups are split."""
    rated = with_rider_rate(rider_rank(rows.drop("product"), tables, **split), tables)
    return rated.withColumns(
        {
            "pay_out_month": month_label(F.col("delivery_date")),
            "pay_out_year": year_number(F.col("delivery_date")),
            KIND: F.lit(COMMERCIALS),
        }
    )


def biker_con_level(tables: ReportTables, **split) -> DataFrame:
    """Consignments of bikers with their sequence number in the day and rate."""
    rated = _rated(rider_consignments(tables), tables, **split)
    columns = ["pc_code", "biker_code", "vendor_category", "onboarding_date", *_DETAIL]
    return rated.select(*columns, "_part").distinct().drop("_part")


def biker_detailed(tables: ReportTables, **split) -> DataFrame:
    """Rider days: commercials with count, highest rate and sum, and high-volume incentives."""
    rows = rider_consignments(tables, with_category=False)
    lines = _rated(rows, tables, **split)
    lines = lines.select("pc_code", "biker_code", "onboarding_date", *_DETAIL, "_part").distinct()
    keys = [
        "pc_code", "biker_code", "onboarding_date", "delivery_date", "pay_out_month", "pay_out_year", "sbu", "model",
    ]
    money = ["no_of_consignments", "rate", "payables", KIND]
    days = lines.groupBy(*keys, KIND).agg(
        F.count("consignment").alias("no_of_consignments"),
        F.max("rate_per_shipment").alias("rate"),
        exact_sum(F.col("rate_per_shipment")).alias("payables"),
    )
    hvdi = rider_hvdi(rows, tables["hvdi_incentive"]).select(*keys, *money).distinct()
    # Each side is distinct and the kind of pay tells them apart.
    return days.select(*keys, *money).unionByName(hvdi)


_MONTH_KEYS = ["pc_code", "vendor_category", "biker_code", "onboarding_date", "pay_out_month", "pay_out_year", "model"]
_MONTH_METRICS = [
    "no_of_days_delivered", "total_consignments", "productivity", "attendance", "no_of_total_working_days",
    "available_for_the_complete_month", "guaranteedamount", "total_commercials", "payable_amount", KIND,
    "cm_type",
]


def biker_summary(tables: ReportTables, rules: BikerRules | None = None, **split) -> DataFrame:
    """Rider months: attendance, productivity, guarantee and pay, and high-volume incentives."""
    rules = rules or BikerRules()
    rows = rider_consignments(tables)
    lines = with_availability(_rated(rows, tables, **split)).select(
        "pc_code",
        "biker_code",
        "vendor_category",
        "onboarding_date",
        *_DETAIL,
        "available_for_the_complete_month",
        "no_of_working_days_in_a_month",
        "no_of_total_working_days",
        "guaranteed_amount",
        "cm_type",
        "_part",
    )
    months = (
        lines.distinct()
        .groupBy(
            *_MONTH_KEYS,
            "guaranteed_amount",
            "no_of_total_working_days",
            "available_for_the_complete_month",
            KIND,
            "no_of_working_days_in_a_month",
            "cm_type",
        )
        .agg(
            distinct_days(F.col("delivery_date")).alias("no_of_days_delivered"),
            F.count_distinct("consignment").alias("total_consignments"),
            exact_sum(F.col("rate_per_shipment")).alias("total_commercials"),
        )
    )
    days, working = F.col("no_of_days_delivered"), F.col("no_of_total_working_days")
    months = months.withColumns(
        {
            "productivity": F.round(F.try_divide(F.col("total_consignments").cast("double"), days), 0),
            "attendance": F.ceil(F.try_divide(days.cast("double") * 100, working.cast("double"))),
        }
    )
    attendance, productivity = F.col("attendance"), F.col("productivity")
    present = (attendance >= rules.internal_attendance) & (F.col("cm_type") == "Internal")
    banded = (productivity >= rules.productivity_low) & (productivity <= rules.productivity_high)
    partner = (attendance >= rules.external_attendance) & (F.col("cm_type") == "External")
    months = months.withColumn(
        "guaranteedamount",
        F.when(present & banded, rules.guarantee)
        .when(present & (productivity > rules.productivity_high), rules.high_guarantee)
        .when(partner, F.coalesce("guaranteed_amount", F.lit(0.0)))
        .otherwise(F.lit(0.0)),
    )
    prorated = F.try_divide(F.col("guaranteedamount") * days, F.col("no_of_working_days_in_a_month"))
    complete = F.col("available_for_the_complete_month")
    earned = F.col("total_commercials")
    pay = (
        F.when((complete == "Yes") & (F.coalesce("guaranteedamount", F.lit(0.0)) > earned), F.col("guaranteedamount"))
        .when((complete == "No") & (F.coalesce(prorated, F.lit(0.0)) > earned), prorated)
        .otherwise(earned)
    )
    commercials = months.withColumn("payable_amount", pay).select(*_MONTH_KEYS, *_MONTH_METRICS).distinct()

    hvdi = rider_hvdi(rows, tables["hvdi_incentive"]).groupBy(*_MONTH_KEYS, KIND, "cm_type")
    hvdi = hvdi.agg(exact_sum(F.col("payables")).alias("payable_amount")).withColumns(
        {
            **{c: F.lit(0).cast("long") for c in ("no_of_days_delivered", "total_consignments", "attendance")},
            **{c: F.lit(0.0) for c in ("productivity", "guaranteedamount", "total_commercials")},
            "no_of_total_working_days": F.lit(0).cast("long"),
            "available_for_the_complete_month": F.lit(" "),
        }
    )
    # Each side is distinct and the kind of pay tells them apart.
    return commercials.unionByName(hvdi.select(*_MONTH_KEYS, *_MONTH_METRICS))
