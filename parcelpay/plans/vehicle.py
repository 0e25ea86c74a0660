"""Vehicle reports: consignment and day level, and month level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum
from parcelpay.functions.times import distinct_days, month_label, year_number
from parcelpay.names import KIND
from parcelpay.operators.riders import with_availability
from parcelpay.operators.vehicles import vehicle_consignments, vehicle_hvdi, with_vehicle_price
from parcelpay.rules import COMMERCIALS, HVDI, SBU, VehicleRules
from parcelpay.sources.tables import ReportTables

_DETAIL = [
    "vehicle_number", "vehicle_code", "vendor_code", "onboarding_date", "delivery_date", "delivery_datetime",
    "handover_datetime", "pay_out_month", "pay_out_year", "product", "pincode", "sbu", "model", "consignment",
    "charge_weight", "no_of_consignment_number", "incentives", "payables", KIND, "cm_type",
]


def _with_month(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumns(
        {
            "pay_out_month": month_label(F.col("delivery_date")),
            "pay_out_year": year_number(F.col("delivery_date")),
            "sbu": F.lit(SBU),
            KIND: F.lit(kind),
        }
    )


def vehicle_detailed(tables: ReportTables, rules: VehicleRules | None = None) -> DataFrame:
    """Priced consignments of vehicles, and their high-volume incentives by day."""
    rules = rules or VehicleRules()
    rows = vehicle_consignments(tables, with_category=False)
    priced = _with_month(with_vehicle_price(rows, tables), COMMERCIALS).withColumns(
        {
            "payables": F.col("commercials"),
            "no_of_consignment_number": F.lit(0).cast("long"),
            "incentives": F.lit(0.0),
        }
    )
    hvdi = _with_month(vehicle_hvdi(rows, tables["vehicle_hvdi"], rules), HVDI).withColumns(
        {
            "onboarding_date": F.lit(None).cast("date"),
            "delivery_datetime": F.lit(None).cast("timestamp"),
            "handover_datetime": F.lit(None).cast("timestamp"),
            "product": F.lit(" "),
            "pincode": F.lit(" "),
            "consignment": F.lit("0"),
        }
    )
    # Each side is distinct and the kind of pay tells them apart.
    return priced.select(*_DETAIL).distinct().unionByName(hvdi.select(*_DETAIL).distinct())


def vehicle_detailed_weight_hvdi(tables: ReportTables) -> DataFrame:
    return vehicle_detailed(tables, VehicleRules(hvdi_basis="weight"))


_MONTH_KEYS = [
    "vehicle_number", "vehicle_code", "vendor_code", "vendor_category", "cm_type", "onboarding_date", "pay_out_month",
    "pay_out_year", "model",
]
_MONTH_METRICS = [
    "no_of_days_delivered", "no_of_consignments", "productivity", "no_of_working_days_in_a_month",
    "no_of_total_working_days", "attendance", "available_for_the_complete_month", "guaranteed_amount",
    "guaranteed_payables", "commercials_payables", "payable_amount", KIND,
]


def vehicle_summary(tables: ReportTables, rules: VehicleRules | None = None) -> DataFrame:
    """Vehicle months: attendance, productivity, guarantee and pay, and high-volume incentives."""
    rules = rules or VehicleRules()
    rows = vehicle_consignments(tables)
    lines = with_availability(_with_month(with_vehicle_price(rows, tables), COMMERCIALS))
    lines = lines.drop("copies", "hvdi_model", "pc_code").distinct()
    months = lines.groupBy(
        *_MONTH_KEYS,
        "no_of_working_days_in_a_month",
        "no_of_total_working_days",
        "guaranteed_amount",
        KIND,
        "available_for_the_complete_month",
    ).agg(
        distinct_days(F.col("delivery_date")).alias("no_of_days_delivered"),
        F.count_distinct("consignment").alias("no_of_consignments"),
        exact_sum(F.col("commercials")).alias("commercials_payables"),
    )
    days, guarantee = F.col("no_of_days_delivered"), F.col("guaranteed_amount")
    prorated = F.try_divide(guarantee * days, F.col("no_of_working_days_in_a_month"))
    months = months.withColumns(
        {
            "productivity": F.round(F.try_divide(F.col("no_of_consignments").cast("double"), days), 0),
            "attendance": F.ceil(
                F.try_divide(days.cast("double") * 100, F.col("no_of_total_working_days").cast("double"))
            ),
            "guaranteed_payables": F.when(F.col("available_for_the_complete_month") == "No", prorated).otherwise(
                guarantee
            ),
        }
    )
    earned = F.col("commercials_payables")
    present = F.col("attendance") >= rules.attendance_min
    better = F.coalesce("guaranteed_payables", F.lit(0.0)) > earned
    pay = F.when(present & better, F.col("guaranteed_payables")).otherwise(earned)
    commercials = months.withColumn("payable_amount", pay)

    hvdi = _with_month(vehicle_hvdi(rows, tables["vehicle_hvdi"], rules), HVDI)
    hvdi = hvdi.withColumn("onboarding_date", F.lit(None).cast("date")).groupBy(*_MONTH_KEYS, KIND)
    hvdi = hvdi.agg(exact_sum(F.col("payables")).alias("payable_amount")).withColumns(
        {
            **{
                c: F.lit(0).cast("long")
                for c in (
                    "no_of_days_delivered", "no_of_consignments", "no_of_working_days_in_a_month",
                    "no_of_total_working_days", "attendance",
                )
            },
            **{
                c: F.lit(0.0)
                for c in ("productivity", "guaranteed_amount", "guaranteed_payables", "commercials_payables")
            },
            "available_for_the_complete_month": F.lit(" "),
        }
    )
    # Every group key is an output column, so the sides are distinct; the kind of pay tells them apart.
    columns = [*_MONTH_KEYS, *_MONTH_METRICS]
    return commercials.select(*columns).unionByName(hvdi.select(*columns))


def vehicle_summary_weight_hvdi(tables: ReportTables) -> DataFrame:
    return vehicle_summary(tables, VehicleRules(hvdi_basis="weight", attendance_min=90))
