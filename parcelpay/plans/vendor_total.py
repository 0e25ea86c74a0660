"""Vendor total: commercials, high-volume incentives and service-level pay per partner centre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum
from parcelpay.names import KIND
from parcelpay.operators.sla import centre_commercials, centre_months
from parcelpay.plans.sla import BIKER_SUMMARY, VEHICLE_SUMMARY, sla_pay
from parcelpay.rules import COMMERCIALS, HVDI, SlaRules
from parcelpay.sources.tables import ReportTables


def vendor_summary(
    tables: ReportTables, rules: SlaRules | None = None, merge_equal_models: bool = True
) -> DataFrame:
    """Centre with its three parts and their total, one row per month of service-level pay.

    With `merge_equal_models` the sums of two models of a centre that happen to be equal count once, as the report
    defines it; without, every model counts.
    """
    riders = centre_months(tables[BIKER_SUMMARY], "pc_code")
    vehicles = centre_months(tables[VEHICLE_SUMMARY], "vendor_code")
    models = [
        months.groupBy("pc_code", "model", KIND).agg(exact_sum(F.col("payable_amount")).alias("amount"))
        for months in (vehicles, riders)
    ]
    sums = models[0].unionByName(models[1])
    if merge_equal_models:
        sums = sums.select("pc_code", "amount", KIND).distinct()
    commercial, hvdi = F.col(KIND) == COMMERCIALS, F.col(KIND) == HVDI
    centres = (
        sums.groupBy("pc_code")
        .agg(
            exact_sum(F.when(commercial, F.col("amount"))).alias("commercial_payables"),
            F.coalesce(exact_sum(F.when(hvdi, F.col("amount"))), F.lit(0.0)).alias("hvdi_payables"),
            F.coalesce(F.bool_or(commercial), F.lit(False)).alias("_any"),
        )
        .filter("_any")
    )
    pay = sla_pay(tables, centre_commercials(riders), rules or SlaRules()).select("pc_code", "sla_paid")
    rows = centres.join(pay, "pc_code", "left")
    share = F.coalesce("sla_paid", F.lit(0.0))
    return rows.select(
        "pc_code",
        "commercial_payables",
        "hvdi_payables",
        share.alias("incentive_penalty_payables"),
        (F.col("commercial_payables") + F.col("hvdi_payables") + share).alias("total_payables"),
    )
