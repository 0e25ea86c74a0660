"""Service-level reports of partner centres.

They read the month summaries of riders and vehicles, handed over as frames or as tables under these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.names import KIND
from parcelpay.operators.lookups import band_join
from parcelpay.operators.sla import (
    centre_colours,
    centre_commercials,
    centre_months,
    centre_scores,
    colour_percents,
    stamp,
    vehicle_colour,
    with_sla_pay,
)
from parcelpay.rules import COMMERCIALS, SlaRules
from parcelpay.sources.tables import ReportTables

# Names under which the month summaries are handed over.
BIKER_SUMMARY, VEHICLE_SUMMARY = "biker_summary_view_test", "vehicle_summary_view_test"

_COLOURS = ["fad_colour", "td_colour", "scd_colour"]
_PAY = ["commercial_amount", "payables_percentage", "sla_paid", KIND]


def _commercials(summary: DataFrame, code: str) -> DataFrame:
    """Commercials per centre and month; the filter reaches into the summary and drops its incentive branch."""
    return centre_commercials(centre_months(summary.filter(F.col(KIND) == COMMERCIALS), code))


def sla_pay(tables: ReportTables, commercials: DataFrame, rules: SlaRules) -> DataFrame:
    """Colours and pay of internal centres, one row per month with commercials (or one without)."""
    scores = centre_colours(centre_scores(tables), tables["sla_master_table"], rules)
    rows = band_join(
        scores,
        colour_percents(tables["sla_master_table"]),
        equal=[("sla_final_colour", F.col("colour"))],
        within=[],
        keep={"payables_percentage": F.col("incentive")},
        sized_by=tables["sla_master_table"],
    )
    rows = rows.join(commercials, "pc_code", "left")
    return with_sla_pay(rows).withColumn("timestamp", stamp(rules))


def sla_detailed(tables: ReportTables, rules: SlaRules | None = None) -> DataFrame:
    """Centre with its three colours, category, final colour and service-level pay."""
    commercials = _commercials(tables[BIKER_SUMMARY], "pc_code")
    rows = sla_pay(tables, commercials, rules or SlaRules())
    columns = ["pc_code", "timestamp", *_COLOURS, "category", "sla_final_colour", *_PAY, "total_payables"]
    return rows.select(*columns).distinct()


def sla_summary(tables: ReportTables, rules: SlaRules | None = None) -> DataFrame:
    """The detailed view without the three colours."""
    return sla_detailed(tables, rules).drop(*_COLOURS).distinct()


def sla_vehicle_total(tables: ReportTables, rules: SlaRules | None = None) -> DataFrame:
    """Centre with vehicle commercials: RED or GREEN, pay and total."""
    rules = rules or SlaRules()
    commercials = _commercials(tables[VEHICLE_SUMMARY], "vendor_code")
    rows = vehicle_colour(centre_scores(tables), rules).join(commercials, "pc_code")
    percent = F.when(F.col("sla_colour") == "RED", rules.vehicle_red_percent).otherwise(F.lit(0.0))
    rows = with_sla_pay(rows.withColumn("payables_percentage", percent)).withColumn("timestamp", stamp(rules))
    return rows.select("pc_code", "timestamp", "sla_colour", *_PAY, "total_payables").distinct()


def sla_vehicle(tables: ReportTables, rules: SlaRules | None = None) -> DataFrame:
    """The vehicle view without the total, which the other columns determine."""
    return sla_vehicle_total(tables, rules).drop("total_payables")
