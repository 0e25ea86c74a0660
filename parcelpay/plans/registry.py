"""Named queries over a star-schema folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpay.operators import calendar, cod, hvdi, kpi, riders
from parcelpay.operators import sla as scores
from parcelpay.operators import consignments as con
from parcelpay.names import FACTS
from parcelpay.plans import assignment, biker, handoff, hygiene, sla, vehicle, vendor_total
from parcelpay.plans import consignments as vendor
from parcelpay.rules import SETTLEMENT_LABELS, HygieneRules, SlaRules, VendorRules
from parcelpay.session import tune
from parcelpay.sources.buckets import co_located
from parcelpay.sources.sinks import shared_folder
from parcelpay.sources.star import star_tables
from parcelpay.sources.tables import ReportTables

# Fixed values of the registered runs, so that results can be compared.
AS_OF = date(2023, 3, 31)
TWO_YEARS = date(2024, 12, 31)
RUN_TS = datetime(2023, 4, 1, 6, 0, 0)
# The published month summary of the registered run knows the remittances before this.
PUBLISHED_AT = datetime(2023, 3, 6)

Report = Callable[[ReportTables], DataFrame]


def _consignments(t: ReportTables, rules: VendorRules) -> DataFrame:
    return con.vendor_consignments(con.read_consignments(t, rules), t, rules)


def _pricing_models(t: ReportTables) -> DataFrame:
    rows = _consignments(t, VendorRules.v2())
    return rows.groupBy("vendor_code", "dox_type", "product", "category_model").agg(
        F.count_distinct("consignment_number").alias("consignments")
    )


def _weight_slab_prices(t: ReportTables) -> DataFrame:
    rules = VendorRules.v2()
    rows = _consignments(t, rules).filter(F.col("category_model") == vendor.WEIGHT)
    priced = con.price_by_weight(rows.distinct(), con.rates_in_force(t, rules), rules)
    keys = ["vendor_code", "dox_type", "product", "zzcharge_weight", "eligible", "commercial"]
    return priced.groupBy(*keys).agg(F.count(F.lit(1)).alias("slab_rows"))


def _shipment_ranks(t: ReportTables, grain: str) -> DataFrame:
    rules = VendorRules.v2().with_(rank_grain=grain)
    rows = _consignments(t, rules).filter(F.col("category_model") == vendor.SHIPMENT)
    columns = ["vendor_code", "consignment_number", "delivered_at", "product", "eligible", "rank"]
    return con.shipment_rank(rows, con.read_consignments(t, rules), rules).select(*columns)


def _rider_hvdi(t: ReportTables) -> DataFrame:
    days = hvdi.rider_hvdi(riders.rider_consignments(t), t["hvdi_incentive"])
    return days.select(
        "pc_code", "biker_code", "vendor_category", "delivery_date", "no_of_consignments", "rate",
        F.col("new_lower_limit").cast("long").alias("new_lower_limit"), "c_slab", "payables",
    )


def _worker_availability(t: ReportTables) -> DataFrame:
    keep = {c: F.col(c) for c in ("biker_code", "pc_code")} | {"onboarding_date": F.col("actvtn_date")}
    rows = riders.assigned(t, riders.workers(t, SETTLEMENT_LABELS), keep)
    rows = riders.with_cluster(rows, t, "gpart", {})
    days = rows.groupBy("biker_code", "pc_code", "onboarding_date", "delivery_date").agg(
        F.count(F.lit(1)).alias("deliveries")
    )
    return riders.with_availability(days)


def _hygiene_week_flags(t: ReportTables) -> DataFrame:
    rules = HygieneRules.biker(AS_OF)
    days = hygiene.rider_days(hygiene.internal_deliveries(t), rules)
    spine = calendar.date_spine(days.sparkSession, rules.start, rules.as_of)
    weeks = hygiene.week_flags(hygiene.rider_weeks(days, rules), calendar.week_calendar(spine))
    return weeks.drop("model")


def _with_summaries(t: ReportTables) -> ReportTables:
    """Hand the month summaries to the reports that read them."""
    return t.with_frames(
        **{sla.BIKER_SUMMARY: biker.biker_summary(t), sla.VEHICLE_SUMMARY: vehicle.vehicle_summary(t)}
    )


def _refreshed_summary(t: ReportTables) -> DataFrame:
    """Vendor months as published before late remittances came in, brought up to date month by month."""
    rules = VendorRules.v2(cod_sign=1)
    remittances = t["cod_remittance"]
    root = shared_folder(remittances.sparkSession, "months")
    facts = handoff.partition_by_month(t[FACTS], f"{root}/facts")
    now = t.with_frames(**{FACTS: facts})
    before = now.with_frames(cod_remittance=remittances.filter(~handoff.arrived(remittances, PUBLISHED_AT)))
    handoff.publish(vendor.combined_summary, before, f"{root}/summary")
    handoff.changed_months(facts, remittances, rules, PUBLISHED_AT).write.parquet(f"{root}/changed")
    months = remittances.sparkSession.read.parquet(f"{root}/changed")
    return handoff.refresh(vendor.combined_summary, now, FACTS, months, f"{root}/summary")


def _published_vendor_summary(t: ReportTables) -> DataFrame:
    """The vendor total over summaries of riders and vehicles that were published and are read from their files."""
    root = shared_folder(t["biker_master"].sparkSession, "summaries")
    riders_ = handoff.publish(biker.biker_summary, t, f"{root}/riders")
    vehicles = handoff.publish(vehicle.vehicle_summary, t, f"{root}/vehicles")
    known = t.with_frames(**{sla.BIKER_SUMMARY: riders_, sla.VEHICLE_SUMMARY: vehicles})
    return vendor_total.vendor_summary(known, SlaRules(RUN_TS))


def _co_located(t: ReportTables, remitted: VendorRules | None = None) -> ReportTables:
    spark = t["biker_master"].sparkSession
    return co_located(t, shared_folder(spark, "by-number"), int(spark.conf.get("spark.sql.shuffle.partitions")), remitted)


def _sla_colours(t: ReportTables) -> DataFrame:
    return scores.centre_colours(scores.centre_scores(t), t["sla_master_table"], SlaRules())


REPORTS: dict[str, Report] = {
    "weight_con_level": lambda t: vendor.weight_con_level(t.v1_slabs()),
    "shipment_con_level": lambda t: vendor.shipment_con_level(t.v1_slabs()),
    "combined_con_level": lambda t: vendor.combined_con_level(t.v1_slabs()),
    "con_level_with_logs": vendor.con_level_with_logs,
    "weight_detailed": lambda t: vendor.weight_detailed(t.v1_slabs()),
    "shipment_detailed": lambda t: vendor.shipment_detailed(t.v1_slabs()),
    "combined_detailed": vendor.combined_detailed,
    "combined_summary": vendor.combined_summary,
    "biker_con_level": biker.biker_con_level,
    "biker_detailed": biker.biker_detailed,
    "biker_summary": biker.biker_summary,
    "vehicle_detailed": vehicle.vehicle_detailed,
    "vehicle_detailed_weight_hvdi": vehicle.vehicle_detailed_weight_hvdi,
    "vehicle_summary": vehicle.vehicle_summary,
    "vehicle_summary_weight_hvdi": vehicle.vehicle_summary_weight_hvdi,
    "hygiene_incentive_biker": lambda t: hygiene.hygiene_incentive_biker(t, HygieneRules.biker(AS_OF)),
    "hygiene_incentive_biker_two_years": lambda t: hygiene.hygiene_incentive_biker(t, HygieneRules.biker(TWO_YEARS)),
    "hygiene_incentive_vehicle": lambda t: hygiene.hygiene_incentive_vehicle(t, HygieneRules.vehicle(AS_OF)),
    "sla_detailed": lambda t: sla.sla_detailed(_with_summaries(t), SlaRules(RUN_TS)),
    "sla_summary": lambda t: sla.sla_summary(_with_summaries(t), SlaRules(RUN_TS)),
    "sla_vehicle_total": lambda t: sla.sla_vehicle_total(_with_summaries(t), SlaRules(RUN_TS)),
    "sla_vehicle": lambda t: sla.sla_vehicle(_with_summaries(t), SlaRules(RUN_TS)),
    "vendor_summary": lambda t: vendor_total.vendor_summary(_with_summaries(t), SlaRules(RUN_TS)),
    "assignment_check": assignment.assignment_check,
    "rider_hvdi": _rider_hvdi,
    "worker_availability": _worker_availability,
    "hygiene_week_flags": _hygiene_week_flags,
    "sla_colours": _sla_colours,
    "pricing_models": _pricing_models,
    "weight_slab_prices": _weight_slab_prices,
    "shipment_ranks": lambda t: _shipment_ranks(t, "timestamp"),
    "shipment_ranks_by_day": lambda t: _shipment_ranks(t, "day"),
    "cod_penalties": lambda t: cod.cod_penalties(t["cod_remittance"], VendorRules.v2()).distinct(),
    "biker_con_level_co_located": lambda t: biker.biker_con_level(_co_located(t)),
    "weight_con_level_co_located": lambda t: vendor.weight_con_level(_co_located(t, VendorRules.v1()).v1_slabs()),
    "combined_summary_refreshed": _refreshed_summary,
    "vendor_summary_published": _published_vendor_summary,
    "kpi_percents": lambda t: kpi.kpi_percents(t["ndv_kpi_table"], t["ndv_kpi_master"]),
}


def run_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The named report over the star-schema files in `root`."""
    return REPORTS[name](star_tables(tune(spark), root))
