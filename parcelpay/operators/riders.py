"""Consignments with the rider who delivered them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.times import available_working_days, full_month, month_working_days, parse_stamp
from parcelpay.functions.workers import worker_model
from parcelpay.names import FACTS
from parcelpay.operators.consignments import delivered
from parcelpay.operators.lookups import band_join, master_join
from parcelpay.operators.ranking import rank_within
from parcelpay.rules import ANY_PRODUCT, PARTNER_CLASSES, SETTLEMENT_LABELS, SBU, ModelLabels
from parcelpay.sources.tables import ReportTables


def workers(tables: ReportTables, labels: ModelLabels, wanted: Column | None = None) -> DataFrame:
    """Rider master with the worker model; `wanted` filters it before it meets the assignments."""
    riders = tables["biker_master"].withColumn("model", worker_model(F.col("associate"), F.col("attached_to"), labels))
    return riders if wanted is None else riders.filter(wanted)


def assigned(
    tables: ReportTables, riders: DataFrame, keep: dict[str, Column], sized_by: DataFrame | None = None
) -> DataFrame:
    """Delivered consignments joined with their assignment and rider, one row per match.

    Riders are matched to the assignments first: only assignments of the wanted riders are shuffled. The one shuffle
    of the facts is by consignment number. `sized_by` bounds the rows of `riders` where these come from a join.
    """
    known = master_join(tables["biker_code_test"], riders, "worker_code", "biker_code", keep, sized_by=sized_by)
    known = known.drop("worker_code")
    facts = delivered(tables[FACTS]).select(
        "gpart",
        F.col("zzconsg_number").alias("consignment"),
        F.col("zzcharge_weight").alias("charge_weight"),
        "product",
        F.col("zzdest_pincode").alias("pincode"),
        F.col("zzdelivery_date").alias("_delivered"),
        F.col("handover_datetime").alias("_handed_over"),
    )
    rows = facts.join(known, facts["consignment"] == known["reference_number"]).drop("reference_number")
    return rows.select(
        *[c for c in rows.columns if c not in ("_delivered", "_handed_over")],
        parse_stamp(F.col("_delivered")).alias("delivery_datetime"),
        parse_stamp(F.col("_handed_over")).alias("handover_datetime"),
    ).withColumn("delivery_date", F.to_date("delivery_datetime"))


def with_cluster(rows: DataFrame, tables: ReportTables, key: str, keep: dict[str, Column]) -> DataFrame:
    """Inner join with the centre master."""
    return master_join(rows, tables["cluster_master"], key, "vendor_code", keep)


def with_availability(rows: DataFrame) -> DataFrame:
    """Add the full-month answer, the working days of the month and those the worker was available."""
    onboarded, day = F.col("onboarding_date"), F.col("delivery_date")
    return rows.withColumns(
        {
            "available_for_the_complete_month": full_month(onboarded, day),
            "no_of_working_days_in_a_month": month_working_days(day),
            "no_of_total_working_days": available_working_days(onboarded, day),
        }
    )


def rider_consignments(tables: ReportTables, with_category: bool = True) -> DataFrame:
    """Distinct consignments of bikers with the city and type of the centre that booked them."""
    bikers = workers(tables, SETTLEMENT_LABELS, F.col("model") == SETTLEMENT_LABELS.biker)
    keep = {
        "pc_code": F.col("pc_code"),
        "biker_code": F.col("biker_code"),
        "onboarding_date": F.col("actvtn_date"),
        "model": F.col("model"),
    }
    if with_category:
        keep["vendor_category"] = F.col("pcc_master")
    rows = assigned(tables, bikers, keep)
    rows = with_cluster(
        rows, tables, "gpart", {"pccity": F.upper("cluster_city"), "cm_type": F.col("type")}
    ).drop("gpart")
    # Like a distinct, but one that stays as it is whatever a report reads of it, so its branches share one shuffle: the
    # filter, which every group passes, needs the count, so the optimizer can neither drop nor merge the aggregate.
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 0").drop("copies")


def rider_rank(rows: DataFrame, tables: ReportTables, **split) -> DataFrame:
    """Add the sequence number of the consignment in the rider's day.

    How assignments spread over riders tells which of them are too large for one task.
    """
    load = tables["biker_code_test"].select(
        F.col("worker_code").alias("biker_code"), F.col("reference_number").alias("consignment")
    )
    return rank_within(
        rows, ["biker_code", "delivery_date"], "consignment", load=load, load_keys=["biker_code"], **split
    )


def partner_slabs(tables: ReportTables, model: str) -> DataFrame:
    """Slabs that price all products of a partner class under one pricing model."""
    return tables["ndv_commercial_master"].filter(
        F.col("category").isin(*PARTNER_CLASSES)
        & (F.col("commercial_category") == model)
        & (F.col("product_type_it") == ANY_PRODUCT)
        & (F.col("service_type") == "Delivery")
    )


def with_rider_rate(rows: DataFrame, tables: ReportTables) -> DataFrame:
    """Add `rate_per_shipment` for the rank: the city slab at internal centres, the partner slab at external ones."""
    rows = band_join(
        rows,
        tables["commercials"],
        equal=[("pccity", F.upper("pc_city")), ("cm_type", F.col("pc_type"))],
        within=[("rank", F.col("no_of_consignments_from"), F.col("no_of_consignments_to"))],
        keep={"_city_rate": F.col("commercials"), "guaranteed_amount": F.col("guaranteed_amount_biker")},
    )
    rows = band_join(
        rows,
        partner_slabs(tables, "Shipment"),
        equal=[("pc_code", F.col("vendor_code"))],
        within=[("rank", F.col("from_value"), F.col("to_value"))],
        keep={"_partner_rate": F.col("amount")},
    )
    rate = F.when(F.col("cm_type") == "Internal", F.col("_city_rate")).when(
        F.col("cm_type") == "External", F.col("_partner_rate")
    )
    return rows.withColumns({"rate_per_shipment": rate, "sbu": F.lit(SBU)}).drop("_city_rate", "_partner_rate")
