"""Consignments delivered by vehicles, their prices and high-volume incentives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum, slab_price
from parcelpay.functions.workers import worker_model
from parcelpay.operators.consignments import open_upper
from parcelpay.operators.lookups import band_join
from parcelpay.operators.riders import assigned, partner_slabs, with_cluster, workers
from parcelpay.rules import HVDI_LABELS, SETTLEMENT_LABELS, VehicleRules
from parcelpay.sources.tables import ReportTables


def vehicle_consignments(tables: ReportTables, with_category: bool = True) -> DataFrame:
    """Distinct consignments of vehicles with `copies`, how often each one came.

    Prices work on the distinct rows and day weights on all of them; one frame serves both, so the facts are scanned
    and shuffled once.
    """
    vehicles = workers(tables, SETTLEMENT_LABELS, F.col("model") != SETTLEMENT_LABELS.biker)
    keep = {
        "vehicle_number": F.col("vehicle"),
        "vehicle_code": F.col("biker_code"),
        "pc_code": F.col("pc_code"),
        "onboarding_date": F.col("actvtn_date"),
        "model": F.col("model"),
        "hvdi_model": worker_model(F.col("associate"), F.col("attached_to"), HVDI_LABELS),
    }
    if with_category:
        keep["vendor_category"] = F.col("pcc_master")
    rows = assigned(tables, vehicles, keep)
    rows = with_cluster(rows, tables, "gpart", {"vendor_code": F.col("vendor_code"), "cm_type": F.col("type")})
    rows = rows.drop("gpart")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def with_vehicle_price(rows: DataFrame, tables: ReportTables) -> DataFrame:
    """Add `commercials` and the guarantee of the worker model.

    Internal centres pay every slab whose lower limit the weight reaches, external ones the slabs that hold it.
    """
    rows = band_join(
        rows,
        tables["vehicle_commercials"],
        equal=[("pc_code", F.col("pc_code"))],
        within=[("charge_weight", F.col("amount_of_weight_from"), None)],
        keep={
            "_i_low": F.col("amount_of_weight_from"),
            # The limit is a text that counts in whole kilograms.
            "_i_high": F.round(F.col("amount_of_weight_to").cast("double"), 0),
            "_i_base": F.col("commercials"),
            "_i_step": F.col("additional_weight"),
            "_i_rate": F.col("additional_amount_per_kg"),
            "_with_boy": F.col("guarantee_amount_per_vehicle_with_biker"),
            "_without_boy": F.col("guaranteed_amount_per_vehicle_without_biker"),
        },
    )
    rows = band_join(
        rows,
        partner_slabs(tables, "Weight"),
        equal=[("pc_code", F.col("vendor_code"))],
        within=[("charge_weight", F.col("from_value"), open_upper())],
        keep={
            "_e_low": F.col("from_value"),
            "_e_high": F.col("to_value"),
            "_e_base": F.col("amount"),
            "_e_step": F.col("add_value"),
            "_e_rate": F.col("add_amount"),
        },
    )

    def price(p: str):
        high, base, step, rate, low = [F.col(f"_{p}_{c}") for c in ("high", "base", "step", "rate", "low")]
        return slab_price(F.col("charge_weight"), high, base, step, rate, lower=low)

    commercials = F.when(F.col("cm_type") == "Internal", price("i")).when(F.col("cm_type") == "External", price("e"))
    guarantee = F.when(F.col("model") == SETTLEMENT_LABELS.vehicle_with_boy, F.col("_with_boy")).when(
        F.col("model") == SETTLEMENT_LABELS.vehicle_without_boy, F.col("_without_boy")
    )
    rows = rows.withColumns({"commercials": commercials, "guaranteed_amount": guarantee})
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


def vehicle_hvdi(rows: DataFrame, slabs: DataFrame, rules: VehicleRules) -> DataFrame:
    """Incentive per vehicle and day at internal centres: the rate of the day's count or weight, per whole kilogram."""
    identity = [
        c
        for c in ("vehicle_number", "vehicle_code", "vendor_code", "vendor_category", "pc_code", "cm_type")
        if c in rows.columns
    ]
    days = (
        rows.filter(F.col("cm_type") == "Internal")
        .groupBy(*identity, F.col("hvdi_model").alias("model"), "delivery_date")
        .agg(
            F.count_distinct("consignment").alias("no_of_consignment_number"),
            exact_sum(F.col("charge_weight") * F.col("copies")).alias("_weight"),
        )
        .withColumns({"_whole": F.rint("_weight").cast("long"), "charge_weight": F.ceil("_weight").cast("double")})
    )
    if rules.hvdi_basis == "count":
        basis, low, high = "no_of_consignment_number", "no_of_consignments_from", "no_of_consignments_to"
    else:
        basis, low, high = "_whole", "charge_weight_from", "charge_weight_to"
    paid = band_join(
        days,
        slabs,
        equal=[("model", F.col("model")), ("pc_code", F.col("pc_code"))],
        within=[(basis, F.col(low), F.col(high))],
        keep={"incentives": F.col("incentives")},
    )
    return paid.withColumn("payables", F.col("charge_weight") * F.col("incentives")).drop("_weight", "_whole")
