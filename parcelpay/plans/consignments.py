"""Vendor reports: consignment, day and month level.

How the rows move: the fact is scanned once per pricing model, with the delivered filter in the scan. Masters, slabs
and KPIs join without moving the fact. The remittance join shuffles by `cod_key`, which depends on the consignment
number alone, so carrying it through the distinct and the distinct count keeps both on that one exchange. Only the
shipment model shuffles twice more, for its distinct and its rank.

The models of two branches never meet in one row because `category_model` is an output column, so the distinct unions
of the reports are plain unions of distinct branches here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum, gain, loss
from parcelpay.functions.times import distinct_days, month_label, month_number, year_number
from parcelpay.operators.cod import distinct_penalties, with_cod
from parcelpay.operators.consignments import (
    price_by_rank,
    price_by_weight,
    rates_in_force,
    read_consignments,
    settle,
    shipment_rank,
    vendor_consignments,
    with_cod_key,
)
from parcelpay.operators.kpi import KPI_NAMES, kpi_percents, with_kpi
from parcelpay.rules import NO_RATE_REMARK, NO_SLAB_REMARK, VendorRules
from parcelpay.sources.tables import ReportTables

WEIGHT, SHIPMENT = "Weight", "Shipment"
_IDENTITY = ["vendor_code", "vendor_name", "consignment_number", "zzcharge_weight", "dox_type", "category_model"]
_MONEY = [
    "commercial",
    *[c for k in KPI_NAMES for c in (k, f"{k}_incentive", f"{k}_penalty")],
    "codpenalty",
    "net_payable",
]


@dataclass(frozen=True)
class _Inputs:
    """What both pricing models start from, built once per report."""

    rules: VendorRules
    read: DataFrame
    base: DataFrame
    rates: DataFrame
    kpis: DataFrame
    kpi_table: DataFrame
    penalties: DataFrame


def _inputs(tables: ReportTables, rules: VendorRules, with_time: bool = False) -> _Inputs:
    read = read_consignments(tables, rules)
    return _Inputs(
        rules=rules,
        read=read,
        base=vendor_consignments(read, tables, rules),
        rates=rates_in_force(tables, rules),
        kpis=kpi_percents(tables["ndv_kpi_table"], tables["ndv_kpi_master"]),
        kpi_table=tables["ndv_kpi_table"],
        penalties=distinct_penalties(tables["cod_remittance"], rules, with_time),
    )


def _settled(facts: DataFrame, inputs: _Inputs) -> DataFrame:
    facts = with_kpi(facts, inputs.kpis, inputs.kpi_table)
    return settle(with_cod(with_cod_key(facts, inputs.rules), inputs.penalties), inputs.rules)


def _weight_rows(inputs: _Inputs, unmodelled: bool = False) -> DataFrame:
    """Settled rows of the weight model, and on request those whose product has no model."""
    wanted = F.col("category_model") == WEIGHT
    if unmodelled:
        wanted = wanted | F.col("category_model").isNull()
    return _settled(price_by_weight(inputs.base.filter(wanted), inputs.rates, inputs.rules), inputs)


def _shipment_rows(inputs: _Inputs) -> DataFrame:
    """Settled rows of the shipment model."""
    facts = inputs.base.filter(F.col("category_model") == SHIPMENT)
    ranked = shipment_rank(facts, inputs.read, inputs.rules)
    return _settled(price_by_rank(ranked, inputs.rates, inputs.rules), inputs)


def _distinct(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct projection on the exchange of the remittance join; `cod_key` follows from the consignment number."""
    return rows.select(*columns, "cod_key").distinct()


# ---- consignment level ----------------------------------------------------------------------------------------------


def _con_level(rows: DataFrame, delivered: str, handed_over: str) -> DataFrame:
    return _distinct(
        rows,
        *_IDENTITY,
        F.col("delivered_at").alias(delivered),
        F.col("handed_over_at").alias(handed_over),
        month_number(F.col("delivery_day")).alias("pay_out_month"),
        "pincode",
        "product",
        "eligible",
        "remarks",
        *_MONEY,
    ).drop("cod_key")


def _weight_con(inputs: _Inputs) -> DataFrame:
    return _con_level(_weight_rows(inputs), "delivery_date", "handover_date")


def _shipment_con(inputs: _Inputs) -> DataFrame:
    return _con_level(_shipment_rows(inputs), "delivery_datetime", "handover_datetime")


def weight_con_level(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Consignments on weight pricing."""
    return _weight_con(_inputs(tables, rules or VendorRules.v1()))


def shipment_con_level(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Consignments on per-shipment pricing."""
    return _shipment_con(_inputs(tables, rules or VendorRules.v1()))


def combined_con_level(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Consignments of both pricing models."""
    inputs = _inputs(tables, rules or VendorRules.v1())
    return _weight_con(inputs).union(_shipment_con(inputs))


def con_level_with_logs(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Consignments of both pricing models and of products without a rate, with the reason for a missing amount."""
    inputs = _inputs(tables, rules or VendorRules.v2(cod_sign=-1), with_time=True)
    unmodelled = F.col("category_model").isNull()
    # A product without a model is paid nothing; its money columns are zeros and its amount and remittance time unknown.
    zeros = {c: F.when(unmodelled, F.lit(0.0)).otherwise(F.col(c)) for c in _MONEY if c != "commercial"}
    blanks = {c: F.when(~unmodelled, F.col(c)) for c in ("commercial", "time_utr_date")}
    weight = _weight_rows(inputs, unmodelled=True).withColumns({**zeros, **blanks})
    branches = [rows.select(*_logged()).distinct().drop("cod_key") for rows in (weight, _shipment_rows(inputs))]
    return branches[0].union(branches[1])


def _logged() -> list[str | Column]:
    reason = (
        F.when(F.col("category_model").isNull(), NO_RATE_REMARK)
        .when(F.col("commercial").isNull(), NO_SLAB_REMARK)
        .otherwise(F.col("remarks"))
    )
    return [
        *_IDENTITY,
        F.col("delivered_at").alias("delivery_date"),
        F.col("handed_over_at").alias("handover_date"),
        "time_utr_date",
        month_label(F.col("delivery_day")).alias("pay_out_month"),
        year_number(F.col("delivery_day")).alias("pay_out_year"),
        "pincode",
        "product",
        "eligible",
        reason.alias("remark"),
        *_MONEY,
        "cod_key",
    ]


# ---- day level ------------------------------------------------------------------------------------------------------


def _day_level(rows: DataFrame, months: dict[str, Column]) -> DataFrame:
    """Vendor, model, day, product and KPI percentages: counts, sums and the percentages split by sign."""
    percents = [f"{k}_percent" for k in KPI_NAMES]
    lines = _distinct(
        rows,
        *_IDENTITY,
        F.col("delivery_day").alias("delivery_date"),
        *[expr.alias(name) for name, expr in months.items()],
        "pincode",
        "product",
        "eligible",
        "remarks",
        *percents,
        *_MONEY,
    )

    def total(kind: str) -> Column:
        columns = [F.col(f"{k}_{kind}") for k in KPI_NAMES]
        return exact_sum(columns[0] + columns[1] + columns[2])

    keys = ["vendor_code", "vendor_name", "category_model", "delivery_date", *months, "product", *percents]
    days = lines.groupBy(*keys).agg(
        # The key belongs to the consignment number, so counting both counts the numbers, on the same exchange.
        F.count_distinct("cod_key", "consignment_number").alias("no_of_consignments_delivered"),
        F.sum(F.when(F.col("eligible") == "Yes", 1).otherwise(0)).alias("no_of_consignments_eligible"),
        exact_sum(F.col("commercial")).alias("commercials"),
        total("incentive").alias("incentive"),
        total("penalty").alias("penalty"),
        exact_sum(F.coalesce("codpenalty", F.lit(0.0))).alias("cod_penalty"),
        exact_sum(F.col("net_payable")).alias("net_payables"),
    )
    up = [gain(F.col(p)) for p in percents]
    down = [loss(F.col(p)) for p in percents]
    return days.select(
        "vendor_code",
        "vendor_name",
        "no_of_consignments_delivered",
        "no_of_consignments_eligible",
        "category_model",
        "delivery_date",
        *months,
        "product",
        "commercials",
        (up[0] + up[1] + up[2]).alias("incentive_percent"),
        "incentive",
        (down[0] + down[1] + down[2]).alias("penalty_percent"),
        "penalty",
        "cod_penalty",
        "net_payables",
    ).distinct()


def _v1_months() -> dict[str, Column]:
    return {"pay_out_month": month_number(F.col("delivery_day"))}


def _v2_months() -> dict[str, Column]:
    day = F.col("delivery_day")
    return {"pay_out_month": month_label(day), "pay_out_year": year_number(day)}


def weight_detailed(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Day view of the weight model."""
    return _day_level(_weight_rows(_inputs(tables, rules or VendorRules.v1())), _v1_months())


def shipment_detailed(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Day view of the shipment model."""
    return _day_level(_shipment_rows(_inputs(tables, rules or VendorRules.v1())), _v1_months())


def combined_detailed(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Day view of both models; late remittance shows as a negative amount."""
    inputs = _inputs(tables, rules or VendorRules.v2(cod_sign=-1))
    weight = _day_level(_weight_rows(inputs), _v2_months())
    return weight.union(_day_level(_shipment_rows(inputs), _v2_months()))


# ---- month level ----------------------------------------------------------------------------------------------------


def combined_summary(tables: ReportTables, rules: VendorRules | None = None) -> DataFrame:
    """Vendor and month: consignments delivered, eligible and failed, days, amounts and the total payable."""
    rules = rules or VendorRules.v2(cod_sign=1)
    days = combined_detailed(tables, rules)
    cod = F.col("cod_penalty") * F.lit(float(rules.cod_sign))
    months = days.groupBy("vendor_code", "vendor_name", "pay_out_month", "pay_out_year").agg(
        F.sum("no_of_consignments_delivered").alias("no_of_consignments_delivered"),
        F.sum("no_of_consignments_eligible").alias("no_of_consignments_eligible"),
        distinct_days(F.col("delivery_date")).alias("days_delivered"),
        exact_sum(F.col("commercials")).alias("commercial_payable"),
        exact_sum(F.col("incentive")).alias("incentives"),
        exact_sum(F.col("penalty") - F.coalesce(cod, F.lit(0.0))).alias("penalty"),
        exact_sum(F.col("net_payables")).alias("total_payables"),
    )
    failed = F.col("no_of_consignments_delivered") - F.col("no_of_consignments_eligible")
    return months.select(
        "vendor_code",
        "vendor_name",
        "no_of_consignments_delivered",
        "no_of_consignments_eligible",
        failed.alias("no_of_consignments_failed_eligibility"),
        "days_delivered",
        "pay_out_month",
        "pay_out_year",
        "commercial_payable",
        "incentives",
        "penalty",
        "total_payables",
    )
