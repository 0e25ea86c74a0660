"""Vendor consignments: reading, pricing model, slab prices and settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import gain, loss, slab_price
from parcelpay.functions.times import parse_stamp, within
from parcelpay.operators.cod import STORED_KEY, cod_key
from parcelpay.operators.kpi import KPI_NAMES
from parcelpay.operators.lookups import band_join, broadcast_within_limit, master_join
from parcelpay.operators.ranking import rank_within
from parcelpay.rules import ANY_DOX, DELIVERED_STATUS, DELIVERY_VENDOR, LATE_REMARK, OVERFLOW_LIMIT, VendorRules
from parcelpay.sources.tables import ReportTables

# Columns that identify a consignment row of the vendor reports.
BASE_COLUMNS = [
    "vendor_code", "vendor_name", "consignment_number", "zzcharge_weight", "dox_type", "category_model",
    "delivered_at", "handed_over_at", "pincode", "product", "eligible", "remarks",
]
RANK_KEYS = {
    "timestamp": ["vendor_code", "delivered_at", "product", "eligible"],
    "day": ["vendor_code", "delivery_day", "product", "eligible"],
}


def delivered(facts: DataFrame) -> DataFrame:
    """Delivered rows only; a comparison with a literal, so it reaches the file scan."""
    return facts.filter(F.col("zzcons_status") == DELIVERED_STATUS)


def rates_in_force(tables: ReportTables, rules: VendorRules) -> DataFrame:
    """Slab table of the rules' service type."""
    rates = tables["ndv_commercial_master"]
    return rates if rules.service_type is None else rates.filter(F.col("service_type") == rules.service_type)


def with_pricing_model(facts: DataFrame, rates: DataFrame, rules: VendorRules) -> DataFrame:
    """Add `category_model`: the model of the exact dox type, else that of the rows for both dox types."""
    models = rates.select(
        F.col(rules.model_column).alias("model"),
        "vendor_code",
        F.upper("doxtype").alias("dox"),
        F.upper("product_type_it").alias("product"),
        (F.col("doxtype") == ANY_DOX).alias("any_dox"),
    ).distinct()
    same_product = [("vendor_code", F.col("vendor_code")), ("product_key", F.col("product"))]
    facts = band_join(
        facts, models, [*same_product, ("dox_key", F.col("dox"))], [], {"_exact": F.col("model")}, sized_by=rates
    )
    facts = band_join(
        facts, models.filter("any_dox"), same_product, [], {"_both": F.col("model")}, sized_by=rates
    )
    return facts.withColumn("category_model", F.coalesce("_exact", "_both")).drop("_exact", "_both")


def read_consignments(tables: ReportTables, rules: VendorRules) -> DataFrame:
    """Delivered rows with parsed times, weight as the rules read it, eligibility and match keys."""
    facts = delivered(tables[rules.fact_table])
    weight = F.col("zzcharge_weight")
    if rules.round_weight:
        weight = F.when(weight < 1, weight).otherwise(F.round(weight, 0))
    facts = facts.select(
        F.col("gpart").alias("vendor_code"),
        F.col("zzconsg_number").alias("consignment_number"),
        weight.alias("zzcharge_weight"),
        "dox_type",
        parse_stamp(F.col("zzdelivery_date")).alias("delivered_at"),
        parse_stamp(F.col("handover_datetime")).alias("handed_over_at"),
        F.col("zzdest_pincode").alias("pincode"),
        "product",
        F.upper("dox_type").alias("dox_key"),
        F.upper("product").alias("product_key"),
        *[c for c in facts.columns if c == STORED_KEY],
    )
    eligible = within(F.col("delivered_at"), F.col("handed_over_at"), rules.window_seconds)
    return facts.withColumns({"delivery_day": F.to_date("delivered_at"), "eligible": eligible})


def vendor_consignments(facts: DataFrame, tables: ReportTables, rules: VendorRules) -> DataFrame:
    """Consignments of delivery vendors, as read, with vendor name and pricing model.

    Rows may repeat here; each report removes repeats where it shuffles anyway.
    """
    vendors = tables["ndv_vendor_master"].filter(F.col("vendor_category") == DELIVERY_VENDOR)
    facts = master_join(facts, vendors, "vendor_code", "vendor_code", {"vendor_name": F.col("vendor_name")})
    if rules.require_rate_row:
        # Any rate row of the vendor will do, so a semi join keeps the rows as they are.
        rated = tables["ndv_commercial_master"]
        facts = facts.join(broadcast_within_limit(rated.select("vendor_code").distinct(), rated), "vendor_code", "semi")
    facts = with_pricing_model(facts, rates_in_force(tables, rules), rules)
    return facts.withColumn("remarks", F.when(F.col("eligible") == "Yes", "").otherwise(LATE_REMARK))


def _slabs(facts: DataFrame, rates: DataFrame, rules: VendorRules, value: str, upper: Column, exact: bool, prefix: str):
    """Slabs of the vendor and product that hold `value`, for the exact dox type or for both dox types."""
    equal = [("vendor_code", F.col("vendor_code")), ("product_key", F.upper("product_type_it"))]
    if exact:
        equal.append(("dox_key", F.upper("doxtype")))
    else:
        rates = rates.filter(F.col("doxtype") == ANY_DOX)
    ranges = [(value, F.col("from_value"), upper)]
    if rules.dated_slabs:
        ranges.append(("delivery_day", F.col("from_date"), F.col("to_date")))
    keep = {f"{prefix}_{c}": F.col(c) for c in ("to_value", "amount", "add_value", "add_amount")}
    return band_join(facts, rates, equal, ranges, keep)


def open_upper() -> Column:
    """Upper limit of a weight slab: the stated one, or the overflow limit when it charges per added step."""
    return F.when(F.col("add_value").isNull(), F.col("to_value")).otherwise(F.lit(float(OVERFLOW_LIMIT)))


def price_by_weight(facts: DataFrame, rates: DataFrame, rules: VendorRules) -> DataFrame:
    """Add `commercial` from every weight slab that holds the weight; 0 when not eligible, NULL without a slab."""
    facts = _slabs(facts, rates, rules, "zzcharge_weight", open_upper(), True, "_x")
    facts = _slabs(facts, rates, rules, "zzcharge_weight", open_upper(), False, "_b")

    def price(p: str) -> Column:
        return slab_price(
            F.col("zzcharge_weight"), *[F.col(f"{p}_{c}") for c in ("to_value", "amount", "add_value", "add_amount")]
        )

    slab = F.when(F.col("_x_amount").isNull(), price("_b")).otherwise(price("_x"))
    paid = F.when(F.col("eligible") == "Yes", slab).otherwise(F.lit(0.0))
    used = [f"{p}_{c}" for p in ("_x", "_b") for c in ("to_value", "amount", "add_value", "add_amount")]
    return facts.withColumn("commercial", F.round(paid, 2)).drop(*used)


def shipment_rank(facts: DataFrame, load: DataFrame, rules: VendorRules, **split) -> DataFrame:
    """Distinct consignments with their sequence number `rank` per vendor, delivery, product and eligibility.

    `load` is the frame before any join; it tells which groups are too large for one task.
    """
    keys = RANK_KEYS[rules.rank_grain]
    rows = facts.select(*BASE_COLUMNS, "delivery_day", "dox_key", "product_key").distinct()
    ranked = rank_within(rows, keys, "consignment_number", load=load.select(*keys, "consignment_number"), load_keys=keys, **split)
    return ranked.drop("_part")


def price_by_rank(facts: DataFrame, rates: DataFrame, rules: VendorRules) -> DataFrame:
    """Add `commercial`: the amount of every slab of the exact dox type that holds the rank."""
    facts = _slabs(facts, rates, rules, "rank", F.col("to_value"), True, "_x")
    return facts.withColumn("commercial", F.col("_x_amount")).drop(
        *[f"_x_{c}" for c in ("to_value", "amount", "add_value", "add_amount")]
    )


def with_cod_key(facts: DataFrame, rules: VendorRules) -> DataFrame:
    """Add `cod_key`, taken from the stored table where that has it: Spark then knows how the rows are dealt."""
    if STORED_KEY in facts.columns:
        return facts.withColumnRenamed(STORED_KEY, "cod_key")
    return facts.withColumn("cod_key", cod_key(F.col("consignment_number"), rules))


def settle(facts: DataFrame, rules: VendorRules) -> DataFrame:
    """Split each KPI percentage of the commercial into incentive and penalty, gate the penalty for late remittance,
    and add up the net amount."""
    earning = (F.col("eligible") == "Yes") & (F.col("commercial") > 0)

    def gated(amount: Column) -> Column:
        return F.when(earning, amount).otherwise(F.lit(0.0))

    parts = {}
    for name in KPI_NAMES:
        share = F.col(f"{name}_percent") * F.col("commercial")
        parts[f"{name}_incentive"] = gated(gain(share) / 100)
        parts[f"{name}_penalty"] = gated(loss(share) / 100)
    facts = facts.withColumns({**parts, "codpenalty": gated(F.col("cod_penalty"))})

    gains = F.coalesce("commercial", F.lit(0.0))
    losses = F.lit(0.0)
    for name in KPI_NAMES:
        gains = gains + F.col(f"{name}_incentive")
        losses = losses + F.col(f"{name}_penalty")
    cod = F.coalesce("codpenalty", F.lit(0.0)) * F.lit(float(rules.cod_sign))
    return facts.withColumn("net_payable", gains + losses - cod)
