"""Cash-on-delivery remittances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.times import elapsed_seconds, parse_stamp
from parcelpay.rules import VendorRules

#: The column of a stored fact table that holds `cod_key` already.
STORED_KEY = "_cod_key"


def cod_key(consignment: Column, rules: VendorRules) -> Column:
    """Key under which a consignment is remitted: 12-character numbers lose their suffix of three."""
    if not rules.trim_cod_key:
        return consignment
    return F.when(F.length(consignment) == 12, F.left(consignment, F.lit(9))).otherwise(consignment)


def cod_penalties(remittances: DataFrame, rules: VendorRules) -> DataFrame:
    """Remitted consignments with remittance time and penalty: none within the window, a fixed amount later."""
    remitted = F.col("time_utr_date")
    late = F.lit(float(rules.cod_sign) * rules.cod_penalty)
    stamped = remittances.filter(F.col("utr_datetime").isNotNull()).select(
        "con_number",
        parse_stamp(F.col("utr_datetime")).alias("time_utr_date"),
        parse_stamp(F.col("delivery_date_timestamp")).alias("_delivered"),
    )
    in_time = elapsed_seconds(remitted, F.col("_delivered")) <= rules.window_seconds
    return stamped.select(
        "con_number", "time_utr_date", F.when(in_time, F.lit(0.0)).otherwise(late).alias("cod_penalty")
    )


def distinct_penalties(remittances: DataFrame, rules: VendorRules, with_time: bool = False) -> DataFrame:
    """Penalties by number, and on request remittance times, reduced to the columns in use and merged early."""
    columns = ["time_utr_date", "cod_penalty"] if with_time else ["cod_penalty"]
    return cod_penalties(remittances, rules).select("con_number", *columns).distinct()


def with_cod(facts: DataFrame, penalties: DataFrame) -> DataFrame:
    """Left join of facts (column `cod_key`) with their penalties.

    Both sides reach the join by an exchange of their own, which is what lets Spark split a partition with a hot number
    at run time.
    """
    return facts.join(penalties, facts["cod_key"] == penalties["con_number"], "left").drop("con_number")
