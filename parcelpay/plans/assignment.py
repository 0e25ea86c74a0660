"""Reconciliation of deliveries and riders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.times import month_number, parse_stamp
from parcelpay.functions.workers import worker_model
from parcelpay.names import FACTS
from parcelpay.operators.consignments import delivered
from parcelpay.operators.lookups import master_join
from parcelpay.rules import SETTLEMENT_LABELS
from parcelpay.sources.tables import ReportTables


def assignment_check(tables: ReportTables) -> DataFrame:
    """Every delivered consignment of a known centre with its rider, or NULLs where none is assigned."""
    facts = delivered(tables[FACTS]).select(
        "zzconsg_number",
        "gpart",
        month_number(F.to_date(parse_stamp(F.col("zzdelivery_date")))).alias("pay_out_month"),
    )
    facts = master_join(
        facts, tables["cluster_master"], "gpart", "vendor_code",
        {"vendor_code": F.col("vendor_code"), "type": F.col("type")},
    )
    riders = tables["biker_master"].select(
        F.col("biker_code"),
        "pc_code",
        worker_model(F.col("associate"), F.col("attached_to"), SETTLEMENT_LABELS).alias("model"),
    )
    known = master_join(
        tables["biker_code_test"], riders, "worker_code", "biker_code",
        {c: F.col(c) for c in ("pc_code", "biker_code", "model")}, how="left",
    )
    rows = facts.join(known, facts["zzconsg_number"] == known["reference_number"], "left")
    return rows.select(
        "zzconsg_number", "reference_number", "gpart", "vendor_code", "pc_code", "pay_out_month", "worker_code",
        "biker_code", "model", "type",
    ).distinct()
