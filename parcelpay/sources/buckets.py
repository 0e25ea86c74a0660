"""Facts, assignments and remittances stored by consignment number, so that their joins move none of them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parcelpay.names import FACTS, FACTS_V1
from parcelpay.operators.cod import STORED_KEY, cod_key
from parcelpay.rules import VendorRules
from parcelpay.sources.tables import ReportTables

#: The column with the consignment number, by table.
NUMBER = {FACTS: "zzconsg_number", FACTS_V1: "zzconsg_number", "biker_code_test": "reference_number", "cod_remittance": "con_number"}
BUCKETS = 64


def co_located(tables: ReportTables, folder: str, buckets: int = BUCKETS, remitted: VendorRules | None = None) -> ReportTables:
    """The same tables, with the large ones written to `folder` once, in files by buckets of the consignment number.

    Choose as many buckets as tasks of a few hundred megabytes need. A join by the number then reads equal buckets side by
    side, without an exchange or a sort, in every report of every run; the distinct and the counts behind it keep that
    partitioning. The writing job moves each table once, so that a bucket is one file. A bucket is read by one task, so
    this is for numbers of few rows each; where one number holds a large share of all rows, keep the tables as they are,
    and adaptive execution splits it.

    Riders' reports match assignments by the number itself; facts and assignments are stored for them. Vendors' reports
    match remittances by a shortened number: with their rules as `remitted`, their facts are stored with that key and by
    it, and remittances by theirs.
    """
    frames = {}
    facts = FACTS if remitted is None else remitted.fact_table
    matched = "biker_code_test" if remitted is None else "cod_remittance"
    for name in (facts, matched):
        number = NUMBER[name]
        frame, table = tables[name], f"parcelpay_{uuid.uuid4().hex}"
        if name == facts and remitted is not None:
            frame, number = frame.withColumn(STORED_KEY, cod_key(F.col(number), remitted)), STORED_KEY
        rows = frame.repartition(buckets, number).write.option("path", f"{folder}/{name}")
        rows.bucketBy(buckets, number).sortBy(number).saveAsTable(table)
        frames[name] = frame.sparkSession.table(table)
    return tables.with_frames(**frames)
