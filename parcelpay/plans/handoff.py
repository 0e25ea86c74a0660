"""Published month summaries: kept up to date by the months that changed, and read by the reports that build on them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelpay.functions.times import parse_stamp
from parcelpay.operators.cod import cod_key
from parcelpay.operators.consignments import delivered
from parcelpay.rules import VendorRules
from parcelpay.sources.sinks import publish_summary, read_summary
from parcelpay.sources.tables import ReportTables

#: Partition column of facts by month of delivery, and its value where that is unknown.
MONTH, UNKNOWN = "_month", "unknown"

Report = Callable[[ReportTables], DataFrame]


def partition_by_month(facts: DataFrame, path: str) -> DataFrame:
    """The facts as files in one folder per month of delivery, read again."""
    month = F.coalesce(F.date_format(parse_stamp(F.col("zzdelivery_date")), "yyyy-MM"), F.lit(UNKNOWN))
    facts.withColumn(MONTH, month).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    schema = StructType([*facts.schema.fields, StructField(MONTH, StringType())])
    return facts.sparkSession.read.schema(schema).parquet(path)


def arrived(remittances: DataFrame, since: datetime) -> Column:
    """Whether a remittance came at `since` or later; one without a readable time counts as there before."""
    return F.coalesce(parse_stamp(F.col("utr_datetime")) >= F.lit(since), F.lit(False))


def changed_months(facts: DataFrame, remittances: DataFrame, rules: VendorRules, since: datetime) -> DataFrame:
    """`_month` and `parcels`: the months with delivered consignments that a remittance since `since` concerns.

    Reads three columns of the facts; their numbers meet those of the new remittances alone.
    """
    fresh = remittances.filter(arrived(remittances, since)).select(F.col("con_number").alias("cod_key")).distinct()
    numbers = delivered(facts).select(MONTH, cod_key(F.col("zzconsg_number"), rules).alias("cod_key"))
    return numbers.join(fresh, "cod_key", "semi").groupBy(MONTH).agg(F.count(F.lit(1)).alias("parcels"))


def only_months(tables: ReportTables, name: str, months: DataFrame) -> ReportTables:
    """Tables whose facts are those of the given months (column `_month`, `parcels`), at most one row per month.

    The months decide at run time which partitions of the facts are read.
    """
    facts = tables[name]
    # One row per month of the whole history: a few kilobytes for a century.
    wanted = F.broadcast(months.filter("parcels > 0").select(MONTH))
    return tables.with_frames(**{name: facts.join(wanted, MONTH, "semi").select(*facts.columns)})


def publish(report: Report, tables: ReportTables, path: str) -> DataFrame:
    """Publish the whole summary and read it back."""
    publish_summary(report(tables), path)
    return read_summary(report(tables), path)


def refresh(report: Report, tables: ReportTables, name: str, months: DataFrame, path: str) -> DataFrame:
    """Recompute the given months of a published summary, overwrite them alone, and read the summary back.

    Right for reports whose rows each come from the facts of one month, as all month summaries are.
    """
    publish_summary(report(only_months(tables, name, months)), path)
    return read_summary(report(tables), path)
