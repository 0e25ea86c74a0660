"""Where reports get their input tables from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpay.names import FACTS, FACTS_V1
from parcelpay.sources.schemas import SCHEMAS, SCHEMAS_V1

FACT_TABLES = (FACTS, FACTS_V1)
# Other large tables, which some warehouses partition by date as well.
DAILY_TABLES = ("biker_code_test", "cod_remittance")


class ReportTables:
    """Input frames by table name, opened on first use."""

    def __init__(self, opener: Callable[[str], DataFrame]):
        self._opener = opener
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._opener(name)
        return self._frames[name]

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> "ReportTables":
        return cls(lambda name: frames[name])

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, v1: bool = False) -> "ReportTables":
        """One parquet data set per table under `root`, read with the declared schema."""
        schemas = SCHEMAS_V1 if v1 else SCHEMAS
        return cls(lambda name: spark.read.schema(schemas[name]).parquet(f"{root}/{name}"))

    @classmethod
    def catalog(cls, spark: SparkSession, database: str) -> "ReportTables":
        return cls(lambda name: spark.table(f"{database}.{name}"))

    def with_frames(self, **frames: DataFrame) -> "ReportTables":
        """The same tables with some of them replaced."""
        return ReportTables(lambda name: frames[name] if name in frames else self[name])

    def v1_slabs(self) -> "ReportTables":
        """Present the newer slab table in its older shape: `category` is the pricing model of delivery rates."""
        slabs = self["ndv_commercial_master"].filter(F.col("service_type") == "Delivery")
        slabs = slabs.withColumn("category", F.col("commercial_category"))
        return self.with_frames(ndv_commercial_master=slabs.drop("commercial_category", "service_type"))

    def between_months(self, column: str, first: date, last: date) -> "ReportTables":
        """Read only partitions whose date column `column` lies in the two months or between them.

        It bounds the fact tables, and the assignments and remittances where they have that column too. The filter sits
        on a partition column, so files of other months are not listed for reading. A remittance must be in the months
        of its delivery for this, not in those of its payment.
        """

        def bounded(name: str) -> DataFrame:
            frame = self[name]
            if name not in FACT_TABLES and not (name in DAILY_TABLES and column in frame.columns):
                return frame
            end = F.last_day(F.lit(last).cast("date"))
            return frame.filter((F.col(column) >= F.lit(first.replace(day=1))) & (F.col(column) <= end))

        return ReportTables(bounded)
