"""Report tables on top of star-schema parquet files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelpay.session import shuffles_freed
from parcelpay.sources.fixture_sql import SPARK, STAR_TABLES, needed, table_sql, with_clause
from parcelpay.sources.schemas import SCHEMAS
from parcelpay.sources.tables import ReportTables

CHECKPOINT_KEY = "spark.checkpoint.dir"
_staged: dict[tuple[str, str, str], ReportTables] = {}


def derive(spark: SparkSession, root: str, name: str, ready: dict[str, str] | None = None) -> DataFrame:
    """One derived table from the star-schema files in `root`; `ready` holds paths of tables already written."""
    tables = table_sql(SPARK) | {t: f"SELECT * FROM parquet.`{path}`" for t, path in (ready or {}).items()}
    if name not in tables:
        raise KeyError(name)
    sources = ",\n".join(f"{t} AS (SELECT * FROM parquet.`{root}/{t}.parquet`)" for t in STAR_TABLES)
    return spark.sql(f"{with_clause(SPARK, [name], extra=sources, tables=tables)}\nSELECT * FROM {name}")


def star_tables(spark: SparkSession, root: str, folder: str | None = None) -> ReportTables:
    """Report inputs derived from the star-schema files in `root`.

    Where there is a folder that all executors share (`folder`, or what the session names in `spark.checkpoint.dir`), a
    table is written there on first use, once per application, and read from its files from then on, as the reports would read a warehouse table: with
    column pruning, pushed filters and known sizes. Without such a folder nothing is written, and every query derives its
    inputs as part of its own plan.
    """
    shared = spark.conf.get(CHECKPOINT_KEY, None) if folder is None else folder
    key = (spark.sparkContext.applicationId, root, shared)
    if not shared:
        return ReportTables(lambda name: derive(spark, root, name))
    if key not in _staged:
        own = f"{shared.rstrip('/')}/parcelpay-{uuid.uuid4().hex}"

        ready: dict[str, str] = {}

        def write(name: str) -> str:
            path = f"{own}/{name}"
            with shuffles_freed(spark):
                derive(spark, root, name, ready).write.mode("overwrite").parquet(path)
            return path

        def staged(name: str) -> DataFrame:
            # The fact-side tables share their parcels, which are aggregated once.
            if "parcel" in needed(table_sql(SPARK), [name]) and "parcel" not in ready:
                ready["parcel"] = write("parcel")
            return spark.read.schema(SCHEMAS[name]).parquet(write(name))

        _staged[key] = ReportTables(staged)
    return _staged[key]
