"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelpay.session import shuffles_freed

#: The characters between words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once for each row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs of other characters than `SPACES`; an empty array for a null text."""
    flat = F.coalesce(text, F.lit(""))
    for space in SPACES[1:]:
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all other characters as they are."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(lowered)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`; on one machine without that setting, a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="parcelpay-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written as a table to the shared folder and read again: cuts lineage and outlives lost executors.

    Nothing reads the shuffle files of the write once it is done, so they go with it.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, name)
    with shuffles_freed(spark):
        rows.write.parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    table.written_to = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables from `written` that nothing reads any more; frames made from them can't run afterwards."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(conf).delete(path, True)


def numbered(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], out: str, buckets: int = 256, first: Column | None = None
) -> DataFrame:
    """`out`: 0, 1, 2 … within the rows of equal `group`, the same on every run with the same rows.

    Rows are dealt into hash buckets of `order`, numbered within (group, bucket) and shifted by the rows of the group's
    earlier buckets, so no task needs a whole group. `first`, an integer of few values, orders before the buckets. Nulls in `group` are a value of their own. Rows equal in `order`
    are numbered in any way; give enough columns to tell rows apart.
    """
    keys = [f"__g{i}" for i in range(len(group))]
    split = rows.withColumns({k: F.struct(F.col(g)) for k, g in zip(keys, group)} or {"__g0": F.lit(0)})
    keys = keys or ["__g0"]
    place = F.pmod(F.xxhash64(*order), F.lit(buckets))
    split = split.withColumn("__bucket", place if first is None else first.cast("long") * buckets + place)
    cell = Window.partitionBy(*keys, "__bucket")
    before = Window.partitionBy(*keys).orderBy("__bucket")
    base = (
        split.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, "__bucket", (F.sum("__n").over(before) - F.col("__n")).alias("__base"))
    )
    local = split.withColumn("__local", F.row_number().over(cell.orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    return (
        local.join(base, [*keys, "__bucket"])
        .withColumn(out, F.col("__base") + F.col("__local") - 1)
        .drop(*keys, "__bucket", "__base", "__local")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """`id`, `component`: the smallest id reachable over `edges` (a, b) for each id that occurs in an edge.

    Every round gives each id the smallest label among its own and its neighbours', then jumps along labels, and writes
    the labels, so the number of rounds grows with the logarithm of the longest path in practice.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-edges",
    )
    last = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), f"{name}-labels")
    labels = last
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        hooked = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        # an id's label also takes over what its label's own row has found
        lead = hooked.select(F.col("id").alias("component"), F.col("component").alias("further"))
        fresh = written(hooked.join(lead, "component", "left").select("id", "was", F.coalesce("further", "component").alias("component")), f"{name}-labels")
        forget(last)
        last, labels = fresh, fresh.select("id", "component")
        if fresh.filter("was <> component").isEmpty():
            forget(both)
            return labels
