"""RANK that survives a group holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Up to this many rows, one task sorts a group without trouble; larger groups are split.
ROWS_PER_TASK = 1_000_000
# A split group has a piece for each eighth of that many rows, and the sketch that its pieces come from four texts each.
PIECES, OVERSAMPLED = 8, 4
# At most this many groups are split; beyond that many large ones, what counts as large grows with the table.
MOST_SPLIT = 12_500
# A cut is the start of a text, of this many characters.
CUT_CHARS = 64
_LAST = 2**31 - 1


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    load: DataFrame,
    load_keys: Sequence[str],
    out: str = "rank",
    part: str = "_part",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add RANK() of the text column `order` within `keys`, NULLs last.

    `load` shows how rows spread over `load_keys` (columns of both frames) and over `order`; it only steers the split and
    never changes a rank. Groups of more than `rows_per_task` rows are cut at the quantiles of their own texts: each
    stretch between two cuts is ranked by itself, and the rows of the earlier stretches are added. Equal texts lie in one
    stretch, so the sum is the rank over the whole group. The number of stretches grows with the group.

    All of this is one plan: building it runs no job. Rows are dealt by stretch once, for the ranks and for the sizes of
    the stretches, so that whatever `df` is the result of is computed once; the count reads a hash of every column, which
    keeps the optimizer from narrowing its side of the exchange. `df` should thus have no column that the caller drops
    again. Where no group is large, the side that holds the cuts turns out empty at run time, and adaptive execution drops
    what depends on it.

    Rows come back partitioned by the column `part`, which callers may carry through a distinct to reuse it.
    """
    in_order = F.col(order).asc_nulls_last()
    side = cuts(load, load_keys, order, rows_per_task)
    side = F.broadcast(side.select(F.struct(*load_keys).alias("_group"), "_cuts"))
    marked = df.withColumn("_of", F.struct(*load_keys))

    # One struct as partition and join key: NULLs inside it compare equal, and the join needs no second exchange.
    rows = marked.join(side, marked["_of"].eqNullSafe(side["_group"]), "left")
    stretch = F.when(F.col(order).isNull(), _LAST).otherwise(F.size(F.filter("_cuts", lambda c: c <= F.col(order))))
    bucket = F.when(F.col("_cuts").isNotNull(), stretch).otherwise(F.lit(0))
    others = [c for c in df.columns if c not in keys]
    dealt = rows.select(F.struct(*keys, bucket.alias("_bucket")).alias(part), *others).repartition(part)

    ranked = dealt.withColumn("_local", F.rank().over(Window.partitionBy(part).orderBy(in_order)))
    split = dealt.join(side, F.struct(*[F.col(f"{part}.{k}").alias(k) for k in load_keys]).eqNullSafe(side["_group"]))
    sizes = split.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"), F.max(F.xxhash64(part, *others)).alias("_read"))
    sizes = sizes.filter("_read is not null")
    earlier = Window.partitionBy(*[f"{part}.{k}" for k in keys]).orderBy(f"{part}._bucket")
    offsets = sizes.select(
        F.col(part).alias("_of"),
        F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
    )
    joined = ranked.join(offsets, F.col(part) == F.col("_of"), "left")
    return joined.select(
        *[F.col(f"{part}.{c}").alias(c) if c in keys else F.col(c) for c in df.columns],
        (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long").alias(out),
        part,
    )


def cuts(load: DataFrame, keys: Sequence[str], order: str, rows_per_task: int) -> DataFrame:
    """The texts at which to split each large group: `keys` and the sorted array `_cuts`.

    Rows are counted per group on the map side. A large group's sketch deals its texts by hash into cells, as many as its
    rows ask for, and keeps of each cell its row count and the text of the least hash; sketches merge cell by cell, also
    on the map side. A group of few texts has all of them in its sketch, one of many a uniform sample. Where the counts,
    added up in text order, pass a multiple of a piece's rows, there is a cut.

    Together, the cuts are at most PIECES * MOST_SPLIT texts of CUT_CHARS characters, which bounds what is broadcast.
    """
    group = F.struct(*keys)
    counts = load.groupBy(group.alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    least = F.greatest(F.lit(rows_per_task), F.ceil(total / MOST_SPLIT))
    large = counts.select("_key", "_rows", least.alias("_least")).filter(F.col("_rows") > F.col("_least"))
    large = large.select("_key", F.ceil(F.col("_least") / PIECES).alias("_piece"), F.ceil(F.col("_rows") * PIECES * OVERSAMPLED / F.col("_least")).alias("_cells"))
    # A group is only large if it holds more than 1 / MOST_SPLIT of all rows.
    rows = load.select(group.alias("_key"), F.col(order).alias("_text")).filter("_text is not null")
    rows = rows.join(F.broadcast(large), "_key")
    cell = F.pmod(F.xxhash64("_text"), F.col("_cells"))
    sketch = rows.groupBy("_key", "_piece", cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min_by(F.substring("_text", 1, CUT_CHARS), F.xxhash64(F.lit(1), "_text")).alias("_text")
    )
    so_far = F.sum("_rows").over(Window.partitionBy("_key").orderBy("_text", "_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marks = sketch.withColumn("_end", so_far).filter("_end div _piece > (_end - _rows) div _piece")
    texts = marks.groupBy("_key").agg(F.array_sort(F.collect_set("_text")).alias("_cuts"))
    return texts.select("_key.*", "_cuts")
