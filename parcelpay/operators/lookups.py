"""Joins of large facts with masters, slabs and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

# Largest table, in bytes as stored, that a report offers for broadcast. A session may set another value.
BROADCAST_LIMIT_KEY = "spark.parcelpay.broadcastLimitBytes"
BROADCAST_LIMIT = 32 * 1024 * 1024
# Largest table, in bytes of its rows in memory, that is offered. Repeated values take no room in a file, but all of it in
# the hash table that the driver builds, and a report has up to eight of them at a time. A session may set another value.
BROADCAST_ROWS_KEY = "spark.parcelpay.broadcastLimitRowBytes"
BROADCAST_ROWS = 64 * 1024 * 1024
# A file of less than this part of the limit is taken for a small table without counting its rows.
UNCOUNTED = 1024
# What a row of a hash table holds besides 8 bytes a column (its key and place), and an average text or array.
ROW_BYTES, TEXT_BYTES = 64, 24
# "true" joins bands through a search index: worth its second join where keys have hundreds of bands.
BAND_INDEX_KEY = "spark.parcelpay.bandIndex"


def size_bound(df: DataFrame) -> int | None:
    """Size in bytes that the optimizer states for a frame, or None where it cannot be asked."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:  # a Connect session has no JVM frame
        return None
    return int(str(plan.stats().sizeInBytes()))


def rows_bound(df: DataFrame, sized_by: DataFrame) -> int:
    """Bytes that the rows of a frame with the columns of `df` and as many rows as `sized_by` take in memory, about."""
    wide = [f for f in df.schema.fields if not isinstance(f.dataType, (NumericType, DateType, TimestampType, BooleanType))]
    return sized_by.count() * (ROW_BYTES + 8 * len(df.schema.fields) + TEXT_BYTES * len(wide))


def broadcast_within_limit(df: DataFrame, sized_by: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast only when the stated size and the rows in memory are within their limits.

    `sized_by` is the table whose rows bound `df`, for frames that already went through joins and whose own estimate
    is a product of sizes. Above the limit of files the frame is returned as it is: the join keeps its equality keys, so
    Spark plans a shuffled join and splits skewed partitions at run time. Above the limit of rows it is told to, as Spark
    goes by the stated size.
    """
    if not stated_within_limit(df if sized_by is None else sized_by):
        return df
    return F.broadcast(df) if fits_broadcast(df, sized_by) else df.hint("merge")


def stated_within_limit(df: DataFrame) -> bool:
    """Whether the stated size of a frame, that of its files, is within the session's limit."""
    limit = int(df.sparkSession.conf.get(BROADCAST_LIMIT_KEY, str(BROADCAST_LIMIT)))
    size = size_bound(df)
    return size is not None and size <= limit


def fits_broadcast(df: DataFrame, sized_by: DataFrame | None = None) -> bool:
    """Whether the stated size of a frame, and its rows in memory, are within the session's limits.

    Only where the stated size is neither tiny nor too large, the rows are counted, by a small job: those of `sized_by`,
    and if these are too many, those that `df` really has.
    """
    own, sized_by = sized_by is None, df if sized_by is None else sized_by
    if not stated_within_limit(sized_by):
        return False
    most = int(df.sparkSession.conf.get(BROADCAST_ROWS_KEY, str(BROADCAST_ROWS)))
    if size_bound(sized_by) <= most // UNCOUNTED or rows_bound(df, sized_by) <= most:
        return True
    return not own and rows_bound(df, df) <= most


def band_join(
    facts: DataFrame,
    bands: DataFrame,
    equal: Sequence[tuple[str, Column]],
    within: Sequence[tuple[str | tuple[str, str], Column, Column | None]],
    keep: Mapping[str, Column],
    how: str = "left",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Match each fact with every band of its key whose closed range holds the fact's value.

    equal   pairs of fact column and band expression; always given, so the plan is a hash or merge join
    within  fact column, or start and end columns of a fact interval, with the lower and upper band expression
            (no upper limit when None)
    keep    band expressions to add to the fact, by output name
    A fact inside several bands appears once per band.

    Within a key, every band is a candidate, and the ranges decide. A session that sets `spark.parcelpay.bandIndex` has
    facts meet, through `piece_index`, only the bands near their value; the result is the same.
    """
    keys = {f"_key{i}": band for i, (_, band) in enumerate(equal)}
    lows = {f"_low{i}": low for i, (_, low, _) in enumerate(within)}
    highs = {f"_high{i}": high for i, (_, _, high) in enumerate(within) if high is not None}
    parts = {**keys, **lows, **highs}
    side = bands.select(*[expr.alias(name) for name, expr in {**parts, **keep}.items()])
    sized_by = bands if sized_by is None else sized_by
    pairs = [(fact, f"_key{i}") for i, (fact, _) in enumerate(equal)]
    indexed = facts.sparkSession.conf.get(BAND_INDEX_KEY, "false") == "true"
    if indexed and "_high0" in parts and isinstance(within[0][0], str):
        facts, side = piece_index(facts, side, pairs, within[0][0], sized_by, how)
        pairs = [*pairs, ("_piece", "_piece_of")]
        parts = {**parts, "_piece": None, "_piece_of": None}
    side = broadcast_within_limit(side, sized_by)

    condition = None
    for fact, key in pairs:
        term = facts[fact] == side[key]
        condition = term if condition is None else condition & term
    for i, (fact, _, high) in enumerate(within):
        start, end = (fact, fact) if isinstance(fact, str) else fact
        condition = condition & (facts[start] >= side[f"_low{i}"])
        if high is not None:
            condition = condition & (facts[end] <= side[f"_high{i}"])
    return facts.join(side, condition, how).drop(*parts)


# A search step splits in four; so many steps tell 4 ** STEPS pieces of a key apart, and the last one holds all further.
SPLIT, STEPS = 4, 6


def piece_index(
    facts: DataFrame, side: DataFrame, pairs: Sequence[tuple[str, str]], value: str, sized_by: DataFrame, how: str
) -> tuple[DataFrame, DataFrame]:
    """Facts with the `_piece` of their key's value range that holds `value`, bands once per `_piece_of` they reach into.

    The lower limits of a key cut its values into pieces, and the number of limits up to a value is the number of its
    piece. Each key has one row of sorted limits, which a fact searches by bisection. A band reaches from the piece of
    its lower limit to that of its upper one, so neighbours that touch share one piece, and a fact meets the bands of its
    own piece only instead of all of its key. The caller's join keeps the ranges as conditions; they decide, and only
    there is an overlap of a band with its piece tested.
    """
    names = [key for _, key in pairs]
    limits = side.filter("_low0 is not null").groupBy(*names).agg(F.array_sort(F.collect_set("_low0")).alias("_limits"))
    keyed = [F.col(key).alias(f"{key}_of") for key in names]
    found = broadcast_within_limit(limits.select(*keyed, "_limits"), sized_by)
    on = None
    for fact, key in pairs:
        term = facts[fact] == found[f"{key}_of"]
        on = term if on is None else on & term
    located = locate(facts.join(found, on, how).drop(*[f"{key}_of" for key in names]), "_limits", value, "_piece").drop("_limits")

    bands = side.join(limits, names)
    bands = locate(bands, "_limits", "_low0", "_first")
    bands = locate(bands, "_limits", "_high0", "_last").drop("_limits")
    reached = F.sequence("_first", F.greatest("_first", "_last"))
    return located, bands.filter("_low0 is not null and _high0 is not null").withColumn("_piece_of", F.explode(reached)).drop("_first", "_last")


def locate(rows: DataFrame, limits: str, value: str, out: str) -> DataFrame:
    """`out`: how many of the sorted `limits` are at most `value`. Each step is plain arithmetic on a few array elements,
    so all of them stay in compiled code; null where the row has no limits or no value."""
    column = F.when(F.col(limits).isNotNull() & F.col(value).isNotNull(), F.lit(0))
    for step in range(STEPS - 1, -1, -1):
        rows = rows.withColumn(out, column)
        width = SPLIT**step
        column = F.col(out)
        for k in range(1, SPLIT):
            passed = F.coalesce(F.get(limits, F.col(out) + (k * width - 1)) <= F.col(value), F.lit(False))
            column = column + F.when(passed, width).otherwise(0)
    return rows.withColumn(out, column)


def master_join(
    facts: DataFrame, master: DataFrame, fact_key: str, master_key: str, keep: Mapping[str, Column], how: str = "inner",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Equality join with a master table, broadcast when its size allows."""
    return band_join(facts, master, [(fact_key, F.col(master_key))], [], keep, how, sized_by)
