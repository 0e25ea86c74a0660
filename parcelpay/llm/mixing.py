"""Mixing sources to target weights by systematic sampling over prefix sums of expected copies."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import numbered, words

SHARE = 1.5
MAX_COPIES = 2
WEIGHTS = (3.0, 1.0, 2.0)
SEED = 7_919


def targets(sizes: Mapping[str | None, float], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES) -> dict[str | None, float]:
    """Words each source is to give: `share` of all by weight, none above `most` times its size, the excess reshared.

    Sources take `weights` in turn, by code point, null last.
    """
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal: dict[str | None, float] = {}
    left, open_sources = share * sum(sizes.values()), list(order)
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if left * weight[s] / total > most * sizes[s]]
        if not full:
            return goal | {s: left * weight[s] / total for s in open_sources}
        for s in full:
            goal[s] = most * sizes[s]
        open_sources = [s for s in open_sources if s not in full]
        left = share * sum(sizes.values()) - sum(goal.values())
    return goal


def mix(
    docs: DataFrame, order: Sequence[str] = ("doc_id",), source_col: str = "source", text_col: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES, seed: int = SEED,
) -> DataFrame:
    """`docs` with `mix`: a struct of size, source_size, target and copies, the times the mix takes the row.

    A row's size is its number of words. Each document of a source expects the same copies, target over size. The prefix
    sum of these over the source, plus one random offset of the source, crosses an integer boundary once for each copy.
    Documents are laid out by size first, so every size class gives its share and the words taken stay near the target.
    Prefix sums come from row numbers that are dealt over buckets: a source with most of the rows needs no single task.

    Columns of any names stay as they are, but for one called `mix`, which is replaced. A null text has size 0, a null source is a source of its own and comes last, repeated rows are drawn one by one, and
    an empty table gives an empty one. Only the sizes of sources, one number each, pass the driver. `order` must tell
    rows apart for runs to agree.
    """
    # the whole row as one column, so that no name of the table meets a name of this function
    of = lambda name: F.col("row").getField(name)
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("size", F.size(words(of(text_col))).cast("long"))
    sized = sized.withColumn("source", of(source_col)).withColumns({f"order{i}": of(c) for i, c in enumerate(order)})
    total = {r["source"]: float(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    goal = targets(total, weights, share, most)
    rows = [(s, int(n), goal[s], goal[s] / n if n else 0.0, random.Random(f"{seed}/{s}").random()) for s, n in total.items()]
    plan = docs.sparkSession.createDataFrame(rows, "of string, total long, target double, rate double, start double")
    class_of_size = F.floor(F.log2(F.col("size") + 1) * 16)
    placed = numbered(sized, ["source"], [f"order{i}" for i in range(len(order))], "place", buckets=16, first=class_of_size)
    boundary = lambda n: F.floor(n * F.col("rate") + F.col("start"))
    copies = F.least(boundary(F.col("place") + 1) - boundary(F.col("place")), F.ceil("rate"))
    drawn = placed.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
    mixed = F.struct("size", F.col("total").alias("source_size"), "target", copies.cast("int").alias("copies"))
    return drawn.select(*[of(c).alias(c) for c in docs.columns if c != "mix"], mixed.alias("mix"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it, without the mix column."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("mix.copies"))).alias("mix")
    return mixed.select(*[F.col(f"`{c}`") for c in mixed.columns if c != "mix"], copies).drop("mix")
