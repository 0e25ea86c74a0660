"""Sharding: a Feistel permutation of global row numbers, with cycle walking, gives shard and slot of each row."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import let, numbered

ROUNDS = 6
WALKS = 64
SEED = 20_241


def domain(n: int) -> tuple[int, int]:
    """Two factors whose product is at least `n` and over it by less than the larger one."""
    a = max(1, isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permuted(x: Column, n: int, seed: int = SEED) -> Column:
    """The place of row number `x` in a fixed permutation of 0 … n-1.

    Alternating Feistel rounds add a keyed hash of one half to the other, modulo the two factors of the domain. A value
    beyond n-1 is encrypted again until it falls inside. The domain has fewer than sqrt(n) + 1 values too many: up to
    n = 4096 that many walks always suffice, beyond it each walk fails with a chance under 1/64. Were all used up, the
    query would stop with an error instead of giving a wrong place.
    """
    a, b = domain(n)

    def turn(i: int):
        """Round `i`: one half gets a keyed hash of the other added."""
        keyed = lambda half, size: F.pmod(F.xxhash64(F.lit(seed), F.lit(i), half), F.lit(size))
        if i % 2:
            return lambda p: F.struct(p["l"].alias("l"), ((p["r"] + keyed(p["l"], b)) % b).alias("r"))
        return lambda p: F.struct(((p["l"] + keyed(p["r"], a)) % a).alias("l"), p["r"].alias("r"))

    def once(v: Column) -> Column:
        pair = F.struct(F.floor(v / b).cast("long").alias("l"), (v % b).alias("r"))
        for i in range(ROUNDS):
            pair = let(pair, turn(i))
        return let(pair, lambda p: p["l"] * b + p["r"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once(x), lambda v, _: F.when(v < n, v).otherwise(once(v)))
    return let(walked, lambda v: F.when(v < n, v).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long")))


def shard(rows: DataFrame, shards: int, order: list[str], seed: int = SEED) -> DataFrame:
    """`rows` with `shard` and `slot`: a shuffle of all rows dealt round to the shards, so counts differ by one at most.

    The row number is the place by hash bucket and then value of `order`, which must tell rows apart (rows equal in all
    of it may swap places); it is the same on every run. Nulls in `order` are values like others. Existing columns named
    `shard` or `slot` are replaced. An empty table gives an empty one. Copies are not kept together: a group that holds a
    third of all rows could not lie in one shard while counts stay equal.
    """
    n = rows.count()
    placed = numbered(rows.drop("shard", "slot"), [], order, "__row", buckets=1024)
    return (
        placed.withColumn("__place", permuted(F.col("__row"), n, seed))
        .withColumns({"shard": (F.col("__place") % shards).cast("int"), "slot": F.floor(F.col("__place") / shards).cast("long")})
        .drop("__row", "__place")
    )
