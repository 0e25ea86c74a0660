"""Merkle manifest of a dataset and proofs by octopus multiproofs.

Rows are leaves. Every `arity` consecutive nodes of a tree become one node, until one is left. Each group of rows (a
source) has a tree over its leaves in id order; the roots of these trees, in group order, are the leaves of a last one.

All nodes above the leaves are a table of coordinates (`tree`, `level`, `idx`) and digests. A leaf partition is a block of
consecutive leaves. It works out which nodes its leaves' paths need that its own leaves don't give, a few for each level
however many leaves it has, fetches these once by a join, computes the shared interior nodes from its leaves, and writes
out each leaf's own proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelpay.llm.common import written

ARITY = 16
#: Leaves of a leaf partition.
BLOCK = 4096
#: The number of the tree over the groups' roots; group trees are numbered from 0.
TOP = -1


def digest_of(columns: Sequence[Column]) -> Column:
    """Lowercase hexadecimal SHA-256 of the values: `-` for null, else the number of UTF-8 bytes, `:` and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """Tables of a manifest, all written: `leaves` (tree, idx, key, leaf, other), `trees` (tree, n), `nodes` (tree, level,
    idx, digest; levels from 1), the number of groups and the root (None without rows)."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    groups: int
    root: str | None
    arity: int


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with `idx`, their place 0, 1, 2 … within `group` in the order of `order` (nulls first), and the groups with
    their number `n` of rows.

    Rows are dealt by ranges of (group, order), so that a large group is spread over tasks, and numbered within each
    range; only the counts of (range, group) meet. Rows equal in both may take each other's places.
    """
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = written(rows.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()), name)
    key = F.struct(*group) if group else F.lit(0)
    counts = dealt.groupBy("__range", key.alias("__group")).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))), f"{name}-counts")
    local = Window.partitionBy("__range", "__group").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    inside = dealt.withColumn("__group", key).withColumn("__local", F.row_number().over(local))
    numbered = inside.join(counts.drop("__rows"), ["__range", "__group"])
    numbered = numbered.withColumn("idx", (F.col("__before") + F.col("__local") - 1).cast("long"))
    sizes = counts.groupBy("__group").agg(F.sum("__rows").alias("n"))
    if group:
        sizes = sizes.select(*[F.col("__group")[c].alias(c) for c in group], "n")
    return numbered.drop("__range", "__group", "__before", "__local"), sizes


def node_levels(base: DataFrame, trees: DataFrame, arity: int, name: str) -> DataFrame | None:
    """`tree`, `level`, `idx`, `digest` of all nodes above `base` (tree, idx, digest); None where no tree has two nodes.

    A level is one aggregation by parent, of at most `arity` digests each, over a table `arity` times as small as before.
    """
    several = trees.filter("n > 1").select("tree", "n")
    height, widest = 0, several.agg(F.max("n")).first()[0] or 1
    while widest > 1:
        height, widest = height + 1, -(-widest // arity)
    found, below = None, base.join(several, "tree")
    for level in range(1, height + 1):
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        up = below.withColumn("parent", F.expr(f"idx div {arity}")).groupBy("tree", "n", "parent").agg(run.alias("run"))
        up = up.select(
            "tree",
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.lit(level).alias("level"),
            F.col("parent").alias("idx"),
            F.sha2(F.array_join(F.transform("run", lambda x: x["digest"]), "").cast("binary"), 256).alias("digest"),
        )
        up = written(up, f"{name}-{level}")
        found = up if found is None else found.unionByName(up)
        below = up.filter("n > 1")
    return None if found is None else found.select("tree", "level", "idx", "digest")


def manifest(rows: DataFrame, key: str, group: str, columns: Sequence[str], other: Column | None = None, arity: int = ARITY) -> Manifest:
    """The manifest of `rows`: a leaf per row over `columns`, trees per `group` (null first, then by UTF-8 bytes).

    Leaves of a tree follow each other by `key` (nulls first), then by digest. `other`, a digest or null, is carried with
    each leaf. Repeated rows are leaves of their own. Only digests are shuffled, never texts.
    """
    spark = rows.sparkSession
    leaves = rows.select(
        F.col(key).alias("key"),
        F.col(group).cast("string").alias("name"),
        digest_of([F.col(c) for c in columns]).alias("leaf"),
        (F.lit(None).cast("string") if other is None else other).alias("other"),
    )
    leaves, names = placed(leaves, ["name"], ["key", "leaf"], "merkle-leaves")
    names, _ = placed(names, [], ["name"], "merkle-groups")
    names = written(names.select("name", F.col("idx").alias("tree"), "n"), "merkle-names")
    tree_of = names.select(F.struct("name").alias("__name"), "tree")
    leaves = leaves.withColumn("__name", F.struct("name")).join(tree_of, "__name")
    leaves = written(leaves.select("tree", "idx", "key", "leaf", "other"), "merkle-numbered")
    groups = names.count()

    base = leaves.select("tree", "idx", F.col("leaf").alias("digest"))
    nodes = node_levels(base, names, arity, "merkle-nodes")
    roots = base.join(names.filter("n = 1").select("tree"), "tree")
    if nodes is not None:
        last = Window.partitionBy("tree").orderBy(F.col("level").desc())
        tops = nodes.filter("idx = 0").withColumn("__last", F.row_number().over(last)).filter("__last = 1")
        roots = roots.unionByName(tops.select("tree", "idx", "digest"))
    roots = written(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest"), "merkle-roots")
    top = spark.createDataFrame([(TOP, groups)], "tree long, n long")
    above = node_levels(roots, top, arity, "merkle-top")
    head = roots if above is None else above.orderBy(F.col("level").desc()).limit(1)
    first = head.select("digest").first()
    every = roots.select("tree", F.lit(0).alias("level"), "idx", "digest")
    for part in (nodes, above):
        every = every if part is None else every.unionByName(part)
    return Manifest(leaves, names.select("tree", "n"), every, groups, first[0] if first else None, arity)


def missing(low: int, high: int, size: int, arity: int) -> Iterator[tuple[int, int]]:
    """(level, idx) of the nodes beside the paths of the leaves `low` to `high` (exclusive) of a tree of `size` leaves that
    these leaves don't give: at most 2 (arity - 1) for each level, and no others are needed."""
    level = 0
    while size > 1:
        start, end = low - low % arity, min(high + -high % arity, size)
        yield from ((level, i) for i in (*range(start, low), *range(high, end)))
        low, high, size, level = low // arity, -(-high // arity), -(-size // arity), level + 1


def hashed(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode("ascii")).hexdigest()


class Interior:
    """The paths of consecutive leaves of one tree: their nodes, computed once, and what stands beside them."""

    def __init__(self, low: int, digests: list[str], size: int, arity: int, fetched: dict[tuple[int, int], str]):
        self.low, self.arity = low, arity
        #: per level: the index of the first run, and the digests of all runs one after the other
        self.levels: list[tuple[int, list[str]]] = []
        known, first, level = digests, low, 0
        while size > 1:
            start, end = first - first % arity, min(first + len(known) + -(first + len(known)) % arity, size)
            full = [fetched[level, i] for i in range(start, first)] + known
            full += [fetched[level, i] for i in range(first + len(known), end)]
            self.levels.append((start, full))
            known = [hashed(full[i : i + arity]) for i in range(0, len(full), arity)]
            first, size, level = start // arity, -(-size // arity), level + 1
        self.root = known[0]
        self._beside: dict[tuple[int, int], list[list[str]]] = {}

    def beside(self, idx: int, level: int = 0) -> list[list[str]]:
        """The siblings of the path of a node, level by level; runs that paths share are looked up once."""
        if level == len(self.levels):
            return []
        if (level, idx) not in self._beside:
            start, full = self.levels[level]
            run = idx - idx % self.arity - start
            own = full[run : run + self.arity]
            mine = idx % self.arity
            rest = self.beside(idx // self.arity, level + 1)
            if level == 0:
                return [own[:mine] + own[mine + 1 :], *rest]
            self._beside[level, idx] = [own[:mine] + own[mine + 1 :], *rest]
        return self._beside[level, idx]

    def folded(self, idx: int, digest: str) -> str:
        """The root that the path of leaf `idx` gives with another digest in its place."""
        for start, full in self.levels:
            run = idx - idx % self.arity - start
            own = list(full[run : run + self.arity])
            if own[idx % self.arity] == digest:
                return self.root  # the rest of the path is the one already computed
            own[idx % self.arity] = digest
            digest, idx = hashed(own), idx // self.arity
        return digest


_REQUEST = "tree long, block long, of long, level int, idx long"


def prove(found: Manifest, block: int = BLOCK, full: bool = False) -> DataFrame:
    """`key`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root` and `verified` of every leaf.

    The proof of a leaf is the siblings on its way to the root, level by level, left to right; `full` adds it as the
    column `proof`, a list of lists. `folded_root` is what the path gives for the leaf's `other` digest, or for the leaf
    itself where that is null; `verified` says whether it is the root. An empty manifest has no proofs.
    """
    arity, groups, root = found.arity, found.groups, found.root
    starts = F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {block}"))).alias("block")
    blocks = found.trees.select("tree", "n", starts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, n, number in zip(*[batch.column(c).to_pylist() for c in ("tree", "n", "block")]):
                low = number * block
                rows += [(tree, number, tree, level, i) for level, i in missing(low, min(low + block, n), n, arity)]
                rows += [(tree, number, TOP, level, i) for level, i in missing(tree, tree + 1, groups, arity)]
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "of", "level", "idx"])

    wanted = blocks.mapInArrow(ask, _REQUEST)
    nodes = found.nodes
    if block % arity:  # blocks that start inside a run need leaves of the neighbours, too
        own = found.leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("digest"))
        nodes = nodes.unionByName(own)
    nodes = nodes.withColumnRenamed("tree", "of")
    key_type = found.leaves.schema["key"].dataType.simpleString()
    fetched = wanted.join(nodes, ["of", "level", "idx"]).select(
        "tree", "block", F.lit(0).alias("kind"), "of", "level", "idx", "digest", F.lit(None).cast("string").alias("other"),
        F.lit(None).cast("long").alias("n"), F.lit(None).cast(key_type).alias("key"),
    )
    leaves = found.leaves.join(found.trees, "tree").select(
        "tree", F.expr(f"idx div {block}").alias("block"), F.lit(1).alias("kind"), F.col("tree").alias("of"), F.lit(0).alias("level"), "idx",
        F.col("leaf").alias("digest"), "other", "n", "key",
    )
    together = fetched.unionByName(leaves).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "of", "level", "idx")
    outputs = ["leaf", "subroot", "folded_root", "proof_sha256"]

    def answer(tree: int, rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        given = {row[1:4]: row[4] for row in rows if row[0] == 0}
        own = [row[3:] for row in rows if row[0] == 1]  # idx, digest, other, n, key
        inside = Interior(own[0][0], [r[1] for r in own], own[0][3], arity, {c[1:]: d for c, d in given.items() if c[0] == tree})
        above = Interior(tree, [inside.root], groups, arity, {c[1:]: d for c, d in given.items() if c[0] == TOP})
        upper = above.beside(tree)
        proofs = [inside.beside(idx) + upper for idx, *_ in own]
        bent = [above.folded(tree, inside.folded(idx, other or digest)) for idx, digest, other, _, _ in own]
        columns = [pa.array([r[4] for r in own], key), pa.array([r[1] for r in own]), pa.array([inside.root] * len(own)), pa.array(bent)]
        columns.append(pa.array([hashed([d for level in p for d in level]) for p in proofs]))
        if full:
            columns.append(pa.array(proofs, pa.list_(pa.list_(pa.string()))))
        return pa.RecordBatch.from_arrays(columns, ["key", *outputs, "proof"][: len(columns)])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["tree", "block", "kind", "of", "level", "idx", "digest", "other", "n", "key"]
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field("key").type]
                yield from zip(*[batch.column(c).to_pylist() for c in columns])

        for (tree, _), group in groupby(rows(), key=itemgetter(0, 1)):
            yield answer(tree, [row[2:] for row in group], types[0])

    schema = f"key {key_type}, " + ", ".join(f"{c} string" for c in outputs) + (", proof array<array<string>>" if full else "")
    proofs = together.mapInArrow(expand, schema)
    extra = ["proof"] if full else []
    return proofs.select(
        "key", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"), *extra,
    )
