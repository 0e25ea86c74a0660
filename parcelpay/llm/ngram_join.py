"""Documents linked by the Jaccard similarity of their word shingles: a partition-based join, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import components, forget, let, lower_ascii, words, written

SHINGLE = 5
PERCENT = 80
#: Rows of a bucket that are compared in one piece.
BLOCK = 4096
#: Buckets of document ids: the bound of the table that thins documents out before their shuffle.
ID_BUCKETS = 1 << 18
#: Parts of the signature space, so many at least, and the signatures that make another part worth while. A part is dealt
#: to one task, which sorts it on disk if need be; the fewer parts, the more signatures of a set travel in one row.
LEAST_PARTS, PART_SIZE = 64, 1 << 25


def shingle_set(text: Column, k: int) -> Column:
    """Sorted distinct 64-bit hashes of the text's runs of `k` words, A to Z in lower case.

    A text of fewer words has its whole sequence as the one shingle, one without words has none.
    """

    def hashes(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        whole = F.array(F.xxhash64(F.lit("whole"), F.array_join(w, " ")))
        return F.when(n == 0, F.array().cast("array<long>")).when(n < k, whole).otherwise(runs)

    return F.sort_array(F.array_distinct(let(words(lower_ascii(text)), hashes)))


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= percent * union of their shingle sets; component_id is the smallest id
    reachable over links. Documents without words (null and empty texts) link with nothing and are their own component.
    Every row counts by its own text: rows that share an id may lie in different components. Rows of null id take part and
    link others; their component's id is null only where no row of it has an id. Other columns are not read. Shingles and
    sets are told apart by 64-bit hashes. An empty table gives an empty result.
    """
    rows, labels, _ = grouped(docs, shingle, percent, id_col, text_col)
    return (
        rows.join(labels, "k", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def grouped(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`rows` (doc_id, n, k), `labels` (k, component_id) and `chosen` (doc_id, k), one set for each component.

    Equal sets are one class, named by the hash `k`, throughout: copies and their ids play no part before the end.
    Signatures (`signatures`) bring together candidates, of which a bucket's members are first compared with the set of
    its smallest id. Only pairs that this leaves in different components are compared further, in blocks. All pairs are
    compared by sizes and parity sketches first, which never rule out a link; only the sets of the others are moved, to
    be verified.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashed = source.select("doc_id", shingle_set(F.col("text"), shingle).alias("set")).withColumn("k", F.xxhash64("set"))
    rows = written(hashed.select("doc_id", F.size("set").cast("long").alias("n"), "k"), "sizes")
    classes = written(rows.filter("n > 0").groupBy("k", "n").agg(F.min("doc_id").alias("rep")), "classes")

    bands, expected = banded(rows.filter("n > 0"), percent, shingle)
    parts = parts_of(expected)
    entries = hashed.select("k", "set").mapInArrow(lambda batches: indexed(batches, bands, parts), "part int, id long, rests array<int>")
    # a set's signatures of one part travel together; what tells them apart within the part is 32 bits
    signature = F.shiftleft(F.col("part").cast("long"), 32).bitwiseOR(F.col("rest").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    single = entries.repartition("part").select("part", "id", F.explode("rests").alias("rest")).select(signature.alias("signature"), "id")
    shared = single.sortWithinPartitions("signature", "id").mapInArrow(buckets, "signature long, id long")
    order = classes.select(F.col("k").alias("id"), F.col("rep").isNull().alias("none"), "rep")
    members = written(shared.join(order, "id"), "members")

    # the first document of a bucket is most often the one that its near copies were made from
    hubs = members.groupBy("signature").agg(F.min(F.struct("none", "rep", "id")).alias("first")).select("signature", F.col("first.id").alias("b"))
    members_table, members = members, members.select("signature", "id")
    stars = written(members.join(hubs, "signature").filter("id <> b").select(F.col("id").alias("a"), "b").distinct(), "stars")
    sketches = written(sketches_of(source, classes.join(members.select(F.col("id").alias("k")).distinct(), "k", "left_semi"), shingle, percent), "sketches")
    close = written(not_ruled_out(stars, sketches, percent), "star-pairs")
    sets = written(sets_of(source, classes, close, shingle), "sets")
    star_links = written(verified(close, sets, percent), "star-links")
    forget(close, sets)
    found = components(star_links, "stars")

    placed = members.join(found, "id", "left").select("signature", "id", F.coalesce("component", "id").alias("component"))
    open_buckets = (
        placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows"))
        .filter("low <> high").select("signature", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    rest = placed.join(open_buckets, "signature").join(sketches, "id")
    pairs = written(candidates(rest, percent).join(stars, ["a", "b"], "left_anti"), "pairs")
    forget(members_table, stars, sketches)
    sets = written(sets_of(source, classes, pairs, shingle), "sets")
    links = star_links.unionByName(verified(pairs, sets, percent))
    whole = components(links, "links").withColumnRenamed("id", "k")
    forget(pairs, sets, star_links)
    placed = classes.join(whole, "k", "left").select("k", "rep", F.coalesce("component", "k").alias("component"))
    placed = written(placed, "class-components")
    forget(classes)
    # the smallest id, and of sets without any id, the one of the smallest name
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "k")).alias("first")
    firsts = written(placed.groupBy("component").agg(first), "component-firsts")
    labels = placed.join(firsts, "component").select("k", F.col("first.rep").alias("component_id"))
    return rows, labels, firsts.select(F.col("first.rep").alias("doc_id"), F.col("first.k").alias("k"))


def banded(sized: DataFrame, percent: int, shingle: int):
    """Size bands and schemes, planned from the number of documents in each band, and the signatures to expect; bands grow
    with the logarithm of sizes."""
    from parcelpay.llm.signatures import Bands, agreement

    largest = sized.agg(F.max("n")).first()[0] or 1
    bands = Bands(largest, percent)
    edges = F.array(*[F.lit(int(e)) for e in bands.edges])
    band = F.size(F.filter(edges, lambda e: e <= F.col("n"))) - 1
    docs = {r["b"]: r["d"] for r in sized.groupBy(band.alias("b")).agg(F.count(F.lit(1)).alias("d")).collect()}
    bands.plan(docs, agreement(shingle))
    return bands, bands.expected(docs)


def parts_of(signatures: float) -> int:
    """Parts of the signature space, a power of two."""
    parts = LEAST_PARTS
    while parts < signatures / PART_SIZE:
        parts *= 2
    return parts


def indexed(batches: Iterator, bands, parts: int) -> Iterator:
    """(part, id, rests) of every set, whose id comes with it: its signatures by part, 32 bits of each.

    A set that the same task has met before is not indexed again. Signatures only name candidates, so two that agree in
    part and rest by chance cost a comparison and no result.
    """
    import numpy as np
    import pyarrow as pa

    from parcelpay.llm.signatures import signatures

    shift = np.uint64(64 - (parts.bit_length() - 1))
    seen: set[int] = set()
    for batch in batches:
        ids, sets = batch.column(0), batch.column(1)
        offsets = sets.offsets.to_numpy().astype(np.int64)
        flat = sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
        a = 0
        while a < len(ids):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + 400_000, side="right")) - 1)
            b = min(b, len(ids))
            sizes = np.diff(offsets[a : b + 1])
            values = flat[offsets[a] : offsets[b]]
            fresh = sizes > 0
            for i in np.flatnonzero(fresh):
                key = hash(flat[offsets[a + i] : offsets[a + i + 1]].tobytes())
                if key in seen:
                    fresh[i] = False
                elif len(seen) < 1_000_000:
                    seen.add(key)
            found, owner = signatures(values[np.repeat(fresh, sizes)], sizes[fresh], bands)
            group = owner * parts + (found >> shift).astype(np.int64)
            place = np.argsort(group, kind="stable")
            group, rests = group[place], found[place].astype(np.uint32).view(np.int32)
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))[: len(group)]
            rows = np.flatnonzero(fresh)[group[starts] // parts] + a
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(group)).astype(np.int32)), pa.array(rests))
            part = pa.array((group[starts] % parts).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part, ids.take(pa.array(rows)), lists], names=["part", "id", "rests"])
            a = b


def buckets(batches: Iterator) -> Iterator:
    """Of rows sorted by signature and id, one for each pair of these, where the signature has more than one id.

    The last pair is held back until the next row shows whether its signature goes on, so one row is remembered.
    """
    import numpy as np
    import pyarrow as pa

    held, open_ = None, False  # the last pair so far, and whether the pair before it has its signature
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch])
        if not rows.num_rows:
            continue
        sig, ids = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        # copies of a set that other tasks have indexed are one member
        once = np.concatenate(([True], (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])))
        rows, sig = rows.filter(pa.array(once)), sig[once]
        same = sig[1:] == sig[:-1]
        keep = np.concatenate(([open_], same)) | np.concatenate((same, [False]))
        yield from rows.slice(0, len(sig) - 1).filter(pa.array(keep[:-1])).to_batches()
        held, open_ = rows.slice(len(sig) - 1).combine_chunks().to_batches()[0], bool(same[-1]) if len(same) else open_
    if held is not None and open_:
        yield held


def thinned(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents whose id falls into a bucket with one of the wanted classes' (k, rep): a table of at most ID_BUCKETS rows."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS))
    return source.join(F.broadcast(wanted.select(bucket("rep").alias("bucket")).distinct()), bucket("doc_id") == F.col("bucket"), "left_semi")


def sketches_of(source: DataFrame, wanted: DataFrame, shingle: int, percent: int) -> DataFrame:
    """id, n and sketch of the wanted classes (k, rep).

    Neither texts nor sets are moved: sketches are made where the documents are read, and the join by the hash of the set
    then is exact.
    """
    rows = (
        thinned(source, wanted).select(shingle_set(F.col("text"), shingle).alias("set"))
        .filter(F.size("set") > 0).select(F.xxhash64("set").alias("id"), "set")
    )

    def with_sketch(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from parcelpay.llm.signatures import sketch

        for batch in batches:
            sets = batch.column(1)
            offsets = sets.offsets.to_numpy()
            flat = sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
            sketches = [sketch(flat[a:b], percent).tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sketches, pa.binary())], names=["id", "n", "sketch"])

    found = rows.mapInArrow(with_sketch, "id long, n long, sketch binary")
    return found.join(wanted.select(F.col("k").alias("id")), "id", "left_semi").dropDuplicates(["id"])


def not_ruled_out(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda s: sketches.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))

    def compared(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from parcelpay.llm.signatures import near

        for batch in batches:
            sizes = [batch.column(f"n_{s}").to_numpy() for s in "ab"]
            rows = [[np.frombuffer(x, dtype=np.uint64) for x in batch.column(f"sketch_{s}").to_pylist()] for s in "ab"]
            yield batch.select(["a", "b"]).filter(pa.array(near(*sizes, *rows, percent), pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(compared, "a long, b long")


def sets_of(source: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """id and set of the classes (k, rep) that occur in the pairs (a, b)."""
    named = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct()
    wanted = classes.join(named, "k", "left_semi")
    return (
        thinned(source, wanted)
        .join(wanted.select(F.struct("rep").alias("of")).distinct(), F.struct(F.col("doc_id").alias("rep")) == F.col("of"), "left_semi")
        .select(shingle_set(F.col("text"), shingle).alias("set")).filter(F.size("set") > 0).select(F.xxhash64("set").alias("id"), "set")
        .dropDuplicates(["id"]).join(wanted.select(F.col("k").alias("id")), "id", "left_semi")
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; built-in expressions only."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .filter(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")
    )


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and that sizes and sketches don't rule out.

    A bucket of several blocks is compared block against block, each pair of blocks a group of its own, so a group never
    has more than about two blocks of rows.
    """
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        rows.withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("signature", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n", "sketch", "component")
        .repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j")
    )

    def compared(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        from parcelpay.llm.signatures import likely

        def of(group: pd.DataFrame) -> list[tuple]:
            sketches = [np.frombuffer(s, dtype=np.uint64) for s in group["sketch"]]
            ids = group["id"].tolist()
            side = ((group["own"] == group["j"]) & (group["i"] != group["j"])).to_numpy().astype(np.int64)
            found = likely(group["n"].to_numpy(), sketches, pd.factorize(group["component"])[0], side, percent)
            return [(max(ids[a], ids[b]), min(ids[a], ids[b])) for a, b in found]

        def emit(rows: pd.DataFrame) -> pa.RecordBatch:
            found: set[tuple] = set()
            for _, group in rows.groupby(["signature", "i", "j"], sort=False):
                if len(group) > 1:
                    found.update(of(group))
            pairs = sorted(found)
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], kind) for k in (0, 1)], names=["a", "b"])

        kind, kept = None, None
        for batch in batches:
            kind = batch.schema.field("id").type
            rows = batch.to_pandas()
            rows = rows if kept is None else pd.concat([kept, rows], ignore_index=True)
            if not len(rows):
                continue
            tail = rows.iloc[-1]
            last = (rows["signature"] == tail["signature"]) & (rows["i"] == tail["i"]) & (rows["j"] == tail["j"])
            kept = rows[last]  # its group may go on in the next batch
            yield emit(rows[~last])
        if kept is not None and len(kept):
            yield emit(kept)

    kind = rows.schema["id"].dataType.simpleString()
    return dealt.mapInArrow(compared, f"a {kind}, b {kind}").distinct()


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked documents, that of the smallest id, and all rows without words; columns unchanged.

    Of rows that share this id, the one whose text is in the group stays; rows equal in id and shingles are one. A group
    whose rows all have a null id keeps one of them.
    """
    rows, _, chosen = grouped(docs, shingle, percent, "doc_id", "text")
    uses = rows.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("__shared"))
    key = F.struct(F.col("doc_id").alias("id"))  # null ids compare equal inside a struct
    kept = chosen.select(key.alias("__id"), F.col("k").alias("__k"))
    kept = kept.join(uses.select(key.alias("__id"), "__shared"), "__id")
    wordless = F.size(words(F.col("text"))) == 0
    worded = docs.filter(~wordless).withColumn("__id", key).join(kept, "__id")
    # an id of one row tells its text; only shared ids have their sets computed again
    own = F.when(F.col("__shared"), F.xxhash64(shingle_set(F.col("text"), shingle))).otherwise(F.col("__k"))
    worded = worded.filter(own == F.col("__k")).dropDuplicates(["__id", "__k"])
    return worded.select(*docs.columns).unionByName(docs.filter(wordless))
