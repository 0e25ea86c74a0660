"""Near duplicates by simhash: fuzzy keys of fingerprint segments, verified distances, connected components.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Fingerprints with at most four differing bits agree
in a whole segment, or have one to two differences in each, of which at least two segments have exactly one. So both
hold the same segment (three keys), or the same pair of code word indices of two segments (three pairs, ten keys each on
average): every pair within the limit shares a key, and each shared key is verified against the whole fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import components, written
from parcelpay.llm.golay import one_error_keys

SHINGLE, SEED = 4, 42
LIMIT = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A key with more fingerprints than this is split by the bits that its fingerprints need not share.
BUCKET = 20_000
#: Shingles whose bits are added up at once.
CHUNK = 1 << 16
_SPACES = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The simhash of a whole text, as a signed number; 0 without words."""
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    space = _SPACES[raw]
    inside = np.concatenate(([False], ~space, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return 0
    # Words with one space after each: every shingle is a stretch of these bytes.
    after = np.zeros(len(raw) + 1, dtype=bool)
    after[ends] = True
    spaced = np.append(raw, 0x20).astype(np.uint8)
    spaced[ends] = 0x20
    flat = memoryview(np.ascontiguousarray(spaced[np.append(~space, False) | after]))
    lengths = ends - starts
    begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    end = begin + lengths
    if len(begin) > shingle:
        begin, end = begin[: len(begin) - shingle + 1], end[shingle - 1 :]
    else:
        begin, end = begin[:1], end[-1:]
    total = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), CHUNK):
        spans = zip(begin[at : at + CHUNK].tolist(), end[at : at + CHUNK].tolist())
        hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * total > len(begin), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and the signed 64-bit `fp` of every row's whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array((fingerprint(t.as_py()) for t in batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    return rows.mapInArrow(hashed, schema)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of some fingerprints (uint64): the key, the number of its fingerprint, the bits that the key fixes."""
    parts = [(fps >> np.uint64(shift)) & np.uint64((1 << bits) - 1) for shift, bits in SEGMENTS]
    rows = np.arange(len(fps))
    keys, owner, fixed = [], [], []
    for i, (shift, bits) in enumerate(SEGMENTS):
        keys.append(parts[i] | np.uint64(i << 60))
        owner.append(rows)
        fixed.append(np.full(len(fps), ((1 << bits) - 1) << shift, dtype=np.uint64))
    fuzzy = [one_error_keys(part, bits) for part, (_, bits) in zip(parts, SEGMENTS)]
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2)), start=3):
        (a, use_a), (b, use_b) = fuzzy[i], fuzzy[j]
        row_a, at_a = np.nonzero(use_a)
        count_b = use_b.sum(axis=1)
        row_b, at_b = np.nonzero(use_b)
        first_b = np.concatenate(([0], np.cumsum(count_b)))
        # each index of one segment with each of the other
        times = count_b[row_a]
        left = np.repeat(a[row_a, at_a].astype(np.uint64), times)
        run = np.arange(times.sum()) - np.repeat(np.concatenate(([0], np.cumsum(times)[:-1])), times)
        place = np.repeat(first_b[row_a], times) + run
        right = b[row_b[place], at_b[place]].astype(np.uint64)
        keys.append(np.uint64(kind << 60) | left << np.uint64(12) | right)
        owner.append(np.repeat(row_a, times))
        fixed.append(np.zeros(len(left), dtype=np.uint64))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(fixed)


def _keyed(keys: np.ndarray, fps: np.ndarray, fixed: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (keys, fps, fixed)]
    return pa.RecordBatch.from_arrays(columns, ["key", "fp", "fixed"])


def first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 4096):
            some = fps[at : at + 4096]
            keys, owner, fixed = fuzzy_keys(some)
            yield _keyed(keys, some[owner], fixed)


def finer_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of a key that is too frequent, under five finer keys each: the free bits in five groups, one of which
    any four differences leave alone."""
    for batch in batches:
        keys, fps, fixed = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("key", "fp", "fixed"))
        for mask in np.unique(fixed).tolist():
            use = fixed == np.uint64(mask)
            free = [b for b in range(64) if not mask >> b & 1]
            for g in range(LIMIT + 1):
                group = np.uint64(sum(1 << b for b in free[g :: LIMIT + 1]))
                pairs = np.stack((keys[use], fps[use] & group), axis=1)
                finer = np.array([xxhash.xxh64_intdigest(p.tobytes(), g + 1) for p in pairs], dtype=np.uint64)
                yield _keyed(finer, fps[use], np.full(len(finer), np.uint64(mask) | group))


def within_bucket(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect what distances of at most `LIMIT` connect: each fingerprint is found from one other only."""
    left, reached = fps, []
    while len(left):
        if not reached:
            reached.append(left[0])
            left = left[1:]
        here = reached.pop()
        near = np.bitwise_count(left ^ here) <= LIMIT
        if near.any():
            for there in left[near].tolist():
                yield int(here), there
            reached.extend(left[near])
            left = left[~near]


def bucket_links(bucket: int):
    """A function over rows sorted by key: links `a`, `b`, and the members of keys with more than `bucket` of them as
    `a` (fingerprint), `key`, `fixed`. It holds at most one key's rows up to that number, besides a batch."""
    names = ["a", "b", "key", "fixed"]

    def links(a, b) -> pa.RecordBatch:
        a, b = (np.array(x, dtype=np.uint64).view(np.int64) for x in (a, b))
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none], names)

    def too_many(key: int, fps: np.ndarray, fixed: np.ndarray) -> pa.RecordBatch:
        columns = [fps.view(np.int64), None, np.full(len(fps), key), fixed.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.nulls(len(fps), pa.int64()) if c is None else pa.array(c) for c in columns], names)

    def close(key: int, kept: list[np.ndarray], fixed: list[np.ndarray], over: bool) -> Iterator[pa.RecordBatch]:
        if over:
            yield too_many(key, np.concatenate(kept), np.concatenate(fixed))
        elif sum(len(k) for k in kept) > 1:
            found = list(within_bucket(np.unique(np.concatenate(kept))))
            if found:
                yield links(*zip(*found))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, fixed, size, over = None, [], [], 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            fix = batch.column("fixed").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            # whole groups of two inside the batch, all at once
            inner = np.arange(1, len(cut) - 2)
            two = cut[inner[cut[inner + 1] - cut[inner] == 2]]
            if len(two):
                near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= LIMIT
                if near.any():
                    yield links(fps[two][near], fps[two + 1][near])
            counts = np.diff(cut)
            rest = [g for g in range(len(counts)) if counts[g] > 2 or g in (0, len(counts) - 1)]
            for g in rest:
                here = int(keys[cut[g]])
                if here != key:
                    if key is not None:
                        yield from close(key, kept, fixed, over)
                    key, kept, fixed, size, over = here, [], [], 0, False
                kept.append(fps[cut[g] : cut[g + 1]])
                fixed.append(fix[cut[g] : cut[g + 1]])
                size += int(counts[g])
                if size > bucket:
                    yield too_many(key, np.concatenate(kept), np.concatenate(fixed))
                    kept, fixed, size, over = [kept[0][:0]], [fixed[0][:0]], bucket, True
        if key is not None:
            yield from close(key, kept, fixed, over)

    return walk


def near_links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """`a`, `b`: links between distinct fingerprints (column `fp`) that connect all whose bits differ in at most four
    places. Dense keys give a link for each member but one, never all pairs; keys of more than `bucket` members are dealt
    anew under finer keys, until each fits."""
    found: DataFrame | None = None
    keyed = distinct.select("fp").mapInArrow(first_keys, "key long, fp long, fixed long")
    while True:
        dealt = keyed.repartition("key").sortWithinPartitions("key")
        out = written(dealt.mapInArrow(bucket_links(bucket), "a long, b long, key long, fixed long"), "simhash-links")
        own = out.filter("key is null").select("a", "b")
        found = own if found is None else found.union(own)
        # a key that fixes all bits has one fingerprint only
        over = out.filter("key is not null and fixed <> -1").select("key", F.col("a").alias("fp"), "fixed")
        if over.isEmpty():
            return found
        keyed = over.mapInArrow(finer_keys, "key long, fp long, fixed long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hexadecimal digits) and `component_id` of every row.

    Rows of equal fingerprints are one class before any key is made, so copies cost one key set, however many they are.
    `component_id` is the smallest id of all rows that links reach; ids may be of any orderable type. A null text is an
    empty one, and all texts without words have fingerprint 0 and link like others. Rows that repeat stay; a row of null
    id takes part and has its component's smallest other id, null where no row has one. Other columns are not looked at
    or returned. An empty table gives an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    labels = components(near_links(classes, bucket), "simhash").select(F.col("id").alias("fp"), "component")
    members = written(classes.join(labels, "fp"), "simhash-members")
    least = members.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = members.join(least, "component").select("fp", "smallest")
    final = classes.join(linked, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(final, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
