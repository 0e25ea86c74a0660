"""Best-fit packing of token pieces into sequences of a fixed length by matching of large items."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import numbered, written

CAPACITY = 1024
END = 2


def default_tokenizer() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text: doc_id, piece, start, length, ids (packed little-endian unsigned 32-bit ids).

    `end` is appended to each document. A document of more than `capacity` ids is cut into full pieces, with the shorter
    one first. A null text counts as empty and gives its end id alone. Repeated rows each give their pieces.
    """
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa

        from parcelpay.llm.tokens import encoder

        closing = b"" if end is None else end.to_bytes(4, "little")
        packed = encoder(path).packed
        for batch in batches:
            rows = []
            size = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = packed(text or "") + closing
                total = len(ids) // 4
                bounds = [0, *range(total % capacity or capacity, total, capacity), total] if total > capacity else [0, total]
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((doc, i, a, b - a, ids[4 * a : 4 * b]))
                size += len(ids)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=names), schema=arrow, preserve_index=False)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=names), schema=arrow, preserve_index=False)

    from pyspark.sql.pandas.types import to_arrow_type
    import pyarrow as pa

    key = docs.schema[id_col].dataType
    names = ["doc_id", "piece", "start", "length", "ids"]
    arrow = pa.schema([("doc_id", to_arrow_type(key)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    schema = f"doc_id {key.simpleString()}, piece int, start long, length long, ids binary"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


class Layout:
    """Places for items by length: runs of equal items that go into consecutive sequences.

    A run (length, first, last, per, sequence, offset) says that items number first to last-1 of that length fill
    sequences from `sequence` on, `per` to each, from `offset` on.
    """

    def __init__(self, counts: Mapping[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {k: n for k, n in counts.items() if n}
        self.used: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sequences = 0
        for size in sorted((k for k in self.left if 3 * k > capacity), reverse=True):
            self.match(size)
        for size in sorted((k for k in self.left if 3 * k <= capacity), reverse=True):
            self.fill(size)

    def place(self, size: int, n: int, per: int, sequence: int, offset: int) -> None:
        self.runs.append((size, self.used[size], self.used[size] + n, per, sequence, offset))
        self.used[size] += n
        self.left[size] -= n

    def keep(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if not self.open[gap]:
                insort(self.gaps, gap)
            self.open[gap].append((sequence, n))

    def match(self, size: int) -> None:
        """Items over a third of the capacity: the largest takes the largest other one that still fits."""
        while self.left[size]:
            fits = lambda k: 3 * k > self.capacity and size + k <= self.capacity and self.left[k] > (k == size)
            other = max(filter(fits, self.left), default=None)
            n = self.left[size] if other is None else self.left[size] // 2 if other == size else min(self.left[size], self.left[other])
            self.place(size, n, 1, self.sequences, 0)
            if other is not None:
                self.place(other, n, 1, self.sequences, size)
            self.keep(self.capacity - size - (other or 0), self.sequences, n)
            self.sequences += n

    def fill(self, size: int) -> None:
        """Smaller items: always into the tightest gap that holds one, a new sequence only where none does."""
        while n := self.left[size]:
            at = bisect_left(self.gaps, size)
            if at == len(self.gaps):
                fresh = -(-n // (self.capacity // size))
                self.keep(self.capacity, self.sequences, fresh)
                self.sequences += fresh
                continue
            gap = self.gaps[at]
            sequence, bins = self.open[gap].pop()
            if not self.open[gap]:
                del self.gaps[at]
            per = gap // size
            whole = min(bins, n // per)
            if not whole:
                per, whole = n, 1
            self.place(size, whole * per, per, sequence, self.capacity - gap)
            self.keep(gap - per * size, sequence, whole)
            self.keep(gap, sequence + whole, bins - whole)


def pack(items: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """`items` with `sequence_id` and `offset`, packed by their column `length` into sequences of at most `capacity`.

    Only the number of items of each length, at most `capacity` numbers, reaches the driver, which lays out runs of equal
    items; their number depends on the capacity, not on the data, so they are broadcast. Items find their run by their
    number within their length, which is dealt over buckets. Lengths must lie between 1 and `capacity`. Repeated rows are
    items of their own. An empty table gives an empty one.
    """
    spark = items.sparkSession
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    runs = spark.createDataFrame(
        Layout(counts, capacity).runs, "__length long, __first long, __last long, __per long, __sequence long, __offset long"
    )
    item = F.col("__item") - F.col("__first")
    found = (F.col("length") == F.col("__length")) & (F.col("__item") >= F.col("__first")) & (F.col("__item") < F.col("__last"))
    return (
        numbered(items.drop("sequence_id", "offset"), ["length"], list(order), "__item")
        .join(F.broadcast(runs), found)
        .withColumns({
            "sequence_id": F.col("__sequence") + F.floor(item / F.col("__per")),
            "offset": F.col("__offset") + item % F.col("__per") * F.col("__length"),
        })
        .drop("__item", "__length", "__first", "__last", "__per", "__sequence", "__offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are encoded once; what is kept of a piece is its length and the checksum of its ids.
    """
    cut = pieces(docs, tokenizer, capacity).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(written(cut, "pieces"), capacity, ("doc_id", "piece", "start", "length", "ids_crc32"))
