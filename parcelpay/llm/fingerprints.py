"""Document fingerprints by consistent weighted sampling; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpay.llm.common import let, lower_ascii, words

SLOTS = 64
TERM_WORDS = 2
#: Documents of a range of neighbours, and the most ranges.
RANGE_ROWS, MAX_RANGES = 500, 100_000
SEED = 40_503


def uniform(bits: Column, shift: int, width: int) -> Column:
    """A number strictly between 0 and 1 from `width` bits of a hash."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + 0.5) / float(1 << width)


def terms(text: Column, k: int = TERM_WORDS) -> Column:
    """Hashes of the runs of `k` words, A to Z in lower case; of a text of fewer words, of all of them, if any."""

    def runs(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(n == 0, F.array().cast("array<long>")).when(n < k, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(each)

    return let(words(lower_ascii(text)), runs)


def fingerprint(text: Column, k: int = TERM_WORDS) -> Column:
    """Up to SLOTS numbers, each a slot and the sample drawn there.

    A term's weight is the times it occurs. Each term has one slot, and there one sample with its own gamma-distributed
    r and c and a uniform beta: t = floor(ln(weight) / r + beta), and the slot takes the term of the least
    ln(c) - r (t - beta + 1). The sample is the pair of term and t. So two documents take the same sample with a chance
    equal to the generalised Jaccard similarity of the slot's weights, and the share of equal slots estimates that of
    the documents. One long holds slot, rounded value and a hash of the sample, so that sorting finds the least.
    """

    def sample(term: Column, weight: Column) -> Column:
        def drawn(h: Column) -> Column:
            def valued(p: Column) -> Column:
                r = -F.log(p["u"])
                t = F.floor(F.log(weight.cast("double")) / r + p["beta"])
                value = F.log(-F.log(p["v"])) - r * (t - p["beta"] + 1)
                scaled = F.greatest(F.lit(0), F.least(F.lit((1 << 27) - 1), F.floor((value + 100) * (1 << 20)).cast("long")))
                own = F.shiftrightunsigned(F.xxhash64(term, t), 33)
                return F.shiftleft(F.pmod(term, F.lit(SLOTS)), 58).bitwiseOR(F.shiftleft(scaled, 31)).bitwiseOR(own)

            # the product of two uniform numbers has the distribution that gives gamma of shape 2
            pair = F.struct(
                (uniform(h[0], 0, 32) * uniform(h[0], 32, 32)).alias("u"),
                (uniform(h[1], 0, 24) * uniform(h[1], 24, 24)).alias("v"),
                uniform(h[1], 48, 16).alias("beta"),
            )
            return let(pair, valued)

        return let(F.array(F.xxhash64(F.lit(SEED), term), F.xxhash64(F.lit(SEED + 1), term)), drawn)

    def weighted(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        sampled = lambda at: F.transform(at, lambda p, i: sample(F.get(s, p), F.coalesce(F.get(at, i + 1), n) - p))
        return F.when(n == 0, F.array().cast("array<long>")).otherwise(let(starts, sampled))

    def least(v: Column) -> Column:
        slot = lambda x: F.shiftrightunsigned(x, 58)
        first = F.filter(v, lambda x, i: (i == 0) | (slot(x) != slot(F.get(v, i - 1))))
        low = F.lit((1 << 31) - 1)
        return F.transform(first, lambda x: F.shiftleft(slot(x), 31).bitwiseOR(x.bitwiseAND(low)))

    return let(F.sort_array(let(F.sort_array(terms(text, k)), weighted)), least)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots among those that either document fills; 1 for two that fill none."""
    slots = lambda x: F.transform(x, lambda v: F.shiftright(v, 31))
    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(print_: Column) -> Column:
    """Slots with samples in hexadecimal; equal texts have equal ones."""
    return F.array_join(F.transform(print_, lambda v: F.lower(F.hex(v))), "-")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = TERM_WORDS) -> DataFrame:
    """One row for each row of `docs`: doc_id, fingerprint. Null and empty texts have an empty one."""
    return docs.select(F.col(id_col).alias("doc_id"), as_text(fingerprint(F.coalesce(F.col(text_col), F.lit("")), k)).alias("fingerprint"))


def ranges(docs: DataFrame) -> tuple[Column, int]:
    """The number of an id's range, 0 for the smallest ids and nulls; ranges hold about RANGE_ROWS rows each."""
    known = docs.filter("doc_id is not null")
    n = known.count()
    parts = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    if parts == 1:
        return F.lit(0), 1
    at = [i / parts for i in range(1, parts)]
    bounds = sorted(set(known.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * parts))).first()[0]))
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        above = F.get(array, middle) <= F.col("doc_id")
        return F.when(a["low"] >= a["high"], a).otherwise(
            F.struct(F.when(above, middle + 1).otherwise(a["low"]).alias("low"), F.when(above, a["high"]).otherwise(middle).alias("high"))
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, halve)["low"]
    return F.when(F.col("doc_id").isNull(), 0).otherwise(found), len(bounds) + 1


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = TERM_WORDS) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last third is the next document's beginning.

    Next is the next smaller id, after the smallest the largest; a lone document is its own next. Rows that share an id
    follow each other by a hash of their texts; null ids come last and share one range. Null texts are empty ones. The
    table is dealt into ranges of ids, and the first row of each is also sent to the range before it, so texts move once
    and each range is worked on by itself. Bounds and first ids, a number for each range, pass the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    part, _ = ranges(rows)
    dealt = rows.withColumn("part", part.cast("int"))
    firsts = sorted(((r["part"], r["first"]) for r in dealt.groupBy("part").agg(F.max("doc_id").alias("first")).collect()), reverse=True)
    # the range before in descending order is the next higher one; the lowest is followed by the highest
    ghosts = [(first, above) for (above, _), (_, first) in zip(firsts, firsts[1:])] + [(firsts[0][1], firsts[-1][0])] if firsts else []
    to = docs.sparkSession.createDataFrame(ghosts, "first long, to int")
    copies = dealt.join(F.broadcast(to), F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "text", F.col("to").alias("part"), F.lit(1).alias("ghost"))
    both = dealt.select("doc_id", "text", "part", F.lit(0).alias("ghost")).unionByName(copies)
    line = Window.partitionBy("part").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    size = F.char_length("text")
    cut = F.floor(size / 3).cast("int")
    return (
        both.withColumn("next", F.coalesce(F.lead("text").over(line), F.lit("")))
        .withColumns({
            "n_chars": size.cast("long"),
            "edited": F.concat(F.substr("text", F.lit(1), size - cut), F.substr("next", F.lit(1), cut)),
        })
        .select(
            "doc_id", "part", "ghost", "n_chars", F.xxhash64("text").alias("__order"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint(F.col("text"), k).alias("own"), fingerprint(F.col("edited"), k).alias("other"),
        )
        .withColumn("following", F.lead("own").over(Window.partitionBy("part").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "__order")))
        .filter("ghost = 0")
        .select(
            "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )
