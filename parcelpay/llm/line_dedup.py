"""Near-repeated lines: an exact set-similarity join with prefix, positional and length filters; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpay.llm.common import forget, words, written

#: Similarity in percent, and the distinct words from which on a line takes part: all but blank ones.
PERCENT, LEAST_TOKENS = 80, 1
#: Hash buckets of words that are counted to order words by rarity, and the bits of a word's hash beside its bucket.
WORD_BUCKETS, REST_BITS = 1 << 16, 47
#: Buckets of document ids: the bound of the table that thins documents out before their shuffle.
ID_BUCKETS = 1 << 18
POSITION_BITS = 24
#: Bits of a word's number that its key in a prefix goes without; what is left fits an int and keeps the order by rarity.
KEY_SHIFT = 32


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line", "text"))


def rarity(docs: DataFrame, text_col: str = "text") -> Column:
    """An array with the rank of each hash bucket of words by the number of words in it, the rarest first."""
    bucket = F.xxhash64("word").bitwiseAND(F.lit(WORD_BUCKETS - 1))
    counts = docs.select(F.explode(words(F.lower(F.col(text_col)))).alias("word")).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    size = dict.fromkeys(range(WORD_BUCKETS), 0) | {r["b"]: r["n"] for r in counts}
    rank = {b: i for i, b in enumerate(sorted(size, key=lambda b: (size[b], b)))}
    return F.split(F.lit(",".join(str(rank[b]) for b in range(WORD_BUCKETS))), ",").cast("array<bigint>")


def tokens(line: Column, ranks: Column) -> Column:
    """A line's distinct words in lower case as numbers, the rarest first: the rank of the bucket, then the rest of the hash."""

    def number(h: Column) -> Column:
        # never null, and said to be so: arrays that may hold nulls are sorted as objects
        rank = F.coalesce(F.get(ranks, h.bitwiseAND(F.lit(WORD_BUCKETS - 1)).cast("int")), F.lit(0).cast("long"))
        return F.shiftleft(rank, REST_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - REST_BITS))

    hashes = F.transform(words(F.lower(line)), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.transform(hashes, number)))


def prefix_length(n: Column, percent: int) -> Column:
    """So many of the rarest words that two lines with enough words in common share one of them."""
    return n - F.ceil(n * percent / 100.0) + 1


def apart(n: Column, m: Column, percent: int) -> Column:
    """The most words in which two similar lines of these sizes differ."""
    return F.floor((100 - percent) * (n + m) / (100 + percent))


def described(docs: DataFrame, ranks: Column, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, line, set (a hash of the line's set), n, keys (of the prefix, ascending) and parity (of words by 64 places)."""
    # blank lines go by their text: a condition on what is computed of the words would compute it once more
    rows = lines_of(docs, id_col, text_col).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    t, n = F.col("t"), F.size("t")
    places = F.aggregate(t, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))
    prefix = F.slice(t, F.lit(1), prefix_length(n, percent).cast("int"))
    keys = F.transform(prefix, lambda x: F.shiftright(x, KEY_SHIFT).cast("int"))
    return rows.select("doc_id", "line", tokens(F.col("text"), ranks).alias("t")).select(
        "doc_id", "line", F.xxhash64("t").alias("set"), n.alias("n"), keys.alias("keys"), places.alias("parity")
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """set, n, keys, parity and first (doc_id and line of the set's first line): equal sets are one from here on."""
    return lines.groupBy("set", "n", "keys", "parity").agg(F.min(F.struct("doc_id", "line")).alias("first"))


def prefixes_apart(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """In so many words two sets differ at least, as their prefixes tell. a and b: n, keys.

    Below the lesser of their last keys, the prefixes hold all words of both sets; keys stand for one word or more.
    """
    last = F.least(F.element_at(a["keys"], -1), F.element_at(b["keys"], -1))
    low_a, low_b = (F.filter(side["keys"], lambda x: x < last) for side in (a, b))
    rest = F.abs((a["n"] - F.size(low_a)) - (b["n"] - F.size(low_b)))
    return F.size(F.array_except(low_a, b["keys"])) + F.size(F.array_except(low_b, a["keys"])) + rest


def passes(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """The length, positional and parity filters, none of which rules out a similar pair.

    a and b: n, position of the shared word, parity.
    """
    length = 100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])
    rest = F.least(a["n"] - a["position"], b["n"] - b["position"])  # the shared word, if it is the first one, and later ones
    overlap = rest * (100 + percent) >= percent * (a["n"] + b["n"])
    return length & overlap & (F.bit_count(a["parity"].bitwiseXOR(b["parity"])) <= apart(a["n"], b["n"], percent))


def candidate_pairs(firsts: DataFrame, percent: int, all_of: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of sets that share a prefix word and pass the filters; hub says that b was the word's first set.

    In each word's bucket, sets are in order of their first document. A set that is very likely similar to the bucket's
    first one is paired with that alone, so a large group of near copies gives one pair for each member. All others are
    paired with every earlier set of the bucket. With `all_of` (a column `set`), those sets are paired with all earlier
    ones whatever the first one is like.
    """
    # all that follows stays on the one exchange by word
    entries = firsts.select("set", "n", F.col("first.doc_id").alias("first"), "parity", F.posexplode("keys").alias("position", "key"))
    packed = (F.shiftleft(F.col("n").cast("long"), POSITION_BITS) + F.col("position")).alias("packed")
    # nothing is null here; saying so, as the joins below ask for it, lets them all find the same exchange
    known = " and ".join(f"{c} is not null" for c in ("key", "set", "first", "packed", "parity"))
    entries = entries.select("key", "set", "first", packed, "parity").filter(known).repartition("key")
    order = Window.partitionBy("key").orderBy("first", "set")
    # each column apart: a running frame keeps no rows, and an aggregate of a struct would
    headed = entries.withColumns({f"hub_{c}": F.first(c).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in ("set", "first", "packed", "parity")})
    part = lambda p, c="packed": {
        "n": F.shiftright(F.col(f"{p}{c}"), POSITION_BITS), "position": F.col(f"{p}{c}").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)), "parity": F.col(f"{p}parity"),
    }
    own, hub, other = part(""), part("hub_"), part("o_")
    limit = apart(own["n"], hub["n"], percent)
    # parities of 64 places differ in 32 (1 - exp(-d / 32)) bits when sets differ in d words
    close = F.bit_count(own["parity"].bitwiseXOR(hub["parity"])) <= 0.8 * 32 * (1 - F.exp(-limit / 32.0))
    with_hub = passes(own, hub, percent) & close & (F.col("hub_first") < F.col("first"))
    rest = headed.filter((F.col("hub_set") != F.col("set")) & ~with_hub).select("key", "set", "first", "packed", "parity")
    if all_of is not None:
        rest = entries.join(all_of, "set", "left_semi")
    others = entries.select("key", *[F.col(c).alias(f"o_{c}") for c in ("set", "first", "packed", "parity")])
    earlier = (F.col("o_first") < F.col("first")) | ((F.col("o_first") == F.col("first")) & (F.col("o_set") < F.col("set")))
    pairs = rest.join(others, "key").filter(earlier & passes(own, other, percent)).select(F.col("set").alias("a"), F.col("o_set").alias("b"), F.lit(False).alias("hub"))
    if all_of is None:
        pairs = pairs.unionByName(headed.filter(with_hub).select(F.col("set").alias("a"), F.col("hub_set").alias("b"), F.lit(True).alias("hub")))
    return pairs.groupBy("a", "b").agg(F.max("hub").alias("hub"))


def thinned(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that may have one of the ids: those whose id falls into a bucket with one."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS))
    some = F.broadcast(ids.select(bucket("doc_id").alias("__bucket")).distinct())
    return docs.join(some, bucket(id_col) == F.col("__bucket"), "left_semi")


def ruled_in(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs that their prefixes don't rule out, with the first lines of both."""
    place = lambda side: firsts.select(F.col("set").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("first", "n", "keys")])
    a, b = ({c: F.col(f"{side}_{c}") for c in ("n", "keys")} for side in ("a", "b"))
    likely = prefixes_apart(a, b) <= apart(a["n"], b["n"], percent)
    return pairs.join(place("a"), "a").join(place("b"), "b").filter(likely).select("a", "b", "a_first", "b_first")


def verified(docs: DataFrame, pairs: DataFrame, firsts: DataFrame, ranks: Column, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs that their prefixes don't rule out, with whether they are similar, by the sets of their first lines.

    A set travels once for each pair that it is the later one in; the earlier one travels once and is held, while the
    rows of its pairs stream by.
    """
    wanted = written(ruled_in(pairs, firsts, percent), "line-likely")
    roles = wanted.select(F.col("a_first.*"), "a", "b", F.lit(1).alias("role")).unionByName(
        wanted.select(F.col("b_first.*"), F.col("b").alias("a"), "b", F.lit(0).alias("role")).distinct()
    )
    by_doc = roles.groupBy("doc_id").agg(F.collect_list(F.struct("line", "a", "b", "role")).alias("roles"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = (
        thinned(source, by_doc.select("doc_id")).dropDuplicates(["doc_id"]).join(by_doc, "doc_id")
        .select(F.split("text", "\n").alias("lines"), F.explode("roles").alias("r"))
        .select("r.*", tokens(F.get("lines", F.col("r.line")), ranks).alias("t"))
    )
    held = Window.partitionBy("b").orderBy("role").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = F.size(F.array_intersect("t", "hub"))
    found = written(
        sets.withColumn("hub", F.first("t").over(held)).filter("role = 1")
        .select("a", "b", (100 * both >= percent * (F.size("t") + F.size("hub") - both)).alias("similar")),
        "line-matches",
    )
    forget(wanted)
    return found


def later_sets(found: DataFrame, firsts: DataFrame) -> DataFrame:
    """The set of each similar pair whose first line comes later."""
    order = lambda side: firsts.select(F.col("set").alias(side), F.col("first").alias(f"{side}_first"))
    later = F.when(F.col("a_first") > F.col("b_first"), F.col("a")).otherwise(F.col("b"))
    return found.filter("similar").join(order("a"), "a").join(order("b"), "b").select(later.alias("set")).distinct()


def repeated_lines(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and removed: the numbers (from 0, in order) of a document's lines that repeat an earlier line.

    Lines are split at \\n and in order of doc_id and number. A line is removed when an earlier line, removed or not, has
    a set of words whose Jaccard similarity with its own is at least `percent`; so of equal lines the first stays, short
    ones too. Lines of fewer than LEAST_TOKENS distinct words, which are the blank ones, stay. Documents without removed lines, among them null and
    empty texts and null ids, have no row. Rows that share an id are taken for one text, whose rows should be equal.
    Words are told apart by 63 bits of their hashes.
    """
    ranks = rarity(docs, text_col)
    table = written(described(docs, ranks, percent, id_col, text_col), "lines")
    lines = table.filter(F.col("n") >= LEAST_TOKENS)
    firsts = written(first_lines(lines), "firsts")
    pairs = written(candidate_pairs(firsts, percent), "line-pairs")
    found = verified(docs, pairs, firsts, ranks, percent, id_col, text_col)
    dead = written(later_sets(found, firsts), "line-dead")
    # sets that were held back from all but a hub in some bucket, and that nothing matched
    failed = written(pairs.filter("hub").select(F.col("a").alias("set")).distinct().join(dead, "set", "left_anti"), "line-failed")
    forget(pairs, found)
    if not failed.isEmpty():
        more = written(candidate_pairs(firsts, percent, failed), "line-pairs")
        again = verified(docs, more, firsts, ranks, percent, id_col, text_col)
        forget(more)
        dead = written(dead.unionByName(later_sets(again, firsts)).distinct(), "line-dead")
        forget(again)
    gone = lines.select("doc_id", "line", "set").join(firsts.select("set", "first"), "set").join(dead.withColumn("dead", F.lit(True)), "set", "left")
    gone = gone.filter(F.col("dead") | (F.struct("doc_id", "line") != F.col("first")))
    removed = written(gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed")), "line-removed")
    forget(table, firsts, dead, failed)
    return removed


def without_repeats(docs: DataFrame, removed: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without the removed lines of their texts; documents that have none keep their text as it is, null too.

    Only documents whose id falls into a bucket with an id in `removed` are shuffled.
    """
    bucket = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS))
    some = F.broadcast(removed.select(bucket().alias("__bucket")).distinct())
    gone = removed.select("doc_id", F.col("removed").alias("__removed"))
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda _, i: ~F.array_contains("__removed", i))
    text = F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    tried = docs.join(some, bucket() == F.col("__bucket"), "left_semi").join(gone, "doc_id", "left").withColumn(text_col, text)
    same = docs.join(some, bucket() == F.col("__bucket"), "left_anti")
    return tried.select(*docs.columns).unionByName(same)
