"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of the languages served.
STOP_WORDS = """
a an and are as at be but by for from had has have he her his i in is it not of on or that the their they this to was
were which will with you
au aux avec ce dans de des du elle en est et il je la le les leur mais ne nous on ou par pas plus pour qui que sa se son
sur un une vous
als am auch auf aus bei das dass dem den der die ein eine er es für hat ich im in ist mit nach nicht oder sich sie sind
so und von war was wie wir zu zum zur
al como con cuando de del el ella en era es esta este fue ha hay la las lo los más no o para pero por que se sin sobre
son su sus un una y ya
""".split()


@dataclass(frozen=True)
class Rule:
    """A text breaks the rule when its metric is under `least` or over `most`; texts under `from_words` words pass."""

    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The thresholds. Every metric is a field of `metrics`.
RULES = (
    Rule("words_per_text", least=MIN_WORDS),
    Rule("repeat_percent", most=MAX_REPEAT_PERCENT),
    Rule("mean_word_chars", least=1.5, most=25),
    Rule("symbols_per_word", most=0.3),
    Rule("exclamations_per_word", most=0.3),
    Rule("dup_line_share", most=0.5),
    Rule("stop_word_share", least=0.005, from_words=100),
)


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def repeated_words(w: Column) -> Column:
    """Words that lie in a window of five words which the text has twice or more, its first place included.

    Distinct hashes of all windows prove that none repeats; only else the windows themselves are sorted and compared.
    """
    last = F.size(w) - WINDOW

    def windows(value) -> Column:
        return F.transform(F.sequence(F.lit(0), last), value)

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, start, step)["n"]

    def repeats(s: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(s, k)["g"] == F.get(s, j)["g"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), last), lambda k: same(k, k - 1) | same(k, k + 1))
        return let(F.array_sort(F.transform(twice, lambda k: F.get(s, k)["i"])), covered)

    hashes = windows(lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    exact = let(
        F.array_sort(windows(lambda i: F.struct(F.array_join(F.slice(w, i + 1, F.lit(WINDOW)), " ").alias("g"), i.alias("i")))),
        repeats,
    )
    unique = F.size(F.array_distinct(hashes)) == last + 1
    return F.when(last < 1, 0).when(unique, 0).otherwise(exact).cast("long")


def metrics(text: Column) -> Column:
    """A struct of counts and ratios of a text. A null text counts as an empty one; ratios of nothing are 0."""
    whole = F.coalesce(text, F.lit(""))

    def lines_twice(lines: Column) -> Column:
        return let(
            F.filter(lines, lambda x: F.char_length(F.translate(x, SPACES, "")) > 0),
            lambda kept: F.struct((F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("twice"), F.size(kept).alias("all")),
        )

    def counts(w: Column) -> Column:
        stops = F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
            count_of(whole, SYMBOLS).cast("long").alias("n_symbols"),
            count_of(whole, "!").cast("long").alias("n_exclamations"),
            lines_twice(F.split(whole, "\n")).alias("lines"),
            repeated_words(w).alias("n_repeat_words"),
            stops.cast("long").alias("n_stop_words"),
        )

    def ratios(c: Column) -> Column:
        per_word = lambda x: F.when(c["n_words"] > 0, x / c["n_words"]).otherwise(0.0)
        return F.struct(
            *[c[k].alias(k) for k in ("n_words", "word_chars", "n_symbols")],
            c["lines"]["twice"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            c["n_words"].alias("words_per_text"),
            per_word(100 * c["n_repeat_words"]).alias("repeat_percent"),
            per_word(c["word_chars"]).alias("mean_word_chars"),
            per_word(c["n_symbols"]).alias("symbols_per_word"),
            per_word(c["n_exclamations"]).alias("exclamations_per_word"),
            per_word(c["n_stop_words"]).alias("stop_word_share"),
            F.when(c["lines"]["all"] > 0, c["lines"]["twice"] / c["lines"]["all"]).otherwise(0.0).alias("dup_line_share"),
        )

    return let(let(words(text), counts), ratios)


def broken(m: Column, rule: Rule) -> Column:
    value = m[rule.metric]
    tests = [value < rule.least] if rule.least is not None else []
    tests += [value > rule.most] if rule.most is not None else []
    bad = reduce(lambda a, b: a | b, tests)
    return bad & (m["n_words"] >= rule.from_words) if rule.from_words else bad


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where a text breaks no rule and passes the base test."""
    return ~reduce(lambda a, b: a | b, [broken(m, r) for r in rules], base_failed(m))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Metrics and verdict for each row of `docs`; no shuffle.

    Null and empty texts have no words, fail the base test and are not kept. Repeated rows each give a row; other
    columns are not read. An empty table gives an empty one.
    """
    m = F.col("__m")
    return docs.select(F.col(id_col).alias("doc_id"), metrics(F.col(text_col)).alias("__m")).select(
        "doc_id",
        *[m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"),
        verdict(m, rules).alias("kept"),
        *[m[r.metric].alias(r.metric) for r in rules if r.metric not in ("words_per_text",)],
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text breaks no rule, all their columns unchanged."""
    return docs.filter(let(metrics(F.col(text_col)), lambda m: verdict(m, rules)))
