"""Personal data: generators propose spans, boosted trees judge them, thresholds choose; built-in expressions only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.boosting import Boosted, threshold, train
from parcelpay.llm.common import let

KINDS = ("email", "ip", "card", "phone")
#: Characters before a span that context words are looked for in; precision at which thresholds are set.
CONTEXT, PRECISION = 24, 0.98

LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Spans that are always reported. A run of characters is entered at its start only, or where the match before ended, and
#: possessive quantifiers never give back, which finds the same leftmost matches in linear time.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's expressions to be tried: each is implied by all of its kind's expressions.
HINT = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\[?\.\]?[0-9]", "card": r"[0-9][\x20.-]?[0-9]", "phone": r"\+[0-9]|[0-9]{3}"}

#: Wide nets by kind, which may overlap each other and the base spans.
GENERATORS = (
    ("email", rf"(?<!{LOCAL}){LOCAL}++@{HOST}++(?:\.{HOST}++)++"),
    ("email", rf"(?<!{LOCAL}){LOCAL}++\x20?[(\[]at[)\]]\x20?{HOST}++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?){HOST}++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\[?\.\]?[0-9]{1,3}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){2}[\x20.-][0-9]{1,7}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{4,5}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"(?<![0-9)+(])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)

SPANS = "array<struct<kind:int,start:int,end:int>>"
FEATURES = ("generator", "digits", "groups", "luhn", "byte_parts", "plus", "parens", "before", "after", "context", "tld", "lead")


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a text of digits is right; not for an empty text."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).try_cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.coalesce(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0, F.lit(False))


def byte_parts(match: Column) -> Column:
    """Whether every dotted number is at most 255, leading zeros aside."""
    short = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(F.regexp_replace(match, r"[\[\]]", ""), r"\."), lambda p: (F.length(short(p)) <= 3) & (F.coalesce(F.when(F.length(short(p)) <= 3, short(p)).try_cast("int"), F.lit(999)) <= 255))


def valid(kind: str, match: Column) -> Column:
    n = F.length(digits_of(match))
    if kind == "card":
        return let(digits_of(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    return {"email": F.lit(True), "ip": byte_parts(match), "phone": n.between(9, 15)}[kind]


def spans(text: Column, pattern: str, hint: str) -> Column:
    """All matches with start and end in code points, from the pieces between them."""
    kind = "array<struct<start:int,end:int,match:string>>"

    def placed(parts: Column) -> Column:
        def step(a: Column, k: Column) -> Column:
            match = F.get(parts["found"], k)
            start = a["at"] + F.char_length(F.get(parts["between"], k))
            end = start + F.char_length(match)
            one = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), match.alias("match")))
            return F.struct(end.cast("int").alias("at"), F.concat(a["spans"], one).cast(kind).alias("spans"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
        n = F.size(parts["found"])
        return F.when(n == 0, F.array().cast(kind)).otherwise(F.aggregate(F.sequence(F.lit(0), n - 1), none, step)["spans"])

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
    return F.when(F.rlike(text, F.lit(hint)), let(both, placed)).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """A struct of the base spans of each kind."""
    of = lambda k: F.filter(spans(text, BASE[k], HINT[k]), lambda s: valid(k, s["match"]))
    return F.struct(*[of(k).alias(k) for k in KINDS])


def base_array(base: Column) -> Column:
    """Base spans with the number of their kind, in order of kinds."""
    of = lambda i: F.transform(base[KINDS[i]], lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.concat(*[of(i) for i in range(len(KINDS))]).cast(SPANS)


def class_of(character: Column) -> Column:
    """0 at a text's edge, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(F.coalesce(F.length(character), F.lit(0)) == 0, 0).when(F.rlike(character, F.lit(r"\s")), 1)
        .when(F.rlike(character, F.lit(r"\p{L}")), 2).when(F.rlike(character, F.lit("[0-9]")), 3).otherwise(4)
    )


def features(text: Column, generator: int, s: Column) -> Column:
    """Small whole numbers that describe a candidate's format and what stands around it."""
    kind = GENERATORS[generator][0]
    match, number = s["match"], digits_of(s["match"])
    n = F.length(number)
    near = F.lower(F.substr(text, F.greatest(F.lit(1), s["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), s["start"])))
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    return F.struct(
        F.lit(generator).alias("generator"),
        F.least(n, F.lit(20)).alias("digits"),
        F.least(F.size(F.split(match, "[^0-9]+")), F.lit(8)).alias("groups"),
        flag(let(number, luhn) if kind == "card" else F.lit(False)).alias("luhn"),
        flag(byte_parts(match) if kind == "ip" else F.lit(False)).alias("byte_parts"),
        flag(F.startswith(match, F.lit("+"))).alias("plus"),
        flag(F.contains(match, F.lit("("))).alias("parens"),
        class_of(F.substr(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0))).alias("before"),
        class_of(F.substr(text, s["end"] + 1, F.lit(1))).alias("after"),
        flag(F.rlike(near, F.lit(r"\b(?:tel|phone|call|fax|mobile|mail|e-mail|contact|card|visa|ip|host|server|address|pay)"))).alias("context"),
        F.least(F.length(F.substring_index(match, ".", -1)), F.lit(8)).alias("tld"),
        F.coalesce(F.substr(number, F.lit(1), F.lit(1)).try_cast("int"), F.lit(-1)).alias("lead"),
    )


def proposals(text: Column, base: Column) -> Column:
    """All candidates: start, end, kind, features, whether a base span of the kind is the same, and overlaps one of any kind."""

    def of(generator: int) -> Column:
        kind, pattern = GENERATORS[generator]
        overlaps = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
        all_base = F.concat(*[base[k] for k in KINDS])
        return F.transform(
            spans(text, pattern, HINT[kind]),
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
                features(text, generator, s).alias("features"),
                F.exists(base[kind], lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"])).alias("same"),
                F.exists(all_base, lambda b: overlaps(s, b)).alias("overlaps"),
                valid(kind, s["match"]).alias("valid"),
            ),
        )

    return F.concat(*[of(i) for i in range(len(GENERATORS))])


@dataclass(frozen=True)
class Judge:
    """The trees and the odds from which on a candidate of each kind is chosen."""

    trees: Boosted
    least: tuple[float, ...]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> Judge:
    """Trees trained on all candidates of all texts, of which only counts by features reach the driver.

    A candidate that is a base span counts as personal data. One whose number fails its kind's test, or that lies within
    a base span of another shape, counts as none. The rest, such as a number that the base expression has swallowed
    together with its neighbours, teaches nothing and is judged by the trees. Documents whose checksum of the id is 2
    modulo 4 set the thresholds, the others grow the trees. The features are small numbers, so their combinations are
    bounded whatever the data.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    c = F.col("c")
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = (
        docs.filter(F.rlike(text, F.lit("[0-9@]"))).select(held.alias("held"), F.explode(let(base_spans(text), lambda b: proposals(text, b))).alias("c"))
        .select("held", "c.features.*", c["kind"].alias("kind"), F.when(c["same"], 1).when(~c["valid"] | c["overlaps"], 0).alias("label"))
        .filter("label is not null").groupBy("held", "kind", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    counts: dict[tuple, list[float]] = {}
    for r in rows:
        key = (r["held"], r["kind"], *(r[f] for f in FEATURES))
        counts.setdefault(key, [0.0, 0.0])[1 - r["label"]] += r["n"]
    keys = sorted(counts)
    grow = [k for k in keys if not k[0]]
    trees = train(FEATURES, [dict(zip(FEATURES, k[2:])) for k in grow], [counts[k][0] for k in grow], [counts[k][1] for k in grow])
    least = []
    for kind in range(len(KINDS)):
        own = [k for k in keys if k[0] and k[1] == kind]
        x = np.array([k[2:] for k in own], dtype=np.int64).reshape(len(own), len(FEATURES))
        pos, neg = (np.array([counts[k][i] for k in own]) for i in (0, 1))
        least.append(max(0.0, threshold(trees.odds(x), pos, neg, precision)))
    return Judge(trees, tuple(least))


def find(docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, text, base (spans by kind) and found (all spans, base ones and chosen ones).

    A chosen candidate overlaps no base span and no chosen one before it. Spans are counted in code points, the end
    exclusive. Null and empty texts have no spans; repeated rows each give a row; other columns are not read.
    """
    score = lambda p: judge.trees.column(lambda f: p["features"][f])
    bar = lambda p: F.element_at(F.array(*[F.lit(float(v)) for v in judge.least]), p["kind"] + 1)

    def chosen(all_: Column) -> Column:
        good = F.filter(all_, lambda p: ~p["overlaps"] & p["valid"] & (score(p) >= bar(p)))
        ordered = F.array_sort(F.transform(good, lambda p: F.struct(p["start"].alias("start"), (-p["end"]).alias("back"), p["kind"].alias("kind"))))

        def step(a: Column, s: Column) -> Column:
            one = F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (-s["back"]).alias("end")))
            later = F.struct((-s["back"]).alias("at"), F.concat(a["spans"], one).cast(SPANS).alias("spans"))
            return F.when(s["start"] >= a["at"], later).otherwise(a)

        return F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")), step)["spans"]

    def merged(b: Column, more: Column) -> Column:
        return F.array_sort(F.concat(base_array(b), more).cast(SPANS))

    def of(text: Column) -> Column:
        return let(base_spans(text), lambda b: F.struct(b.alias("base"), merged(b, chosen(proposals(text, b))).alias("found")))

    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.struct(
        F.struct(*[F.array().cast("array<struct<start:int,end:int,match:string>>").alias(k) for k in KINDS]).alias("base"), F.array().cast(SPANS).alias("found")
    )
    spans_ = F.when(F.rlike(text, F.lit("[0-9@]")) | F.rlike(text, F.lit(HINT["email"])), of(text)).otherwise(none)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), spans_.alias("s")).select("doc_id", "text", "s.base", "s.found")


def listed(spans_: Column) -> Column:
    """kind:start:end of spans that are in order of kind and start, joined by commas."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_listed(base: Column) -> Column:
    return listed(base_array(base))


def redacted(found: DataFrame) -> DataFrame:
    """doc_id and text with each span, or run of overlapping spans, replaced by its kind in brackets."""

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substr("text", a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"])), F.when(s["start"] >= a["at"], F.concat(F.lit("["), F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit("]"))).otherwise(""))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], piece).alias("out"))

    ordered = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return found.withColumn("done", done).select("doc_id", F.concat("done.out", F.substr("text", F.col("done.at") + 1, F.char_length("text"))).alias("text"))
