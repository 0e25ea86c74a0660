"""Joins of documents and lines against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelpay.llm import line_dedup, ngram_join
from parcelpay.llm.common import components
from parcelpay.llm.signatures import Bands, Scheme, agreement, allocate, likely, signatures, sketch
from tests.conftest import SMALL
from tests.llm import odd


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def strange(spark):
    return spark.createDataFrame(odd.documents(), odd.SCHEMA)


def test_links_equal_brute_force(documents, k=5, percent=80):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(documents, k, percent).collect()}
    assert got == odd.linked(docs, k, percent)


def test_links_of_odd_documents_in_blocks_of_one_row(strange, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 1)
    rows = ngram_join.linked(strange, 3, 90).collect()
    assert len(rows) == len(odd.documents())
    expected = odd.linked([(r[0], r[1]) for r in odd.documents()], 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected


def test_links_of_nothing(strange):
    assert ngram_join.linked(strange.limit(0)).collect() == []


def test_one_of_each_keeps_wordless_and_one_of_repeated_rows(strange):
    kept = [r["doc_id"] for r in ngram_join.one_of_each(strange, 3, 80).select("doc_id").collect()]
    assert kept.count(1) == 1 and 2 not in kept and kept.count(4) == 2 and {5, 6, 7, 8, 13} <= set(kept) and 9 not in kept


def edited(base: list[int], n: int, seed: int) -> set[int]:
    """The set with n of its elements exchanged."""
    r = random.Random(seed)
    out = set(base)
    for x in r.sample(base, n):
        out.remove(x)
        out.add(r.getrandbits(63))
    return out


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("loose", [None, 0.5, 1.0])
def test_every_similar_pair_shares_a_signature(percent, loose):
    """Over all sizes, edits up to the limit, and schemes with and without one-deletion neighbourhoods."""
    r = random.Random(percent)
    sets = []
    for size in [*range(3, 60), 97, 150, 333, 700]:
        base = [r.getrandbits(63) for _ in range(size)]
        sets.append(set(base))
        sets += [edited(base, min(size - 1, e), size * 31 + e) for e in (1, size // 20, size // 12, size // 9)]
        sets.append(set(base[: -max(1, size // 10)]))
    bands = Bands(1000, percent).plan({})
    if loose is not None:
        for i, s in enumerate(bands.schemes):
            if s.segments:
                units = s.segments + s.loose
                n = int(units * loose / 2)
                bands.schemes[i] = Scheme(units - n, n, 1 if n else s.subset)
    values = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    found, owner = signatures(np.concatenate(values), np.array([len(v) for v in values]), bands)
    of = [set(found[owner == i].tolist()) for i in range(len(sets))]
    pairs = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] != sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                pairs += 1
                assert of[i] & of[j], (len(sets[i]), len(sets[j]), both)
    assert pairs > 40


def test_sets_of_long_shingles_have_fewer_signatures_than_elements():
    """Long shingles hardly agree by chance, so their segments can be small; similar pairs still share a signature."""
    r = random.Random(11)
    bands = Bands(3000, 80).plan(dict.fromkeys(range(40), 3000), agreement(5))
    pairs = 0
    for size in (60, 110, 240, 520, 1300, 2900):
        base = [r.getrandbits(63) for _ in range(size)]
        sets = [set(base), *[edited(base, e, size + e) for e in (1, size // 20, size // 12, size // 9)], set(base[: size - size // 6])]
        values = [np.array(sorted(s), dtype=np.uint64) for s in sets]
        found, owner = signatures(np.concatenate(values), np.array([len(v) for v in values]), bands)
        of = [set(found[owner == i].tolist()) for i in range(len(sets))]
        assert len(found) < sum(len(s) for s in sets)
        for i in range(len(sets)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    pairs += 1
                    assert of[i] & of[j], (size, i, j)
    assert pairs > 30


def test_sketches_never_rule_out_a_similar_pair():
    r = random.Random(3)
    sets = [set(base) | set() for base in ([r.getrandbits(63) for _ in range(n)] for n in (20, 90, 400))]
    sets += [edited(sorted(s), max(1, len(s) // 25), 5) for s in sets]
    values = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    sketches = [sketch(v, 90) for v in values]
    got = set(likely(np.array([len(s) for s in sets]), sketches, np.arange(6), np.zeros(6, int), 90))
    assert {(0, 3), (1, 4), (2, 5)} <= got
    assert len(got) < 6


def test_cheap_bands_get_one_deletion_segments():
    assert allocate(1, 9, 1000, 90) == Scheme(0, 0, 0)
    small, large = allocate(12, 15, 10**9, 90), allocate(500, 650, 1000, 90)
    assert small.loose > 0 and large.loose == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(100, 101)], "a long, b long")
    labels = {r["id"]: r["component"] for r in components(edges, "path").collect()}
    assert labels == {i: 0 for i in range(13)} | {100: 100, 101: 100}


def test_repeated_lines_equal_brute_force(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.repeated_lines(documents).collect()}
    assert got == odd.repeated(docs, line_dedup.PERCENT, line_dedup.LEAST_TOKENS)


def test_repeated_lines_of_odd_documents(strange):
    docs = list({r[0]: (r[0], r[1]) for r in odd.documents()}.values())
    removed = line_dedup.repeated_lines(strange)
    got = {r["doc_id"]: r["removed"] for r in removed.collect()}
    assert got == odd.repeated(docs, line_dedup.PERCENT, line_dedup.LEAST_TOKENS)
    cleaned = line_dedup.without_repeats(strange, removed)
    assert cleaned.columns == strange.columns and cleaned.count() == strange.count()
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts[12] == "an own last line with other words" and texts[4] is None and texts[1] == odd.PROSE and texts[6] == " \t\n\x0b "


def test_a_member_that_its_hub_does_not_match_is_tried_with_the_rest(spark):
    """Chains: each line is like the one before it, but not like the first."""
    words = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 24])) for i in range(18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.repeated_lines(docs).collect()}
    assert got == odd.repeated(rows, line_dedup.PERCENT, line_dedup.LEAST_TOKENS) and len(got) == 17


def test_words_of_a_line_are_worked_out_once(documents):
    """A condition on the words, pushed below them, had all lines cut into words a second time."""
    plan = line_dedup.described(documents, line_dedup.rarity(documents), 80, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == 1


def test_prefixes_rule_out_unlike_lines_alone(spark):
    """Lines that share their rarest word alone are not moved to be compared, and no similar pair is ruled out."""
    r = random.Random(5)
    rows = []
    for size in (4, 9, 25, 80, 200, 200, 200):
        base = [f"rare{len(rows)}x{i}" for i in range(size)]
        rows += [(len(rows) + k, " ".join(sorted(w for w in base if r.random() > lost) + [f"own{len(rows)}x{k}"] * (k % 2))) for k, lost in enumerate((0, 0.02, 0.08, 0.15, 0.3))]
    common = [f"common{i}" for i in range(900)]
    rows += [(1000 + i, " ".join(["shared", *r.sample(common, 150)])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = line_dedup.rarity(docs)
    firsts = line_dedup.first_lines(line_dedup.described(docs, ranks, 80, "doc_id", "text"))
    every = firsts.select(F.col("set").alias("a")).join(firsts.select(F.col("set").alias("b")), F.col("a") < F.col("b"))
    kept = line_dedup.verified(docs, every, firsts, ranks, 80, "doc_id", "text").collect()
    sets = [frozenset(t.split(" ")) for _, t in rows]
    alike = {frozenset((x, y)) for x in sets for y in sets if x != y and 100 * len(x & y) >= 80 * len(x | y)}
    assert len(alike) > 10 and sum(k.similar for k in kept) == len(alike)
    assert len(kept) < every.count() / 4


def test_repeated_lines_of_nothing(strange):
    assert line_dedup.repeated_lines(strange.limit(0)).collect() == []


def test_shared_and_null_ids_lose_no_row_and_no_link(spark):
    """Rows count by their own texts, whatever their ids."""
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    c = " ".join(f"c{i}" for i in range(60))
    rows = [(3, a, 0), (5, a, 1), (5, b, 2), (7, b + " more", 3), (None, c, 4), (None, c + " end", 5), (9, "alone and short text of its own", 6), (None, None, 7), (5, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k long")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.linked(docs, shingle=3, percent=90).collect())
    want = [(3, 58, 3), (5, 58, 3), (5, 58, 5), (7, 59, 5), (None, 58, None), (None, 59, None), (9, 5, 9), (None, 0, None), (5, 0, 5)]
    assert got == sorted((i is None, i or 0, n, c) for i, n, c in want)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    numbers = {r.k for r in kept.collect()}
    assert numbers in ({0, 2, 4, 6, 7, 8}, {0, 2, 5, 6, 7, 8})
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0
    twice = ngram_join.one_of_each(docs.unionByName(docs))
    assert twice.filter("text is not null").count() == 4
