"""The rank that splits hot groups gives the plain rank."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelpay.operators.ranking import ROWS_PER_TASK, cuts, rank_within

DDL = "a string, b int, con string, other int"


def brute(data):
    groups = defaultdict(list)
    for a, b, con, _ in data:
        groups[(a, b)].append(con)
    key = lambda c: (c is None, c or "")
    return Counter((a, b, con, other, 1 + sum(key(x) < key(con) for x in groups[(a, b)])) for a, b, con, other in data)


def ranked(spark, data, rows_per_task=20):
    df = spark.createDataFrame(data, DDL)
    out = rank_within(df, ["a", "b"], "con", load=df, load_keys=["a", "b"], rows_per_task=rows_per_task)
    return Counter(tuple(r) for r in out.select("a", "b", "con", "other", "rank").collect())


def skewed(n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # A third of the rows shares one group, another third one with a NULL key.
        a, b = rnd.choice([("hot", 1), (None, 2), (f"k{rnd.randrange(300)}", rnd.randrange(3))])
        con = rnd.choice([None, "", f"C{rnd.randrange(900):08d}", f"C{rnd.randrange(900):08d}001", f"{rnd.randrange(9)}"])
        data.append((a, b, con, i % 5))
    return data


def test_split_rank_equals_plain_rank_and_brute_force(spark):
    data = skewed()
    want = brute(data)
    assert ranked(spark, data) == want
    assert ranked(spark, data, rows_per_task=10_000) == want


@pytest.mark.parametrize("head", ["C", "LM2023010", ""])
def test_hot_group_is_spread_over_parts_whatever_its_texts_share(spark, head):
    rows = [("hot", 1, f"{head}{i:06d}", 0) for i in range(3000)] + [("hot", 1, "Z", 0), ("hot", 1, "A", 0)]
    df = spark.createDataFrame(rows, DDL)
    out = rank_within(df, ["a", "b"], "con", load=df, load_keys=["a", "b"], rows_per_task=100)
    sizes = [r["count"] for r in out.groupBy("_part").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 300
    assert out.agg(F.max("rank")).collect()[0][0] == 3002


def test_nothing_large_leaves_a_plain_window(spark):
    data = [(f"k{i}", i, f"C{i}", 0) for i in range(500)]
    df = spark.createDataFrame(data, DDL)
    out = rank_within(df, ["a", "b"], "con", load=df, load_keys=["a", "b"]).select("a", "b", "con", "other", "rank")
    assert Counter(tuple(r) for r in out.collect()) == brute(data)
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "Join" not in final and "Window" in final


def test_rows_are_dealt_once_for_ranks_and_sizes(spark):
    """Both exchanges by stretch have the same columns, so the second one is the first one."""
    df = spark.createDataFrame(skewed(300), DDL).distinct()
    out = rank_within(df, ["a", "b"], "con", load=df, load_keys=["a", "b"], rows_per_task=20)
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(_part#" in line]
    assert len(below) == 2 and all("Project [struct(" in line and "con#" in line and "other#" in line for line in below)


def test_building_the_rank_runs_no_job(spark):
    df = spark.createDataFrame(skewed(300), DDL)
    spark.sparkContext.setJobGroup("building", "building")
    out = rank_within(df, ["a", "b"], "con", load=df, load_keys=["a", "b"], rows_per_task=20)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("running", "running")
    assert out.count() == 300
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("running"))


def test_a_group_of_ten_million_rows_is_in_many_pieces(spark):
    """With production settings; only the pieces are looked at."""
    rows = spark.range(0, 10_000_000, 1, 8).select(
        F.lit("hot").alias("a"), F.lit(1).alias("b"), F.concat(F.lit("LM2023"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("con")
    )
    found = cuts(rows, ["a", "b"], "con", ROWS_PER_TASK).collect()
    assert len(found) == 1
    texts = found[0]["_cuts"]
    assert len(texts) > 64 and texts == sorted(texts)
    places = [0, *[int(t[6:]) for t in texts], 10_000_000]
    assert max(b - a for a, b in zip(places, places[1:])) < ROWS_PER_TASK


def test_a_group_of_few_texts_is_cut_between_them(spark):
    rows = [("hot", 1, f"T{i % 9}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, DDL)
    assert ranked(spark, rows, rows_per_task=100) == brute(rows)
    assert len(cuts(df, ["a", "b"], "con", 100).collect()[0]["_cuts"]) >= 8


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["x", None]),
            st.sampled_from([1, None]),
            st.one_of(st.none(), st.text(alphabet="AB0", max_size=5)),
            st.integers(0, 2),
        ),
        min_size=30,
        max_size=80,
    )
)
def test_split_rank_on_any_texts(spark, data):
    assert ranked(spark, data, rows_per_task=10) == brute(data)
