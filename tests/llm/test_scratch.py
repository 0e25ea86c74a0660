"""What the operators write on the way: no more than they need, and not for longer."""

from __future__ import annotations

import random
import time
from pathlib import Path

import numpy as np
import pyarrow as pa

from parcelpay.llm import line_dedup, ngram_join
from parcelpay.llm.common import forget, written
from parcelpay.llm.signatures import Bands, near, signatures, sketch
from parcelpay.session import FREE_SHUFFLES
from tests.conftest import SMALL


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in blocks.split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_with_the_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    table = written(spark.range(1000).repartition(3, "id"), "freed")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and table.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES, None) == setting


def test_forgotten_tables_leave_no_file(spark):
    table = written(spark.range(10), "forgotten")
    folder = Path(table.written_to.removeprefix("file:"))
    assert folder.exists()
    forget(table)
    assert not folder.exists()


def test_sets_members_and_lines_are_not_left_behind(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    root = Path(written(spark.range(1), "root").written_to.removeprefix("file:")).parent
    before = set(root.iterdir())
    assert ngram_join.one_of_each(docs).count() and line_dedup.repeated_lines(docs).count() >= 0
    left = {p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before}
    assert not left & {"members", "stars", "sketches", "star-pairs", "sets", "pairs", "classes", "lines", "firsts", "line-pairs", "line-likely", "line-matches"}


def planned(sizes: list[int]) -> Bands:
    bands = Bands(max(sizes), 80)
    return bands.plan({int(b): 1 for b in bands.of(np.array(sizes))}, 0.01)


def test_signatures_of_a_part_travel_in_one_row():
    r = random.Random(3)
    sets = [sorted(r.getrandbits(63) for _ in range(n)) for n in (300, 310, 1, 40)]
    bands, parts = planned([len(s) for s in sets]), 4
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["k", "set"])
    rows = [row for out in ngram_join.indexed(iter([batch]), bands, parts) for row in out.to_pylist()]
    found, owner = signatures(np.concatenate([np.array(s, np.uint64) for s in sets]), np.array([len(s) for s in sets]), bands)
    want = sorted((int(o), int(f >> np.uint64(62)), int(f.astype(np.uint32).view(np.int32))) for f, o in zip(found, owner))
    assert sorted((row["id"], row["part"], rest) for row in rows for rest in row["rests"]) == want
    assert len(rows) <= 4 * parts < len(want) / 10


def test_rows_of_one_signature_are_members_once():
    rows = [(1, 5), (1, 5), (2, 5), (2, 5), (2, 6), (3, 1), (4, 1), (4, 2), (4, 2), (4, 3)]
    for cut in range(len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in part], pa.int64()) for k in (0, 1)], names=["signature", "id"]) for part in (rows[:cut], rows[cut:])]
        got = [tuple(x.values()) for out in ngram_join.buckets(iter(batches)) for x in out.to_pylist()]
        assert got == [(2, 5), (2, 6), (4, 1), (4, 2), (4, 3)]


def test_sketches_rule_out_unlike_sets_and_no_link():
    r = random.Random(7)
    pairs = []
    for n in (3, 20, 90, 400, 1500):
        base = [r.getrandbits(63) for _ in range(n)]
        for share in (0, 0.03, 0.1, 0.12, 0.6, 1):
            other = base[int(share * n) :] + [r.getrandbits(63) for _ in range(int(share * n))]
            pairs.append((base, other[: max(1, int(n * r.uniform(0.75, 1)))]))
    a, b = ([np.array(p[k], dtype=np.uint64) for p in pairs] for k in (0, 1))
    ok = near(np.array([len(x) for x in a]), np.array([len(x) for x in b]), [sketch(x, 80) for x in a], [sketch(x, 80) for x in b], 80)
    linked = np.array([100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y)) for x, y in pairs])
    assert linked.any() and not (linked & ~ok).any() and ok.sum() < len(pairs) * 0.7


def test_only_sets_of_likely_pairs_are_moved(spark, monkeypatch):
    """Documents that share a signature alone: their sets stay where they are."""
    words = [f"w{i}" for i in range(400)]
    r = random.Random(11)
    rows = [(i, " ".join(r.sample(words, 8)) + " " + " ".join(f"s{j}" for j in range(4))) for i in range(60)] + [(100 + i, " ".join(words) + " x" * i) for i in range(2)]
    seen = {}
    kept = ngram_join.sets_of
    monkeypatch.setattr(ngram_join, "sets_of", lambda source, classes, pairs, shingle: seen.setdefault(len(seen), kept(source, classes, pairs, shingle).localCheckpoint()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in ngram_join.linked(docs, 3, 80).collect()}
    assert got == {i: i for i, _ in rows} | {101: 100}
    assert sum(s.count() for s in seen.values()) == 2
