"""Merkle manifest and proofs against a plain version."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from parcelpay.llm import merkle, queries
from tests.llm import odd


def h(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests: list[str], arity: int, at: int | None = None, bent: str | None = None) -> tuple[str, list[str], str | None]:
    """Root, siblings of leaf `at` from below, and the root that its path gives for `bent`."""
    beside = []
    while len(digests) > 1:
        runs = [digests[i : i + arity] for i in range(0, len(digests), arity)]
        if at is not None:
            own, mine = runs[at // arity], at % arity
            beside += own[:mine] + own[mine + 1 :]
            bent = h(*own[:mine], bent, *own[mine + 1 :])
            at //= arity
        digests = [h(*run) for run in runs]
    return digests[0], beside, bent


def plain(rows: list[tuple], arity: int = 16) -> dict:
    """Per doc_id: leaf, subroot, root, proof digest, folded root. Rows are (doc_id, text, lang, source, n_chars)."""
    leaf = {r[0]: h(*map(field, (r[0], r[3], r[2], r[4], r[1]))) for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = [[leaf[r[0]] for r in sorted((r for r in rows if r[3] == s), key=lambda r: r[0])] for s in sources]
    subroots = [climb(t, arity)[0] for t in trees]
    out = {}
    for r in rows:
        tree = sources.index(r[3])
        bent = leaf[r[0]]
        if zlib.crc32(str(r[0]).encode()) % 5 == 0:
            bent = h(*map(field, (r[0], r[3], r[2], r[4], None if r[1] is None else r[1].translate(odd.UPPER))))
        subroot, below, bent = climb(trees[tree], arity, trees[tree].index(leaf[r[0]]), bent)
        root, above, bent = climb(subroots, arity, tree, bent)
        out[r[0]] = (leaf[r[0]], subroot, root, h(*below, *above), bent, bent == root)
    return out


@pytest.fixture(scope="module")
def rows():
    some = [r[:5] for r in odd.documents()[:-2]]
    some += [(100 + i, f"Text {i} Of Many", "en", "big", i) for i in range(600)]
    some += [(2000 + i, None if i % 7 == 0 else f"Lone {i}", None, f"source {i:03d}é", None) for i in range(40)]
    return some


def test_query_equals_the_plain_version(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, tree string, idx string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_merkle_manifest(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == plain(rows)


@pytest.mark.parametrize("arity, block", [(2, 1), (3, 7), (16, 48), (16, 10_000)])
def test_blocks_of_any_size_prove_alike(spark, rows, arity, block):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(docs, "doc_id", "source", queries.LEAF_COLUMNS, arity=arity)
    found = merkle.prove(made, block=block, full=True).collect()
    want = plain(rows, arity)
    assert len(found) == len(want)
    for r in found:
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == want[r.key][:4]
        assert r.verified and h(*[d for level in r.proof for d in level]) == r.proof_sha256


def test_missing_nodes_are_the_least():
    """No fetched node can be computed from the block's leaves or from other fetched nodes."""
    for size in (1, 2, 16, 17, 257, 1000):
        for low in (0, 5, 16, size - 1):
            for high in (low + 1, min(low + 20, size), size):
                if not 0 <= low < high <= size:
                    continue
                known, n, level = set(range(low, high)), size, 0
                asked = set(merkle.missing(low, high, size, 16))
                while n > 1:
                    runs = {i // 16 for i in known}
                    need = {i for r in runs for i in range(r * 16, min(r * 16 + 16, n))} - known
                    assert {i for at, i in asked if at == level} == need
                    known, n, level = runs, -(-n // 16), level + 1
                assert max((at for at, _ in asked), default=0) <= level


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id string, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), ("a", "x", None, None, 1), ("a", "x", None, None, 1), ("b", "", "", "", 0)], schema)
    made = merkle.manifest(docs, "doc_id", "source", queries.LEAF_COLUMNS)
    found = merkle.prove(made).collect()
    assert len(found) == 4 and all(r.verified for r in found) and made.groups == 2
    none = h("-----")
    twice = h(*map(field, ("a", None, None, 1, "x")))
    assert sorted(r.leaf for r in found if r.key != "b") == sorted([none, twice, twice])
    assert {r.subroot for r in found if r.key != "b"} == {h(none, twice, twice)}
    assert merkle.prove(merkle.manifest(docs.limit(0), "doc_id", "source", queries.LEAF_COLUMNS)).count() == 0


def test_a_changed_other_digest_is_not_verified(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 3}", 1) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(docs, "doc_id", "source", queries.LEAF_COLUMNS, other=F.when(F.col("doc_id") == 7, F.sha2(F.lit("forged").cast("binary"), 256)))
    assert [r.key for r in merkle.prove(made).collect() if not r.verified] == [7]
