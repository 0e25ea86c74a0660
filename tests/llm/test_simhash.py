"""Simhash: fingerprints, keys and components against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from parcelpay.llm import golay, queries, simhash
from tests.llm import odd

MASK = (1 << 64) - 1


def plain_print(text: str | None) -> int:
    words = odd.WORD.findall((text or "").translate(odd.UPPER))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict) -> dict:
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_every_word_is_near_its_code_word():
    table = golay.decoder()
    index = np.arange(4096, dtype=np.uint32)
    codes = np.zeros_like(index)
    for bit in range(12):
        codes ^= np.where(index >> bit & 1, np.uint32(golay.GENERATOR << bit), np.uint32(0))
    words = np.arange(0, 1 << 23, 7, dtype=np.uint32)
    assert np.bitwise_count(words ^ codes[table[words]]).max() == 3


@pytest.mark.parametrize("seed", range(3))
def test_pairs_within_the_limit_share_a_key(seed):
    rng = np.random.default_rng(seed)
    left = rng.integers(0, 1 << 64, 1500, dtype=np.uint64)
    right = left.copy()
    for i in range(len(right)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            right[i] ^= np.uint64(1) << np.uint64(bit)
    keys = []
    for fps in (left, right):
        key, owner, fixed = simhash.fuzzy_keys(fps)
        own = [set() for _ in fps]
        for k, o in zip(key.tolist(), owner.tolist()):
            own[o].add(k)
        keys.append(own)
        assert len(key) < 40 * len(fps)
    assert all(a & b for a, b in zip(*keys))


def test_fingerprints_of_unusual_texts():
    rng = random.Random(5)
    texts = [row[1] for row in odd.documents()]
    for _ in range(300):
        pieces = [rng.choice(["A", "b", "Ünï", "ẞ", "dog", "\x1c", "\xa0"]) for _ in range(rng.randint(0, 9))]
        texts.append("".join(p + rng.choice([" ", "  ", "\n", "\t \x0b", "\r\f"]) for p in pieces)[rng.randint(0, 1) :])
    texts += [" ".join(f"w{i % 977}" for i in range(simhash.CHUNK + 50)), "x" * 1_000_000]
    for text in texts:
        assert simhash.fingerprint(text) & MASK == plain_print(text)


@pytest.mark.parametrize("bucket", [30, simhash.BUCKET])
def test_dense_fingerprints(spark, bucket):
    """Clusters around a few centres, chains and lone fingerprints, also where every key has to be split."""
    rng = random.Random(11)
    fps = {0, MASK, 1, 0b11111}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
        step = centre
        for _ in range(5):
            step ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.add(step)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket).collect()
    parent = {f: f for f in signed}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert ((a ^ b) & MASK).bit_count() <= 4
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = plain_components({f: f & MASK for f in signed})
    assert {f: root(f) for f in signed} == want
    if bucket == simhash.BUCKET:
        assert len(links) < 34 * len(signed)


def test_query_on_unusual_documents(spark, tmp_path):
    rows = [*odd.documents()[:-2], (90, odd.PROSE.upper(), "en", "s", 1, "k", "m", "s", "c"), (91, "a b c d e", "en", "s", 1, "k", "m", "s", "c")]
    spark.createDataFrame(rows, odd.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op11_simhash_golay(spark, str(tmp_path)).collect()}
    prints = {r[0]: plain_print(r[1]) for r in rows}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in found.items()} == plain_components(prints)


def test_null_and_repeated_ids_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", odd.PROSE), ("a", odd.PROSE), (None, odd.PROSE), ("b", odd.PROSE), (None, "alone"), ("z", None)], "doc_id string, text string")
    found = sorted(map(str, (tuple(r[i] for i in (0, 2)) for r in simhash.near_duplicates(docs).collect())))
    assert found == sorted(map(str, [("b", "a"), ("a", "a"), (None, "a"), ("b", "a"), (None, None), ("z", "z")]))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
