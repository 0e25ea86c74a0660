"""Registered queries on unusual documents, against plain Python versions of what they have to return."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from parcelpay.llm import mixing, queries
from tests.llm import odd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(odd.documents()[:-2], odd.SCHEMA).write.parquet(f"{path}/documents.parquet")
    pages = [(1, "u1", "<p>a</p>"), (2, "u2", None), (3, None, "<p>a</p>"), (4, "u4", ""), (5, "u5", "ü" * 3_000_000), (6, "u1", "<p>b\r\n\r\n</p>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path)


@pytest.fixture(scope="module")
def texts():
    return {row[0]: row[1] for row in odd.documents()}


def result(spark, folder, query):
    return {r[0]: r.asDict() for r in query(spark, folder).collect()}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def test_packed_pieces_are_the_documents(spark, folder, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    rows = [r.asDict() for r in queries.op2_best_fit_packing(spark, folder).collect()]
    for key, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted((r for r in rows if r["doc_id"] == key), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) and (len(own) == 1 or all(r["length"] == 1024 for r in own[1:]))
        for r in own:
            packed = b"".join(i.to_bytes(4, "little") for i in ids[r["start"] : r["start"] + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(packed)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_base_spans_of_personal_data(spark, folder, texts):
    rows = result(spark, folder, queries.op3_personal_data)
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        base = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]
        row = rows[key]
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(b[0] == k for b in base) for k in PATTERNS]
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(","))


def test_mix_comes_near_its_targets(spark, folder, texts):
    rows = result(spark, folder, queries.op4_source_mixing)
    sources = {row[0]: row[3] for row in odd.documents()}
    sizes = Counter()
    for key, text in texts.items():
        assert rows[key]["size"] == len(odd.WORD.findall(text or ""))
        sizes[sources[key]] += rows[key]["size"]
    wanted = mixing.targets(sizes)
    for key, row in rows.items():
        assert row["source_size"] == sizes[sources[key]] and row["target"] == pytest.approx(wanted[sources[key]])
        assert row["taken"] <= 2 * row["size"]
    assert rows == result(spark, folder, queries.op4_source_mixing)


def test_quality_counts(spark, folder, texts):
    rows = result(spark, folder, queries.op5_quality_rules)
    for key, text in texts.items():
        words = odd.WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if odd.WORD.search(x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
        row = rows[key]
        got = [row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert got == [len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)]
        assert row["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_languages_are_learned_ones(spark, folder, texts):
    rows = result(spark, folder, queries.op6_language_id)
    for key, text in texts.items():
        row = rows[key]
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text or "")) and row["lang_pred"] in ("en", "fr", "und")
        assert 0 <= row["score"] <= 1


def test_edited_texts_and_likeness(spark, folder, texts):
    rows = result(spark, folder, queries.op8_weighted_fingerprints)
    order = sorted(texts, reverse=True)
    for at, key in enumerate(order):
        text, after = texts[key] or "", texts[order[(at + 1) % len(order)]] or ""
        n = len(text) // 3
        row = rows[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert rows[1]["fingerprint"] == rows[2]["fingerprint"] and rows[4]["fingerprint"] == rows[5]["fingerprint"]
    assert rows[2]["near_next"] == 1.0


def test_archives_return_what_was_written(spark, folder):
    rows = result(spark, folder, queries.op9_warc_archives)
    pages = {r[0]: (r[1] or "").encode() for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()}
    for key, payload in pages.items():
        first = min(k for k, p in pages.items() if p == payload)
        assert rows[key] == {
            "page_id": key, "payload_bytes": len(payload), "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "record_type": "response" if key == first else "revisit", "refers_to": None if key == first else first,
        }


def test_shards_have_equal_counts_and_gapless_slots(spark, folder, texts):
    rows = result(spark, folder, queries.op10_feistel_sharding)
    slots: dict[int, list[int]] = {}
    for key, text in texts.items():
        data = (text or "").encode()
        assert (rows[key]["size"], rows[key]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        slots.setdefault(rows[key]["shard"], []).append(rows[key]["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    counts = [len(slots.get(s, [])) for s in range(8)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("name", queries.QUERIES)
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    spark.createDataFrame([], odd.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_pipeline_keeps_clean_documents(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    spark.createDataFrame([], odd.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_base_spans_of_spaced_digits(spark, tmp_path):
    """Numbers whose digits are all apart are base spans, too."""
    rows = [
        (1, "pay 4-1-1-1 1-1-1-1-1-1-1-1-1-1-1-1 now"), (2, "call +1 2 3 4 5 6 7 8 9 ok"), (3, "at 1.2.3.4, 5 . 6"), (4, "x@y.z"),
        (5, "+1(2)3(4)5(6)7(8)9"), (6, "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op3_personal_data(spark, str(tmp_path)).collect()}
    for i, text in rows:
        kinds = {k: [m for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PATTERNS.items()}
        listed = ",".join(f"{k}:{m.start()}:{m.end()}" for k in PATTERNS for m in kinds[k])
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [len(kinds[k]) for k in PATTERNS]
        assert found[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert found[1].n_card == found[6].n_card == 1 and found[2].n_phone == 1


def test_mix_takes_near_the_targets_and_keeps_all_columns(spark):
    """Three sources of very unequal sizes, in columns whose names the operator might use itself."""
    import random

    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([1, 3, 20, 90, 400]), "abc"[min(i % 7, 2)], 1, 2, 3, 4, 5) for i in range(3000)]
    names = ["doc_id", "text", "source", "__bucket", "__size", "__row", "row", "size"]
    docs = spark.createDataFrame(rows, names)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*names, "mix"]
    taken, target = Counter(), {}
    for r in mixed.collect():
        taken[r["source"]] += r["mix"]["size"] * r["mix"]["copies"]
        target[r["source"]] = r["mix"]["target"]
        assert r["mix"]["copies"] in (0, 1, 2) and (r["__bucket"], r["__size"], r["__row"], r["row"], r["size"]) == (1, 2, 3, 4, 5)
    assert all(abs(taken[s] - target[s]) < 0.02 * target[s] for s in target) and len(target) == 3
    again = mixing.repeated(mixed)
    assert again.columns == names and again.count() == sum(r["mix"]["copies"] for r in mixed.collect())
