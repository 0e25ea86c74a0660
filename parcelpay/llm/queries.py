"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpay.llm import (
    fingerprints,
    langid,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    repair,
    sharding,
    simhash,
    warc,
)
from parcelpay.llm.common import lower_ascii, written
from parcelpay.llm.oracle import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    return found.select(
        "doc_id",
        *[F.size(F.col("base")[k]).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.base_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("found")).alias("spans"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    m = F.col("mix")
    return mixed.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["copies"]).alias("taken"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.sample(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    removed = line_dedup.repeated_lines(docs)
    none = F.array().cast("array<int>")
    return (
        docs.select("doc_id", n_lines.alias("n_lines")).join(removed, "doc_id", "left")
        .select("doc_id", "n_lines", F.coalesce(F.size("removed").cast("long"), F.lit(0)).alias("n_removed"), F.coalesce("removed", none).alias("removed"))
    )


def op8_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard(rows, 8, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: What a leaf holds, in this order.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents and each one's proof, some of them against a text in lower case."""
    docs = table(spark, sf_dir, "documents")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    bent = merkle.digest_of([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    found = merkle.manifest(docs, "doc_id", "source", LEAF_COLUMNS, other=F.when(chosen, bent))
    return merkle.prove(found).withColumnRenamed("key", "doc_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a checksum, turns are dropped, emptied, cut short, repeated or given to the user.

    Null roles and texts are one space, as are null ids and turns in the checksum. Only the four columns are kept.
    """

    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return rows.filter("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _text_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's `role:text` lines; its rows follow each other."""
    conv, digest, found = None, sha256(), []
    for batch in batches:
        for c, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv", "role", "text")]):
            if c != conv:
                if conv is not None:
                    found.append((conv, digest.hexdigest()))
                conv, digest = c, sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
    if conv is not None:
        found.append((conv, digest.hexdigest()))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["conv", "repaired_sha256"])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation.

    The digest of a repaired conversation runs through its turns one by one, in one task, as the digest asks for; its
    turns are streamed, not collected.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = written(repair.turns_of(damaged(rows)), "repair-turns")
    plans = written(repair.repair_plans(turns), "repair-plans")
    digests = repair.repaired_turns(turns, plans).mapInArrow(_text_digests, "conv string, repaired_sha256 string")
    ids = rows.select("conv_id", repair.conversation_key(F.col("conv_id")).alias("conv")).distinct()
    found = ids.join(plans, "conv", "left").join(digests, "conv", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(sha256().hexdigest())
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_best_fit_packing,
        op3_personal_data,
        op4_source_mixing,
        op5_quality_rules,
        op6_language_id,
        op7_line_dedup,
        op8_weighted_fingerprints,
        op9_warc_archives,
        op10_feistel_sharding,
        op11_simhash_golay,
        op12_merkle_manifest,
        op13_conversation_repair,
    )
}
