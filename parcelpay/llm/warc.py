"""WARC archives from a page table and back, as chunk rows: no step holds a whole record beside the table's own value."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpay.llm.common import shared_folder

CHUNK = 1 << 20
BUFFER = 1 << 16
FILE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"

# Names and profile of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(path: str):
    """File system and path within it, for local paths and URIs that Arrow knows (file, hdfs, s3, gs …)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url", least_bytes: int = 0) -> DataFrame:
    """One row for each page and payload: id, uri, payload, bytes, digest, refers_to (the id whose payload it repeats).

    Of equal payloads of at least `least_bytes` bytes, the one of the smallest id is written in full. A null payload is
    an empty one. Rows that repeat both id and payload may be written twice, and are read as one record; a null id is an
    id of its own, after all others.
    The join with the first ids is by digest; adaptive execution splits a digest that many rows share.
    """
    uri = F.lit(None).cast("string") if uri_col is None or uri_col not in pages.columns else F.col(uri_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), uri.alias("uri"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    keys = rows.groupBy("id", "digest", "bytes").agg(F.min("uri").alias("uri"))
    firsts = keys.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
    refers = keys.join(firsts, "digest", "left").select(
        "id", "digest", "uri",
        F.when(~F.col("first.id").eqNullSafe(F.col("id")), F.col("first.id")).alias("refers_to"),
    )
    body = rows.select("id", "digest", "bytes", "payload")
    body, refers = (x.withColumn("key", F.struct("id", "digest")).drop("id", "digest") for x in (body, refers))
    joined = body.join(refers, F.xxhash64(body["key"]) == F.xxhash64(refers["key"]), "inner").filter(body["key"] == refers["key"])
    return joined.select(body["key"]["id"].alias("id"), "uri", "payload", "bytes", body["key"]["digest"].alias("digest"), "refers_to")


def chunk_rows(found: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Records as rows (id, chunk, data, …) of at most `chunk` bytes each; a record without stored payload has one row."""
    stored = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(stored) / chunk).cast("int") - 1)
    return found.withColumn("chunk", F.explode(F.sequence(F.lit(0), last))).select(
        "id", "digest", "uri", "bytes", "refers_to", "chunk", F.substring(stored, F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data")
    )


def write_archives(found: DataFrame, folder: str, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records to compressed archives below `folder`; one row (path, records) for each file.

    Rows of a record come one after the other, as `chunk_rows` makes them. A task streams them and checks the digest it has summed up against the
    one that the header states. Every attempt of a task writes files of its own, and only those of successful ones are
    in the result, so lost executors and repeated tasks do no harm.
    """

    def write(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa

        done: list[tuple[str, int]] = []
        out, path, count, squeeze, current, sha, stated = None, "", 0, None, None, None, ""

        def close_record() -> None:
            if current is not None:
                if sha is not None and sha.hexdigest() != stated:
                    raise ValueError(f"payload of {current[0]} does not have its digest")
                out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["id"], row["digest"])
                if row["chunk"] == 0:
                    close_record()
                    if out is not None and out.tell() > file_bytes:
                        out.close()
                        done.append((path, count))
                        out = None
                    if out is None:
                        path, count = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
                        system, place = filesystem(path)
                        system.create_dir(place.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(place)
                    current, stated, count = key, row["digest"], count + 1
                    sha = hashlib.sha1() if row["refers_to"] is None else None
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(squeeze.compress(header(row)))
                if row["data"]:
                    sha.update(row["data"])
                    out.write(squeeze.compress(row["data"]))
        if out is not None:
            close_record()
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    manifest = f"{folder}/manifest"
    chunk_rows(found, chunk).mapInArrow(write, "path string, records long").write.parquet(manifest)
    return found.sparkSession.read.parquet(manifest)


def header(row: dict) -> bytes:
    """The head of a record and of the HTTP response in it."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    uri = "".join(c for c in (row["uri"] or "") if c > " " and c != "\x7f") or name(row["id"]).strip("<>")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    again = row["refers_to"] is not None
    fields = {
        "WARC-Type": "revisit" if again else "response",
        "WARC-Record-ID": name(row["id"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": "sha1:" + base32(bytes.fromhex(row["digest"])),
        **({"WARC-Refers-To": name(row["refers_to"]), "WARC-Profile": REVISIT_PROFILE} if again else {}),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + (0 if again else row["bytes"]),
    }
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields.items()), "", ""]).encode() + http


def head_lines(stream) -> tuple[dict[str, str], int]:
    """Fields up to the empty line, and the bytes read."""
    fields, size = {}, 0
    while line := stream.readline():
        size += len(line)
        if line in (b"\r\n", b"\n"):
            break
        key, colon, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
        if colon:
            fields[key.strip().lower()] = value.strip()
    return fields, size


def parsed(stream, chunk: int) -> Iterator[dict]:
    """Chunk rows of an uncompressed archive stream, each with the bytes and the digest of its payload so far."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record head: {line[:40]!r}")
        fields, _ = head_lines(stream)
        left = int(fields["content-length"])
        http, size = head_lines(stream)
        left -= size
        kind = fields["warc-type"]
        name = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None
        common = {"record": name(fields["warc-record-id"]), "kind": kind, "refers_to": name(fields.get("warc-refers-to", ""))}
        if kind == "revisit":
            yield common | {"chunk": 0, "data": b"", "bytes": int(http["content-length"]), "digest": fields["warc-payload-digest"].removeprefix("sha1:"), "last": True}
            continue
        sha, done, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if left and not data:
                raise ValueError(f"record {common['record']} is cut short")
            left -= len(data)
            done += len(data)
            sha.update(data)
            yield common | {"chunk": number, "data": data, "bytes": done, "digest": base32(sha.digest()), "last": not left}
            number += 1
            if not left:
                break
        if "sha1:" + base32(sha.digest()) != fields["warc-payload-digest"]:
            raise ValueError(f"record {common['record']} does not have its digest")


def read_chunks(spark: SparkSession, paths: DataFrame, with_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of the archives in column `path`: record, chunk, data, bytes, digest, last, kind, refers_to.

    `bytes` and `digest` sum up the payload to the end of the chunk; those of a record's last chunk are of the whole
    payload. A revisit has one row with what its head states. Without data, a record's last row alone is given.
    """
    names = ["record", "chunk", "data", "bytes", "digest", "last", "kind", "refers_to"]

    def read(batches: Iterator) -> Iterator:
        import gzip
        import io

        import pyarrow as pa

        kinds = pa.schema([("record", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("bytes", pa.int64()), ("digest", pa.string()), ("last", pa.bool_()), ("kind", pa.string()), ("refers_to", pa.string())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = filesystem(path)
                rows, held = [], 0
                with system.open_input_stream(place) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw, BUFFER)) as stream:
                    for row in parsed(stream, chunk):
                        if not with_data:
                            if not row["last"]:
                                continue
                            row["data"] = None
                        rows.append(row)
                        held += len(row["data"] or b"") + 200
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    schema = "record string, chunk int, data binary, bytes long, digest string, last boolean, kind string, refers_to string"
    return paths.select("path").repartition(spark.sparkContext.defaultParallelism).mapInArrow(read, schema).select(*names)


def archived(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url", least_bytes: int = 0) -> DataFrame:
    """Writes all pages to archives in `folder` and reads these back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    manifest = write_archives(records(pages, id_col, payload_col, uri_col, least_bytes), folder or shared_folder(spark, "archives"))
    last = read_chunks(spark, manifest, with_data=False).dropDuplicates(["record", "digest"])
    return last.select(
        F.col("record").cast(kind).alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"),
    )
