"""WARC archives through a table of chunks: no record is held whole."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import saved, shuffle_partitions
from tremorline.llm.token_files import store_of

CHUNK_BYTES = 1 << 20

# Equal payloads shorter than this are written again rather than referred to.
LEAST_REVISIT_BYTES = 100

_DATE = "2024-01-01T00:00:00Z"
_ID = re.compile(rb"<urn:record:(.*)>")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def warc_records(
    rows: DataFrame, id_column: str, uri_column: str, payload_column: str, least_bytes: int = LEAST_REVISIT_BYTES
) -> DataFrame:
    """One row per record: record_id, uri, payload, payload_bytes, payload_digest,
    record_type, refers_to.

    Of rows with equal payloads of at least least_bytes, the one with the smallest
    id is a response and the others revisit it; all others are responses. A row
    that repeats the smallest id is a response too. Null payloads are empty; a
    null id is never the smallest while another is there.
    """
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    listed = rows.select(F.col(id_column).alias("id"), F.col(uri_column).cast("string").alias("uri"), payload.alias("payload"))
    sized = listed.withColumn("payload_bytes", F.length("payload").cast("bigint")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    # The digest decides what is equal; payloads stay out of this exchange.
    firsts = (
        sized.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "first")
    )
    # Short payloads find no partner; their own keys keep them spread.
    key = F.when(F.col("payload_bytes") >= least_bytes, F.col("payload_digest")).otherwise(
        F.concat(F.lit("short "), F.xxhash64("id").cast("string"))
    )
    known = sized.withColumn("key", key).join(firsts, F.col("key") == F.col("digest"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return known.select(
        F.col("id").cast("string").alias("record_id"),
        "uri",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(refers.isNotNull(), "revisit").otherwise("response").alias("record_type"),
        refers.cast("string").alias("refers_to"),
    )


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records as rows of (record, chunk_no, data): pieces of at most chunk_bytes.

    Empty payloads and revisits are one row without data. The rows of a record
    stand together, in order.
    """
    stored = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    pieces = F.greatest(F.ceil(F.length("stored") / chunk_bytes), F.lit(1)).cast("int")
    return (
        records.withColumn("stored", stored)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .withColumn("data", F.substring("stored", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
        .drop("payload", "stored")
    )


def _head(row: dict) -> bytes:
    """The WARC header, and for a response the HTTP header before its payload."""
    http = _HTTP % row["payload_bytes"]
    response = row["record_type"] == "response"
    length = len(http) + (row["payload_bytes"] if response else 0)
    name = lambda i: f"<urn:record:{quote(i, safe='') if i is not None else ''}>"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", name(row["record_id"])),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(length)),
    ]
    if row["uri"] is not None:
        fields.append(("WARC-Target-URI", quote(row["uri"], safe=":/?#[]@!$&'()*+,;=-._~%")))
    if not response:
        fields.append(("WARC-Refers-To", name(row["refers_to"])))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("ascii") + b"\r\n" + http


def write_warc(chunks: DataFrame, folder: str) -> DataFrame:
    """Write a chunk table to gzipped archives, one member per record.

    A task writes one archive and holds one batch of chunks. A task that is run
    again writes another file; the returned manifest (file, records), written to
    the scratch folder, names those that count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, records, member = None, 0, None
        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            meta = batch.drop_columns(["data"]).to_pylist()
            for row, data in zip(meta, batch.column("data")):
                if sink is None:
                    store, path = store_of(folder)
                    store.create_dir(path, recursive=True)
                    sink = store.open_output_stream(store_of(name)[1], compression=None)
                if row["chunk_no"] == 0:
                    if member is not None:
                        sink.write(member.compress(b"\r\n\r\n") + member.flush())
                    member = zlib.compressobj(1, wbits=31)
                    sink.write(member.compress(_head(row)))
                    records += 1
                sink.write(member.compress(data.as_buffer()))
        if sink is not None:
            sink.write(member.compress(b"\r\n\r\n") + member.flush())
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([records], pa.int64())})

    columns = ["record_id", "record_type", "refers_to", "uri", "payload_bytes", "payload_digest", "chunk_no", "data"]
    return saved(chunks.select(*columns).mapInArrow(write, "file STRING, records BIGINT"), "warc-manifest")


def _inflated(source, piece: int) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether a member ends here) of a file of gzip members."""
    member, data = zlib.decompressobj(wbits=31), b""
    while True:
        data = data or source.read(piece)
        if not data:
            if rest := member.flush():
                yield rest, member.eof
            return
        out = member.decompress(data, piece)
        data = member.unconsumed_tail
        if member.eof:
            data, member = member.unused_data, zlib.decompressobj(wbits=31)
            yield out, True
        else:
            yield out, False


def read_warc(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives, with running digests.

    record_id, record_type, refers_to, uri, chunk_no, data (null without
    with_data), running_bytes and running_sha256 (of the payload up to and with
    this chunk), last, and the payload's length and digest as the header states
    them. Tasks stream files and hold one chunk. The last chunk of a response has
    the digest of the payload as read; another than the stated one is an error.
    """

    def parsed(file: str) -> Iterator[dict]:
        store, path = store_of(file)
        with store.open_input_stream(path, compression=None) as source:
            state, held, row, left, digest, done, number = "warc", b"", {}, 0, None, 0, 0
            for data, ends in _inflated(source, chunk_bytes):
                held += data
                if state == "warc" and (end := held.find(b"\r\n\r\n")) >= 0:
                    fields = dict(line.split(b": ", 1) for line in held[:end].split(b"\r\n")[1:])
                    names = {k: _ID.fullmatch(fields[k]) for k in (b"WARC-Record-ID", b"WARC-Refers-To") if k in fields}
                    plain = {k: unquote(m[1].decode()) or None for k, m in names.items()}
                    uri = fields.get(b"WARC-Target-URI")
                    row = {
                        "record_id": plain[b"WARC-Record-ID"],
                        "record_type": fields[b"WARC-Type"].decode(),
                        "refers_to": plain.get(b"WARC-Refers-To"),
                        "uri": unquote(uri.decode()) if uri is not None else None,
                        "payload_bytes": int(fields[b"WARC-Payload-Length"]),
                        "payload_digest": fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode(),
                    }
                    held, state = held[end + 4 :], "http"
                if state == "http" and (end := held.find(b"\r\n\r\n")) >= 0:
                    held, state = held[end + 4 :], "payload"
                    left = row["payload_bytes"] if row["record_type"] == "response" else 0
                    digest, done, number = hashlib.sha256(), 0, 0
                while state == "payload" and (len(held) >= min(left, chunk_bytes)):
                    piece, held = held[: min(left, chunk_bytes)], held[min(left, chunk_bytes) :]
                    digest.update(piece)
                    left, done = left - len(piece), done + len(piece)
                    if not left and row["record_type"] == "response" and digest.hexdigest() != row["payload_digest"]:
                        raise ValueError(f"record {row['record_id']} of {file} is damaged")
                    yield row | {
                        "chunk_no": number,
                        "data": piece if with_data else None,
                        "running_bytes": done,
                        "running_sha256": digest.hexdigest(),
                        "last": not left,
                    }
                    number += 1
                    if not left:
                        state = "end"
                if ends:
                    if state != "end" or held != b"\r\n\r\n":
                        raise ValueError(f"{file} is cut short")
                    state, held = "warc", b""
            if state != "warc" or held:
                raise ValueError(f"{file} is cut short")

    shape = (
        "record_id STRING, record_type STRING, refers_to STRING, uri STRING, payload_bytes BIGINT, "
        "payload_digest STRING, chunk_no INT, data BINARY, running_bytes BIGINT, running_sha256 STRING, last BOOLEAN"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        names = [part.split()[0] for part in shape.split(", ")]
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                for row in parsed(file):
                    rows.append(row)
                    held += len(row["data"] or b"")
                    if len(rows) >= 1000 or held >= 8 * chunk_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("file").repartition(shuffle_partitions(manifest.sparkSession)).mapInArrow(read, shape)


def payload_index(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: length and digest of the full payload.

    A response's are those that reading has counted; a revisit states those of
    the payload it refers to.
    """
    read = F.col("record_type") == "response"
    return chunks.where("last").select(
        "record_id",
        F.when(read, F.col("running_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(read, F.col("running_sha256")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
