"""WARC archives: a request, a response or revisit, and a metadata record for each page, and back.

Reading assembles each capture from its records: request and metadata name the record they belong to
as concurrent-to. A revisit is resolved by the digest of its payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telhado.operators.joins import lookup_join
from telhado.session import fresh_path, materialise

from .common import arrow_map, texts
from .files import read_stream, write_stream

REVISIT_BYTES = 1000
ROLL_BYTES = 256 << 20
ROWS_OUT = 500
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "kind string, record_id string, concurrent_to string, uri string, date string, payload_digest string, "
    "payload_bytes long, fields string"
)


def _record(kind: str, record_id: str, uri: str, block: bytes, content: str, **headers: str) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {uri}"] if uri else []),
        *(f"{k.replace('_', '-')}: {v}" for k, v in headers.items()),
        f"Content-Type: {content}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _records(page_id: int | None, url: str, payload: bytes, digest: str, revisit: bool) -> Iterator[bytes]:
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")
    capture, path = str(uuid.uuid4()), uri.split("://", 1)[-1].partition("/")
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    concurrent = {"WARC_Concurrent_To": f"<urn:uuid:{capture}>"}
    ask = f"GET /{path[2]} HTTP/1.1\r\nHost: {path[0]}\r\n\r\n".encode()
    yield _record("request", str(uuid.uuid4()), uri, ask, "application/http;msgtype=request", **concurrent)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    http = "application/http;msgtype=response"
    if revisit:
        yield _record("revisit", capture, uri, head, http, WARC_Profile=PROFILE, WARC_Payload_Digest=sha)
    else:
        yield _record("response", capture, uri, head + payload, http, WARC_Payload_Digest=sha)
    note = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    yield _record("metadata", str(uuid.uuid4()), uri, note, "application/warc-fields", **concurrent)


def write(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write archives of all `pages` (page_id, url, html); returns the manifest (file, records).

    Of payloads that are equal and have at least `revisit_bytes` bytes, the one with the largest page_id
    is a response and the others are revisits. Null html is an empty payload, a null url an absent
    target. A task that runs again writes other files; the manifest names those that count.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.length(payload).alias("bytes"))
    # The map side sums up each digest, so a payload of very many pages is one row per task.
    shared = (
        rows.where(F.col("bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "original")
    )
    marked = lookup_join(rows, materialise(shared, "payloads"), ["digest"], ["page_id"]).withColumn(
        "revisit",
        F.col("original").isNotNull() & (F.coalesce(F.col("page_id") < F.col("original"), F.lit(True))),
    )

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        out, name, records, size = None, "", 0, 0
        done = []
        for batch in columns:
            rows = zip(
                batch["page_id"].to_pylist(),
                texts(batch["url"]),
                texts(batch["html"]),
                batch["digest"].to_pylist(),
                batch["revisit"].to_pylist(),
            )
            for page_id, url, html, digest, revisit in rows:
                if out is None:
                    name, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = write_stream(name)
                for record in _records(page_id, url, html.encode(), digest, revisit):
                    out.write(gzip.compress(record, 4, mtime=0))
                    records, size = records + 1, size + len(record)
                if size >= ROLL_BYTES:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        yield {"file": pa.array([f for f, _ in done], pa.string()), "records": pa.array([n for _, n in done], pa.int64())}

    return materialise(
        arrow_map(marked.select("page_id", "url", "html", "digest", "revisit"), run, "file string, records long"),
        "manifest",
    )


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive; header names in lower case."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


def _bare(value: str | None) -> str | None:
    return value.strip("<>").removeprefix("urn:uuid:") if value else None


def _hex(digest: str | None) -> str | None:
    return base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None


def records(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Every record of the archives that the manifest names; `keep_payload` adds the payloads of responses."""

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        names = ("kind", "record_id", "concurrent_to", "uri", "date", "payload_digest", "payload_bytes", "fields")
        types = [pa.string()] * 6 + [pa.int64(), pa.string()]
        if keep_payload:
            names, types = (*names, "payload"), [*types, pa.binary()]
        for batch in columns:
            for file in batch["file"].to_pylist():
                rows = []
                with read_stream(file) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as stream:
                    for headers, block in parse(stream):
                        kind = headers.get("warc-type")
                        digest, size, payload = _hex(headers.get("warc-payload-digest")), None, None
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                        fields = block.decode("utf-8", "replace") if kind == "metadata" else None
                        row = (
                            kind,
                            _bare(headers.get("warc-record-id")),
                            _bare(headers.get("warc-concurrent-to")),
                            headers.get("warc-target-uri"),
                            headers.get("warc-date"),
                            digest,
                            size,
                            fields,
                        )
                        rows.append((*row, payload) if keep_payload else row)
                        if len(rows) >= ROWS_OUT:
                            yield {n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), types)}
                            rows = []
                if rows:
                    yield {n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), types)}

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(
        manifest.select("file").repartition(tasks), run, _RECORD + (", payload binary" if keep_payload else "")
    )


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, capture, request, metadata), null where a record is missing.

    Records meet by the identifier they name as concurrent-to; that of a response or revisit is its
    own. A capture has a few records, so no group is large, and a capture without a response or
    revisit keeps its row.
    """
    payload = [c for c in found.columns if c == "payload"]
    whole = F.struct("kind", "record_id", "uri", "date", "payload_digest", "payload_bytes", *payload)
    own = F.struct("record_id", "uri", "date")
    is_kind = F.col("kind").isin
    return (
        found.where(is_kind("request", "response", "revisit", "metadata"))
        .groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
        .agg(
            F.max(F.when(is_kind("response", "revisit"), whole)).alias("capture"),
            F.max(F.when(is_kind("request"), own)).alias("request"),
            F.max(F.when(is_kind("metadata"), F.struct("record_id", "fields"))).alias("metadata"),
        )
    )


def page_rows(assembled: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every capture; revisits resolved by digest."""
    rows = materialise(
        assembled.select(
            F.regexp_extract("metadata.fields", r"page-id: (-?\d+)", 1).try_cast("long").alias("page_id"),
            F.col("capture.payload_bytes").alias("own_bytes"),
            F.col("capture.payload_digest").alias("payload_digest"),
            F.col("capture.kind").alias("record_type"),
        ),
        "captures",
    )
    originals = (
        rows.where("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.max("own_bytes").alias("original_bytes"))
    )
    revisits = rows.where("record_type = 'revisit'")
    wanted = originals.join(revisits.select("payload_digest").distinct(), "payload_digest", "left_semi")
    solved = lookup_join(revisits, materialise(wanted, "originals"), ["payload_digest"], ["page_id"]).select(
        "page_id",
        F.col("original_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("original").alias("refers_to"),
    )
    plain = rows.where("record_type = 'response'").select(
        "page_id",
        F.col("own_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    return plain.unionByName(solved)
