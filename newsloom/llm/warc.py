"""WARC archives: written by Spark's text sink, read by a Python data source.

Writing is native: each page becomes one record, built by string functions and written by the
executors to any file system Spark knows.  Pages with equal payloads of at least
``MIN_REVISIT`` bytes become one response and revisits of it; only digests and ids are
shuffled to find them.

The reader plans one partition for each file and several small files together, takes filters
on record type and header columns, parses a record's headers first, and steps over payloads
that the filters or the ``content`` option leave out: ``none`` reads headers only, ``measure``
counts and digests payloads, ``bytes`` returns them.

Defined results: a null payload is empty; a null id or URL leaves its header out and reads
back as null; rows that repeat the smallest id of a payload are responses, all others are
revisits; line breaks in URLs are percent-encoded; long payloads are read whole, one at a time; empty
tables make an archive with no records.  In archives of others a record without an HTTP head is
all payload, a missing size of a revisit is null, and a length that is no number leaves that
record's payload out: the reader goes on at the next line that starts a record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from newsloom.llm import scratch

MIN_REVISIT = 100
#: Small files are read together up to so many bytes.
PARTITION_BYTES = 64 << 20
DATE = "2025-01-01T00:00:00Z"
_SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
_FIELDS = [x.split() for x in _SCHEMA.split(", ")]
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, records_per_file: int = 20_000, compression: str = "none", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """One record for every row of ``pages``: a response, or a revisit of an equal payload."""
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("bytes", F.octet_length("body"))
    equal = rows.where((F.col("bytes") >= MIN_REVISIT) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    equal = scratch.table(equal.where("first < last").select("digest", "first"), "equal-payloads")
    rows = rows.join(equal, "digest", "left").withColumn("again", (F.col("bytes") >= MIN_REVISIT) & F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first"))))
    rows = rows.withColumn("again", F.coalesce("again", F.lit(False)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("again"), http).otherwise(F.concat(http, F.col("body")))
    url = F.replace(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\0"), F.lit("%00"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response")), F.lit("\r\n"),
        _header("WARC-Record-ID", _urn(F.col("id"))), F.lit(f"WARC-Date: {DATE}\r\n"), _header("WARC-Target-URI", url),
        _header("WARC-Refers-To", F.when(F.col("again"), _urn(F.col("first")))),
        F.when(F.col("again"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"),
    )
    records = rows.withColumn("block", block).select(F.concat(head, F.col("block"), F.lit("\r\n")).alias("value"))
    records.write.option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _open(path: str) -> io.BufferedIOBase:
    system, at = pafs.FileSystem.from_uri(path)
    raw = open(at, "rb", buffering=1 << 20) if isinstance(system, pafs.LocalFileSystem) else io.BufferedReader(system.open_input_file(at), 1 << 20)
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


def _head(stream) -> dict[str, str] | None:
    """Version line and headers up to the empty line; None at the end of the file."""
    line = stream.readline()
    while line and not line.startswith(b"WARC/"):
        line = stream.readline()
    if not line:
        return None
    out: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _length(value: str | bytes | None) -> int | None:
    """A length as headers write it; None if it is missing or no number."""
    try:
        return max(0, int(value)) if value is not None else None
    except ValueError:
        return None


def _unwrap(urn: str | None) -> str | None:
    return urn[1:-1].removeprefix("urn:page:") if urn else None


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.content = options["path"], options.get("content", "measure")
        self.filters: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what headers decide; the rest goes back to Spark."""
        headers = {"record_type", "record_id", "target_uri", "refers_to"}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in headers:
                self.filters.append((f.attribute[0], (f.value,) if isinstance(f, EqualTo) else tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, at = pafs.FileSystem.from_uri(self.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else "file://"
        host = self.path.split("://")[1].split("/")[0] if "://" in self.path else ""
        found = system.get_file_info(pafs.FileSelector(at, recursive=True))
        out, size = [], 0
        for f in sorted((f for f in found if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path):
            if not out or size + f.size > PARTITION_BYTES:
                out.append([])
                size = 0
            out[-1].append(f"{scheme}{host}/{f.path.lstrip('/')}" if not host else f"{scheme}{f.path}")
            size += f.size
        return [_Files(x) for x in out] or [_Files([])]

    def _records(self, path: str) -> Iterator[tuple]:
        with _open(path) as stream:
            while (head := _head(stream)) is not None:
                length = _length(head.get("content-length")) or 0
                row = {"record_type": head.get("warc-type"), "record_id": _unwrap(head.get("warc-record-id")), "target_uri": head.get("warc-target-uri"), "refers_to": _unwrap(head.get("warc-refers-to"))}
                if self.content == "none" or any(row[c] not in values for c, values in self.filters):
                    stream.seek(length, io.SEEK_CUR)  # the payload isn't read
                    if all(row[c] in values for c, values in self.filters):
                        yield (*row.values(), head.get("warc-payload-digest", "").removeprefix("sha256:") or None, None, None)
                    continue
                block = stream.read(length)
                http = block.startswith((b"HTTP/", b"GET ", b"POST ")) or "application/http" in head.get("content-type", "")
                cut = block.find(b"\r\n\r\n") + 4 if http and b"\r\n\r\n" in block else 0
                if row["record_type"] == "revisit":  # its block is the HTTP head of the payload it stands for
                    sizes = [x.partition(b":")[2] for x in block[:cut].split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    yield (*row.values(), head.get("warc-payload-digest", "").removeprefix("sha256:") or None, _length(sizes[0]) if sizes else None, None)
                else:
                    payload = memoryview(block)[cut:]
                    yield (*row.values(), hashlib.sha256(payload).hexdigest(), len(payload), bytes(payload) if self.content == "bytes" else None)

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for path in partition.paths:
            for row in self._records(path):
                rows.append(row)
                held += len(row[-1] or b"")
                if len(rows) >= 4096 or held >= 8 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [n for n, _ in _FIELDS])


class WarcSource(DataSource):
    """``spark.read.format("warc").option("content", "none|measure|bytes").load(path)``"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_archive(spark: SparkSession, path: str, content: str = "measure") -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("content", content).load(path)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    out = read_archive(spark, path)
    return out.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN f.first < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""
