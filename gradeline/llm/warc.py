"""WARC archives: written by Spark's text sink, read by a Python data source.

The reader plans partitions from the files, parses the headers of a record first, applies the pushed
predicates to them, and seeks past the payload of a record that fails or whose payload is not wanted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringContains, StringStartsWith,
)

from gradeline.llm.common import read
from gradeline.sources.stage import new_dir, stage

CRLF = "\r\n"
REVISIT_FROM = 1000
PARTITION_BYTES = 128 << 20
STEP = 1 << 20
#: Column and the header it comes from; predicates on these columns are pushed down.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "date": "warc-date", "refers_to": "warc-refers-to", "content_type": "content-type",
}
SCHEMA = pa.schema(
    [(name, pa.string()) for name in HEADERS]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
       ("file", pa.string()), ("offset", pa.int64())]
)
DDL = ", ".join(f"{n} string" for n in HEADERS) + ", payload_bytes long, payload_digest string, payload binary, file string, offset long"


# --- writing ---------------------------------------------------------------------------------------


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null. Line breaks in a value cannot start another header."""
    clean = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def page_records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages with record_type and refers_to (page_id of the response), payload never null.

    Payloads are equal when length and SHA-256 are. Of equal ones of at least ``revisit_from`` bytes, the
    rows with the largest page_id are responses and the others revisit it. A null page_id is below every
    other; a group without any page_id consists of responses.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload).alias("digest"), F.sha2(payload, 256).alias("same"),
    )
    groups = (
        rows.filter(F.col("bytes") >= revisit_from).groupBy("same")
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("b"))
        .filter("n > 1").select(F.col("same").alias("s"), "b", "keep")
    )
    # Only repeated payloads are listed; where the list is short, Spark broadcasts it and no page moves.
    groups = stage(groups, "payloads")
    joined = rows.join(groups, (F.col("same") == F.col("s")) & (F.col("bytes") == F.col("b")), "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return joined.select(
        "page_id", "url", "payload", "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keep")).alias("refers_to"),
    )


def record_text(date: str = "1970-01-01T00:00:00Z") -> Column:
    """One record as text, for rows of ``page_records``; a revisit has headers and no payload."""
    revisit = F.col("record_type") == "revisit"
    unnamed = F.concat(F.lit("<urn:payload:"), F.col("digest"), F.lit(">"))
    named = lambda i: F.concat(F.lit("<urn:page:"), i.cast("string"), F.lit(">"))
    body = F.when(revisit, "").otherwise(F.col("payload"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.coalesce(named(F.col("page_id")), unnamed)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", named(F.col("refers_to"))),
        _header("WARC-Profile", F.when(revisit, profile)),
        _header("X-Payload-Length", F.col("bytes").cast("string")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF),
        body,
    )


def write_warc(pages: DataFrame, path: str, records_per_file: int = 50_000, compression: str = "none") -> None:
    """Write a record per page. Spark's committer keeps one copy of each task's files."""
    (
        page_records(pages).select(record_text().alias("value"))
        .write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", records_per_file)
        .option("compression", compression).text(path)
    )


# --- reading ---------------------------------------------------------------------------------------


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)


def _headers(stream) -> dict[str, str] | None:
    """The headers of the next record, names in lower case; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    found, last = {}, ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and last:
            found[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            found[last] = value.strip()
    return found


def _hex(digest: str | None) -> str | None:
    """Bare lower-case hexadecimal of a labelled digest in hexadecimal or Base32."""
    if digest is None:
        return None
    value = digest.rpartition(":")[2]
    if re.fullmatch("[A-Z2-7]{32}", value):
        return base64.b32decode(value).hex()
    return value.lower()


def _test(kind: str, found: str | None, value) -> bool:
    if found is None:
        return False
    return {
        "eq": lambda: found == value, "in": lambda: found in value, "has": lambda: True,
        "starts": lambda: found.startswith(value), "contains": lambda: value in found,
    }[kind]()


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.mode = options.get("payload", "bytes")
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = {EqualTo: "eq", In: "in", IsNotNull: "has", StringStartsWith: "starts", StringContains: "contains"}
        for f in filters:
            kind, column = kinds.get(type(f)), ".".join(getattr(f, "attribute", ()))
            if kind and column in HEADERS:
                self.tests.append((kind, HEADERS[column], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Whole files, small ones together: a record may look like a payload, so files are not cut."""
        system, root = _open(self.path)
        files = [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file]
        bins, room = [], 0
        for f in sorted(files, key=lambda f: f.path):
            if f.base_name.startswith(("_", ".")):
                continue
            if not bins or room + f.size > self.partition_bytes:
                bins.append([])
                room = 0
            bins[-1].append(f.path)
            room += f.size
        return [_Files(b) for b in bins] or [_Files([])]

    def read(self, partition):
        system, _ = _open(self.path)
        rows, held = [], 0
        for path in partition.value:
            raw = io.BufferedReader(system.open_input_file(path), STEP)
            with gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw as stream:
                while True:
                    offset = stream.tell()
                    found = _headers(stream)
                    if found is None:
                        break
                    length = int(found.get("content-length", 0))
                    end = stream.tell() + length
                    if all(_test(kind, found.get(name), value) for kind, name, value in self.tests):
                        row = [found.get(h) for h in HEADERS.values()] + self._payload(stream, found, length) + [path, offset]
                        rows.append(row)
                        held += len(row[-3] or b"") + 500
                    stream.seek(end)
                    if held > 4 * STEP:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _payload(self, stream, found, length: int) -> list:
        """Length, digest and bytes of the payload; from the headers where it is absent or not wanted."""
        digest = _hex(found.get("warc-payload-digest"))
        if self.mode == "none" or found.get("warc-type") == "revisit":
            return [int(found.get("x-payload-length", length)), digest, None]
        sha, parts, left = hashlib.sha1(), [], length
        while left:
            part = stream.read(min(STEP, left))
            if not part:
                raise ValueError("a record ends early")
            sha.update(part)
            left -= len(part)
            if self.mode == "bytes":
                parts.append(part)
        if digest is not None and len(digest) == 40 and digest != sha.hexdigest():
            raise ValueError(f"a payload does not have its digest {digest}")
        return [length, sha.hexdigest(), b"".join(parts) if self.mode == "bytes" else None]


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


class WarcSource(DataSource):
    """Options: path; payload = ``bytes`` (default), ``digest`` (read and checked, not returned) or ``none``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return DDL

    def reader(self, schema):
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: str = "bytes") -> DataFrame:
    """Records of all archives below ``path``. An archive that is cut or has a wrong digest raises."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).load(path)


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read them back: payloads of responses, only headers of revisits."""
    path = new_dir(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    parts = [
        read_warc(spark, path, mode).filter(F.col("record_type") == kind)
        for kind, mode in (("response", "digest"), ("revisit", "none"))
    ]
    return parts[0].union(parts[1]).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
