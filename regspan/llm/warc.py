"""WARC archives: written by Spark's text writer, read back record by record, assembled per capture."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import keep

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END_OF_RECORD = CRLF + CRLF
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"


def base32(hexadecimal: Column) -> Column:
    """Base 32 of 20 bytes given in hexadecimal: every 5 digits make 4 letters."""
    five = lambda i: F.conv(F.substring(hexadecimal, i * 5 + 1, 5), 16, 10).cast("int")
    letter = lambda v, bits: F.substring(F.lit(BASE32), F.shiftright(v, bits).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*[letter(five(F.lit(i)), bits) for i in range(8) for bits in (15, 10, 5, 0)])


def _line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null. Line ends cannot be part of a value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(CRLF)), F.lit(""))


def _record(kind: Column | str, id: Column, content: Column, content_type: str, *lines: Column) -> Column:
    """A record without its final two line ends, which the writer adds."""
    return F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.lit(kind) if isinstance(kind, str) else kind),
        _line("WARC-Record-ID", F.concat(F.lit("<"), id, F.lit(">"))),
        *lines,
        _line("Content-Type", F.lit(content_type)),
        _line("Content-Length", F.octet_length(content).cast("string")),
        F.lit(CRLF),
        content,
    )


def _urn(id: Column, sha: Column, part: str) -> Column:
    """The name of a record: page id (empty if null), payload digest and kind."""
    return F.concat(F.lit("urn:capture:"), F.coalesce(F.url_encode(id), F.lit("")), F.lit(":"), sha, F.lit(f":{part}"))


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
    date: str = DATE, least_bytes: int = REVISIT_BYTES,
) -> None:
    """Write request, response (or revisit) and metadata records of every page below ``path``.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the least id is
    the response and the others are revisits without a payload that refer to it. A null payload is
    empty, a null url leaves out the target. Rows that repeat the least id with its payload are all
    responses, and so are equal payloads none of which has an id; ids come before nulls. The
    payload is the text as UTF-8. An empty table gives archives without records.

    One shuffle by payload digest: first occurrences are found by an aggregate that a hot payload
    does not burden, and joined back, where Spark splits a skewed digest. The files are gzip
    streams of uncompressed WARC, committed by Spark's own writer, so lost tasks leave no trace.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id).alias("_id"),
        F.col(url).cast("string").alias("_url"),
        payload.alias("_payload"),
    )
    rows = rows.withColumns(
        {"_digest": F.sha1(F.col("_payload").cast("binary")), "_bytes": F.octet_length("_payload").cast("long")}
    )
    order = F.struct(F.col("_id").isNull().alias("_none"), F.col("_id").alias("_id"))
    first = (
        rows.where(F.col("_bytes") >= least_bytes)
        .groupBy("_digest")
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_first")
    )
    joined = rows.join(first, "_digest", "left")
    keyed = joined.withColumns(
        {
            "_name": F.col("_id").cast("string"),
            "_revisit": F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first._id")),
            "_refers": F.col("_first._id").cast("string"),
            "_sha": base32(F.col("_digest")),
            "_site": F.coalesce(F.regexp_extract("_url", r"^[^:/?#]+://([^/?#]*)", 1), F.lit("")),
            "_path": F.coalesce(F.regexp_extract("_url", r"^[^:/?#]+://[^/?#]*([^#]*)", 1), F.lit("")),
        }
    )
    named = lambda part: _urn(F.col("_name"), F.col("_sha"), part)
    link = lambda urn: F.concat(F.lit("<"), urn, F.lit(">"))
    target, when = _line("WARC-Target-URI", F.col("_url")), _line("WARC-Date", F.lit(date))
    sha = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha")))
    concurrent = _line("WARC-Concurrent-To", link(named("response")))
    get = F.concat(
        F.lit("GET "), F.when(F.col("_path") == "", "/").otherwise(F.regexp_replace("_path", r"\s", "%20")),
        F.lit(" HTTP/1.1" + CRLF), _line("Host", F.col("_site")), F.lit(CRLF),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF), _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.col("_bytes").cast("string")), F.lit(CRLF),
    )
    request = _record("request", named("request"), get, "application/http; msgtype=request", target, when, concurrent)
    response = F.when(
        F.col("_revisit"),
        _record(
            "revisit", named("response"), head, "application/http; msgtype=response", target, when, sha,
            _line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _line("WARC-Refers-To", link(_urn(F.col("_refers"), F.col("_sha"), "response"))),
        ),
    ).otherwise(
        _record(
            "response", named("response"), F.concat(head, F.col("_payload")),
            "application/http; msgtype=response", target, when, sha,
        )
    )
    facts = F.concat(_line("payloadLength", F.col("_bytes").cast("string")), _line("captureId", F.col("_name")))
    metadata = _record("metadata", named("metadata"), facts, "application/warc-fields", target, when, concurrent)
    records = keyed.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", END_OF_RECORD).option("compression", "gzip").text(path)


_FIELDS = [
    ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("digest", pa.string()), ("http", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ("fields", pa.map_(pa.string(), pa.string())),
]
_SCHEMA = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "digest string, http string, payload_bytes long, payload_digest string, payload binary, "
    "fields map<string,string>"
)


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    return out


def _parsed(head: list[bytes], block: bytes, payloads: bool) -> tuple:
    names = _headers(head[1:])
    kind = names.get("warc-type", "")
    http, payload, fields = None, b"", {}
    if names.get("content-type", "").startswith("application/http"):
        before, _, payload = block.partition(b"\r\n\r\n")
        http = before.decode("utf-8", "replace")
    elif names.get("content-type", "") == "application/warc-fields":
        fields = _headers(block.split(b"\r\n"))
    else:
        payload = block
    own = kind in ("response", "resource", "conversion")
    bare = lambda n: names[n].strip("<>") if n in names else None
    stated = names.get("warc-payload-digest")
    return (
        bare("warc-record-id"), kind, bare("warc-concurrent-to"), bare("warc-refers-to"),
        names.get("warc-target-uri"), names.get("warc-date"), stated.partition(":")[2] if stated else None, http,
        len(payload) if own else None,
        base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else None,
        payload if own and payloads else None, list(fields.items()),
    )


class _Reader:
    """Records from the lines of one archive, cut at CRLF; a record ends by its stated length."""

    def __init__(self) -> None:
        self.head: list[bytes] = []
        self.block: list[bytes] = []
        self.missing: int | None = None  # bytes of the block still to come

    def feed(self, line: bytes) -> tuple[list[bytes], bytes] | None:
        if self.missing is None:
            if line:
                self.head.append(line)
                return None
            if not self.head:
                return None  # the empty lines after a record
            if not self.head[0].startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {self.head[0][:60]!r}")
            self.missing = int(_headers(self.head[1:])["content-length"])
            self.block = []
            return self._done() if self.missing == 0 else None
        self.block.append(line)
        self.missing -= len(line)
        if self.missing > 0:
            self.missing -= 2  # the line end belongs to the block
            self.block.append(b"\r\n")
        return self._done() if self.missing <= 0 else None

    def _done(self) -> tuple[list[bytes], bytes]:
        if self.missing < 0:
            raise ValueError("a record is longer than stated")
        found = self.head, b"".join(self.block)
        self.head, self.block, self.missing = [], [], None
        return found


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    reader, name, rows, size = _Reader(), None, [], 0

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
        arrays = [pa.array(list(c), kind) for c, (_, kind) in zip(columns, _FIELDS)]
        return pa.RecordBatch.from_arrays(arrays, [n for n, _ in _FIELDS])

    for found in batches:
        for line, file in zip(found.column("line").to_pylist(), found.column("file").to_pylist()):
            if file != name:
                if reader.head:
                    raise ValueError(f"{name} ends within a record")
                reader, name = _Reader(), file
            record = reader.feed(line)
            if record:
                rows.append(_parsed(*record, payloads))
                size += len(record[1]) if payloads else 200
                if size > 4 << 20:
                    yield batch()
                    rows, size = [], 0
    if reader.head:
        raise ValueError(f"{name} ends within a record")
    yield batch()


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the gzip archives below ``path``.

    Spark's text reader streams each archive as lines cut at CRLF; a record's stated length says which
    lines are its block, so a payload may hold anything, and a task holds one record at a
    time. Lengths and digests are taken from the payload itself; ``digest`` is the stated one.
    """
    lines = spark.read.option("lineSep", CRLF).text(path)
    lines = lines.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(lambda it: _read(it, payloads), _SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` with its ``request`` and array of ``metadata``.

    A capture is a response, revisit or resource record. Requests and metadata are joined by the
    record they are concurrent to; metadata concurrent to a request belongs to that request's
    capture. Records concurrent to nothing known are left out; of several requests the one with
    the least id counts. The records are written once, so that archives are read only once.
    """
    records = keep(records, "records")
    part = lambda *kinds: records.where(F.col("type").isin(*kinds))
    main = part("response", "revisit", "resource").select(
        F.col("record_id").alias("_key"),
        F.struct(
            "record_id", "type", "refers_to", "target_uri", "date", "digest", "http", "payload_bytes",
            "payload_digest", "payload",
        ).alias("response"),
    )
    requests = part("request").where("concurrent_to IS NOT NULL")
    asked = requests.groupBy(F.col("concurrent_to").alias("_key")).agg(
        F.min_by(F.struct("record_id", "target_uri", "http"), "record_id").alias("request")
    )
    through = requests.select(F.col("record_id").alias("concurrent_to"), F.col("concurrent_to").alias("_to"))
    notes = part("metadata").where("concurrent_to IS NOT NULL").join(through, "concurrent_to", "left")
    notes = notes.groupBy(F.coalesce("_to", "concurrent_to").alias("_key")).agg(
        F.sort_array(F.collect_set(F.struct("record_id", F.map_entries("fields").alias("fields")))).alias("metadata")
    )
    plain = F.transform(
        "metadata",
        lambda m: F.struct(m["record_id"].alias("record_id"), F.map_from_entries(m["fields"]).alias("fields")),
    )
    notes = notes.withColumn("metadata", plain)
    return main.join(asked, "_key", "left").join(notes, "_key", "left").drop("_key")
