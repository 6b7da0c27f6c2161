"""WARC archives: writer with revisit records, and a salvage reader.

Writing: Spark's text sink writes one record a row, its bytes as they are,
with CRLF CRLF as the separator that ends every record. Spark's commit
protocol thus covers lost executors, and any Hadoop file system works.

Reading: each file is one task's row. A record must have a version line, a
header block, a whole body with the closing CRLF CRLF, and matching digests
where it names them; a gzip member must inflate and pass its own checks. After
a failure the reader searches for the next version line or member that starts
a valid record, goes on from there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import read_table, saved
from sparkcast.session import scratch_dir

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Shorter payloads are always stored.
MIN_REVISIT = 100
RECORDS_PER_FILE = 2000

_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_STEP = 1 << 16


@dataclass
class Found:
    """A record, or a gap of bytes that belong to none."""

    start: int
    end: int
    reason: str | None = None  # of a gap
    headers: dict[str, str] | None = None
    body: bytes | None = None


class _Bad(Exception):
    pass


def _check_digest(named: str | None, body, what: str) -> None:
    if not named or ":" not in named:
        return
    kind, value = named.split(":", 1)
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("sha256", "sha1", "md5", "sha512"):
        return
    h = hashlib.new(kind, body)
    value = value.strip()
    if value.lower() != h.hexdigest() and value.upper().rstrip("=") != base64.b32encode(
        h.digest()
    ).decode().rstrip("="):
        raise _Bad(f"{what} digest")


def _record(buf, at: int) -> Found:
    """The plain record at ``at``."""
    if not _VERSION.match(buf, at):
        raise _Bad("no version line")
    top = buf.find(b"\r\n\r\n", at)
    if top < 0:
        raise _Bad("unfinished header")
    headers: dict[str, str] = {}
    last = None
    for line in buf[at:top].split(b"\r\n")[1:]:
        if line[:1] in b" \t" and last:
            headers[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Bad("header line")
        last = name.strip().decode("utf-8", "replace").lower()
        headers[last] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise _Bad("content length")
    start = top + 4
    end = start + int(length)
    if buf[end : end + 4] != b"\r\n\r\n":
        raise _Bad("record end")
    body = buf[start:end]
    _check_digest(headers.get("warc-block-digest"), body, "block")
    if headers.get("warc-type") != "revisit" and not headers.get("content-type", "").startswith(
        "application/http"
    ):
        _check_digest(headers.get("warc-payload-digest"), body, "payload")
    return Found(at, end + 4, headers=headers, body=body)


def _inflate(buf, at: int) -> tuple[bytes, int]:
    d, out, pos = zlib.decompressobj(31), [], at
    try:
        while not d.eof and pos < len(buf):
            out.append(d.decompress(buf[pos : pos + _STEP]))
            pos += _STEP
    except zlib.error:
        raise _Bad("gzip member") from None
    if not d.eof:
        raise _Bad("unfinished gzip member")
    return b"".join(out), min(pos, len(buf)) - len(d.unused_data)


def _member(buf, at: int) -> list[Found]:
    """Records of the gzip member at ``at``; offsets are the member's."""
    inner, end = _inflate(buf, at)
    found = list(salvage(inner, members=False))
    if not any(f.reason is None for f in found):
        raise _Bad("no record in gzip member")
    return [Found(at, end, f.reason and f"{f.reason} in gzip member", f.headers, f.body) for f in found]


def salvage(buf: bytes, members: bool = True) -> Iterator[Found]:
    """Every valid record of a file's bytes and the gaps between, in order."""
    pos, gap, why = 0, None, ""
    while pos < len(buf):
        try:
            if members and buf[pos : pos + 3] == b"\x1f\x8b\x08":
                found = _member(buf, pos)
            else:
                found = [_record(buf, pos)]
        except _Bad as e:
            if gap is None:
                gap, why = pos, str(e)
            at = _START.search(buf, pos + 1)
            pos = at.start() if at else len(buf)
            continue
        if gap is not None:
            yield Found(gap, pos, reason=why)
            gap = None
        yield from found
        pos = found[-1].end
    if gap is not None:
        yield Found(gap, len(buf), reason=why)


_SCHEMA = (
    "path string, start long, end long, gap string, headers map<string,string>, body binary"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("gap", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("body", pa.binary()),
    ]
)


def _read(batches):
    def out(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW
        )

    for b in batches:
        for path, content in zip(b.column(0), b.column(1)):
            rows, held = [], 0
            for f in salvage(content.as_py() or b""):
                rows.append(
                    (path.as_py(), f.start, f.end, f.reason, list((f.headers or {}).items()), f.body)
                )
                held += len(f.body or b"")
                if held > 4 << 20:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all files under ``path``: plain or gzip members.

    ``gap`` is NULL for a record, else why its bytes were put aside; header
    names are lower case. A file is read whole by one task, so files should be
    of the usual size (a GB at most). An empty file has no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, _SCHEMA)


def records(read: DataFrame) -> DataFrame:
    return read.where("gap is null").drop("gap")


def quarantine(read: DataFrame) -> DataFrame:
    """The log of byte gaps: path, start, end, reason."""
    return read.where("gap is not null").select("path", "start", "end", F.col("gap").alias("reason"))


def _uri(c):
    """A header value on one line: control characters and space percent-encoded."""
    for code in (0x25, 0x20, 0x0D, 0x0A, 0x09):
        if code == 0x25:
            c = F.when(c.rlike(r"[\x00-\x20\x7F]"), F.replace(c, F.lit("%"), F.lit("%25"))).otherwise(c)
        else:
            c = F.replace(c, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.regexp_replace(c, r"[\x00-\x1F\x7F]", "%00")


def with_records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """One WARC record a page, without its closing CRLF CRLF: column ``record``.

    Of pages with equal payloads of at least ``min_revisit`` bytes the least
    id is the response and the others refer to it. NULL payloads are empty, a
    NULL url has no target line, a NULL id is the empty string and revisits
    any page that has an id. Rows that repeat the response's id are responses
    too. An empty table gives an empty table. Other columns are not read.
    """
    base = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumns(
        {
            "digest": F.sha2(F.col("payload").cast("binary"), 256),
            "bytes": F.octet_length("payload").cast("long"),
        }
    )
    # Written, so that Spark knows the size of the shared payloads before it
    # chooses between a broadcast and a join that splits a skewed digest.
    shared = saved(
        base.where(F.col("bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "warc-shared",
    )
    rows = base.join(shared, "digest", "left").withColumn(
        "refers", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    )
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    revisit = F.col("refers").isNotNull()
    empty = hashlib.sha256(b"").hexdigest()
    head = [
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", _uri(F.col("url"))), F.lit("")),
        line("WARC-Date", F.lit(date)),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", name(F.col("refers"))), line("WARC-Profile", F.lit(PROFILE))),
        ).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.lit(empty)).otherwise(F.col("digest")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    ]
    return rows.select(F.col("id").alias(id_col), F.concat(*head).alias("record"))


def write_warc(recs: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the ``record`` column as plain WARC files of bounded record counts."""
    (
        recs.select("record")
        .write.option("lineSep", CRLF * 2)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def page_rows(recs: DataFrame, id_type: str = "long") -> DataFrame:
    """The pages behind records that ``with_records`` wrote."""
    id_of = lambda h: F.nullif(F.regexp_extract(F.col("headers")[h], "<urn:page:(.*)>", 1), F.lit("")).cast(id_type)
    kind = F.col("headers")["warc-type"]
    stored = kind == "response"
    return recs.select(
        id_of("warc-record-id").alias("page_id"),
        F.when(stored, F.length("body").cast("long"))
        .otherwise(F.col("headers")["warc-payload-length"].cast("long"))
        .alias("payload_bytes"),
        F.when(stored, F.sha2("body", 256))
        .otherwise(F.substring_index(F.col("headers")["warc-payload-digest"], ":", -1))
        .alias("payload_digest"),
        kind.alias("record_type"),
        id_of("warc-refers-to").alias("refers_to"),
    )


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


@register("op2_warc_salvage", SQL)
def op2_warc_salvage(spark, sf_dir):
    path = scratch_dir(spark, "warc")
    write_warc(with_records(read_table(spark, sf_dir, "pages")), path)
    return page_rows(records(read_warc(spark, path)))
