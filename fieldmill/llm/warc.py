"""Legacy ARC archives to WARC, and reading both.

An ARC file opens with a version block that names the fields of its header lines: version 1 has five
(URL, IP, date, type, length), version 2 ten.  Every record is such a line and as many bytes as its
last field declares.  The converter makes a WARC record of each: an identifier derived from place and
content, the date in the WARC form, the type from the content (an HTTP message is a response, anything
else a resource), and digests of block and payload.

Files are written by Spark's text writer (whole-file gzip) and read with its binary reader, so any
store that Spark reaches will do.  A file is read by one task; ``FILE_BYTES`` bounds its size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.llm.tables import cut

#: bytes of payload in one archive file; a longer record makes its file longer
FILE_BYTES = 16 << 20
#: payloads of fewer bytes are stored each time
MIN_REVISIT_BYTES = 1000
#: up to so many repeated payloads are broadcast (under 100 bytes each)
MAX_BROADCAST_ROWS = 200_000
UNKNOWN_IP, UNKNOWN_DATE = "0.0.0.0", "19700101000000"
#: header of the HTTP message that carries the row's id through an archive
ID_HEADER = "X-Page-Id"
#: field names of the two ARC versions (fixed values)
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    " Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FAST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _write(records: DataFrame, path: str) -> None:
    """Write a binary column, each value followed by a line feed."""
    records.select(F.col("record").cast("string")).write.options(**_FAST).text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)


def _unpacked(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out += [member.decompress(content), member.flush()]
        content = member.unused_data
    return b"".join(out)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about 4 MB of binary content."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > 4 << 20:
            yield _batch(held, names, kinds)
            held, size = [], 0
    yield _batch(held, names, kinds)


def _batch(rows, names, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


# --- ARC -------------------------------------------------------------------------------------------


def write_arc(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as HTTP captures, ARC version 1 and 2 by turns."""
    pages = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce("html", F.lit("")).cast("string").cast("binary").alias("html"),
    )
    total = pages.agg(F.sum(F.length("html") + 200)).first()[0] or 0

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"pages-{part:06d}.arc"
        head = f"{version} 0 fieldmill\n{ARC_FIELDS[version]}\n"
        unknown = f"{UNKNOWN_IP} {UNKNOWN_DATE}"
        middle = "" if version == 1 else " 200 - - 0 " + name
        first = f"filedesc://{name} {unknown} text/plain{middle} {len(head)}\n{head}".encode()
        at = len(first) + 1

        def rows():
            nonlocal at
            yield (first,)
            for batch in batches:
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    mark = "" if page_id is None else f"{ID_HEADER}: {page_id}\r\n"
                    http = (
                        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"{mark}Content-Length: {len(html)}\r\n\r\n"
                    ).encode()
                    url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url or "unknown:")
                    extra = "" if version == 1 else f" 200 - - {at} {name}"
                    size = len(http) + len(html)
                    line = f"{url} {unknown} text/html{extra} {size}\n"
                    record = line.encode("utf-8", "surrogatepass") + http + html
                    at += len(record) + 1
                    yield (record,)

        yield from _batches(rows(), ["record"], [pa.binary()])

    files = max(1, -(-total // FILE_BYTES))
    _write(pages.repartition(files).mapInArrow(run, "record binary"), path)


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of an ARC file after its version block.

    A line that is no header of the file's version is skipped; a record that breaks off is given as
    far as it goes.
    """
    names = ARC_FIELDS[1].split()
    at = 0
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].rstrip(b"\r")
        if end < 0:
            return
        start, text = at, line.decode("utf-8", "replace")
        if text.startswith("filedesc:"):
            size = text.rsplit(" ", 1)[-1]
            block = data[end + 1 : end + 1 + (int(size) if size.isdigit() else 0)]
            lines = block.decode("utf-8", "replace").split("\n")
            version = int(lines[0].split(" ")[0]) if lines[0][:1].isdigit() else 1
            declared = lines[1].split() if len(lines) > 1 else []
            names = declared if len(declared) >= 5 else ARC_FIELDS.get(version, ARC_FIELDS[1]).split()
            at = end + 1 + len(block)
            continue
        fields = text.rsplit(" ", len(names) - 1)
        at = end + 1
        if len(fields) != len(names) or not fields[-1].isdigit():
            continue
        record = dict(zip(names, fields, strict=True))
        size = int(fields[-1])
        yield record | {"offset": start, "block": data[at : at + size]}
        at += size


def _http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with its empty line) and payload of an HTTP message."""
    if not block.startswith(b"HTTP/"):
        return None
    found = re.search(rb"\r?\n\r?\n", block)
    return (block[: found.end()], block[found.end() :]) if found else (block, b"")


def _warc_date(date: str) -> str:
    digits = re.sub(r"\D", "", date)[:14]
    d = digits + UNKNOWN_DATE[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


RECORDS = (
    "record_id string, type string, uri string, ip string, date string, content_type string,"
    " page_id long, payload_bytes long, payload_digest string, head binary, payload binary"
)
_RECORD_KINDS = [pa.string()] * 6 + [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]


def convert(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files under ``path`` with what WARC records of them need.

    ``payload_digest`` is the SHA-1 in hex; ``head`` holds the HTTP head of a response.
    """

    def rows(batches):
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for r in arc_records(_unpacked(content)):
                    parts = _http_parts(r["block"])
                    head, payload = parts or (b"", r["block"])
                    digest = hashlib.sha1(payload).hexdigest()
                    key = f"{name} {r['offset']} {r['URL']} {r['Archive-date']} {digest}"
                    own = re.search(rb"(?im)^%s:\s*(-?\d+)" % ID_HEADER.encode(), head)
                    yield (
                        f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}",
                        "response" if parts else "resource",
                        r["URL"],
                        r["IP-address"],
                        _warc_date(r["Archive-date"]),
                        "application/http; msgtype=response" if parts else r["Content-type"],
                        int(own[1]) if own else None,
                        len(payload),
                        digest,
                        head,
                        payload,
                    )

    def run(batches):
        names = [part.split()[0] for part in RECORDS.split(", ")]
        yield from _batches(rows(batches), names, _RECORD_KINDS)

    return _contents(spark, path).select("path", "content").mapInArrow(run, RECORDS)


# --- WARC ------------------------------------------------------------------------------------------


def _repeats(records: DataFrame, rank: Column) -> DataFrame:
    """(payload_digest, refers_to, refers_to_uri, refers_to_date) of payloads that occur again; the
    record of the greatest ``rank`` (then record_id) is the one referred to."""
    first = F.max(F.struct(rank.alias("rank"), "record_id", "uri", "date")).alias("first")
    return (
        records.where((F.col("payload_bytes") >= MIN_REVISIT_BYTES) & (F.col("type") == "response"))
        .groupBy("payload_digest")
        .agg(first, F.count("*").alias("n"))
        .where("n > 1")
        .select(
            "payload_digest",
            F.col("first.record_id").alias("refers_to"),
            F.col("first.uri").alias("refers_to_uri"),
            F.col("first.date").alias("refers_to_date"),
        )
    )


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _warc_text(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    named = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    head = f"WARC/1.0\r\n{named}Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r"  # the writer ends the line


def write_warc(records: DataFrame, path: str, rank: Column | None = None) -> None:
    """Write ``records`` (as ``convert`` gives them) as WARC files.

    Of responses with the same payload of at least 1,000 bytes the one of greatest ``rank`` (the page
    id by default) is written in full, the others as revisits of it with their HTTP head only.
    """
    repeats = cut(_repeats(records, F.col("page_id") if rank is None else rank))
    if repeats.count() <= MAX_BROADCAST_ROWS:
        repeats = F.broadcast(repeats)  # else payloads have to be shuffled
    joined = records.join(repeats, "payload_digest", "left").select(
        *[part.split()[0] for part in RECORDS.split(", ")],
        *(F.when(F.col("refers_to") != F.col("record_id"), F.col(c)).alias(c)
          for c in ("refers_to", "refers_to_uri", "refers_to_date")),
    )

    def rows(batches):
        info = b"software: fieldmill\r\nformat: WARC File Format 1.0\r\n"
        yield (_warc_text([
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'fieldmill')}>"),
            ("WARC-Date", _warc_date(UNKNOWN_DATE)),
            ("Content-Type", "application/warc-fields"),
        ], info),)
        for batch in batches:
            for r in batch.to_pylist():
                again = r["refers_to"] is not None
                repeat_of = f"<{r['refers_to']}>" if again else None
                block = r["head"] + (b"" if again else r["payload"])
                fields = [
                    ("WARC-Type", "revisit" if again else r["type"]),
                    ("WARC-Record-ID", f"<{r['record_id']}>"),
                    ("WARC-Date", r["date"]),
                    ("WARC-Target-URI", r["uri"]),
                    ("WARC-IP-Address", r["ip"]),
                    ("WARC-Payload-Digest", _base32(r["payload_digest"])),
                    ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
                    ("WARC-Profile", REVISIT_PROFILE if again else None),
                    ("WARC-Refers-To", repeat_of),
                    ("WARC-Refers-To-Target-URI", r["refers_to_uri"]),
                    ("WARC-Refers-To-Date", r["refers_to_date"]),
                    ("Content-Type", r["content_type"]),
                ]
                yield (_warc_text(fields, block),)

    def run(batches):
        yield from _batches(rows(batches), ["record"], [pa.binary()])

    _write(joined.mapInArrow(run, "record binary"), path)


def warc_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(named fields, block) of each record of a WARC file; reading ends where a record breaks off."""
    at = 0
    while data.startswith(b"WARC/", at):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = fields.get("content-length", "")
        if not size.isdigit():
            return
        at = end + 4 + int(size) + 4
        yield fields, data[end + 4 : at - 4]


ARCHIVED = (
    "record_id string, record_type string, uri string, date string, page_id long,"
    " payload_bytes long, payload_digest string, refers_to_id string"
)
_ARCHIVED_KINDS = [pa.string()] * 4 + [pa.int64(), pa.int64(), pa.string(), pa.string()]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response, resource or revisit of the WARC files under ``path``.

    Digest and length of a stored payload are taken from its bytes; a revisit has its digest from the
    record's field and its length from the HTTP head.
    """

    def rows(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                for fields, block in warc_records(_unpacked(content)):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    head, payload = _http_parts(block) or (b"", block)
                    own = re.search(rb"(?im)^%s:\s*(-?\d+)" % ID_HEADER.encode(), head)
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if kind == "revisit":
                        declared = re.search(rb"(?im)^Content-Length:\s*(\d+)", head)
                        size = int(declared[1]) if declared else None
                        raw = fields.get("warc-payload-digest", "").partition(":")[2]
                        digest = base64.b32decode(raw).hex()
                    yield (
                        fields.get("warc-record-id", "").strip("<>"),
                        kind,
                        fields.get("warc-target-uri"),
                        fields.get("warc-date"),
                        int(own[1]) if own else None,
                        size,
                        digest,
                        fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                    )

    def run(batches):
        names = [part.split()[0] for part in ARCHIVED.split(", ")]
        yield from _batches(rows(batches), names, _ARCHIVED_KINDS)

    return _contents(spark, path).select("content").mapInArrow(run, ARCHIVED)


def through_archives(pages: DataFrame, folder: str) -> DataFrame:
    """``pages`` (page_id, url, html) written as ARC, converted to WARC and read back.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, uri and record_id.  A
    null html is an empty payload and a null url an unknown one; a null page_id comes back null and
    ranks lowest; of repeated rows with a long payload one is the response; an empty input gives no
    rows; other columns are ignored.  ``folder`` must not exist yet.
    """
    spark = pages.sparkSession
    write_arc(pages, f"{folder}/arc")
    write_warc(convert(spark, f"{folder}/arc"), f"{folder}/warc")
    read = cut(read_warc(spark, f"{folder}/warc"))
    stored = read.where("record_type != 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return read.join(stored, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "record_id"
    )
