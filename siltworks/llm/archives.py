"""Legacy archives read by their version's header lines, and written as WARC.

An ARC file is a version block and then records: a header line whose fields depend on the
version, a declared number of bytes, and a line end. The reader goes by declared lengths
only, so payloads may hold anything. Each record becomes a WARC record with an identifier,
a timestamp, a type and digests made from what the ARC has.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.staging import settle, staged_path

# The fields of a header line, by the version of the archive.
FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "code", "checksum", "location", "offset", "file", "length"],
}
URL_RECORD_DEFINITION = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "19960101000000"
WARC_END = "\r\n\r\n"
ID_HEADER = b"X-Page-Id"
HEAD_END = re.compile(rb"\r\n\r\n")
# A field of our own: a revisit has no payload to measure.
LENGTH_FIELD = "X-Payload-Length"
HTTP = "application/http; msgtype=response"
UNKNOWN_TYPE = "application/octet-stream"

_RECORD = "page_id long, url string, ip string, date string, record_id string, digest string, payload_bytes long, content_type string"


def arc_header(version: int, **fields) -> bytes:
    """A header line without its line end; blanks inside a field are escaped."""
    values = [str(fields.get(name) or "-").replace(" ", "%20") for name in FIELDS[version]]
    return " ".join("".join(v.splitlines()) or "-" for v in values).encode()


def arc_version_block(version: int, name: str, date: str = NO_DATE) -> bytes:
    body = f"{version} 0 siltworks\n{URL_RECORD_DEFINITION[version]}\n".encode()
    head = arc_header(
        version, url=f"filedesc://{name}", ip="0.0.0.0", date=date, type="text/plain",
        code=200, offset="0", file=name, length=len(body),
    )
    return head + b"\n" + body


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Fields and block of every record but the version block.

    The version block's second line names the version; the fields of later header lines
    follow it. A length that is no number or runs over the end is an error.
    """
    at, version, view = 0, None, memoryview(data)
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            end = len(data)
        line = data[at:end].rstrip(b"\r")
        if not line:
            at = end + 1
            continue
        values = line.decode("utf-8", "replace").split(" ")
        if version is None:
            length = int(values[-1])
            block = bytes(view[end + 1 : end + 1 + length])
            if not values[0].startswith("filedesc://"):
                raise ValueError("the archive does not begin with a version block")
            version = int(block.split(None, 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown archive version {version}")
        else:
            names = FIELDS[version]
            if len(values) < len(names):
                raise ValueError(f"a header line with {len(values)} fields in version {version}")
            # Blanks that a writer left in the address belong to the first field.
            extra = len(values) - len(names)
            values = [" ".join(values[: extra + 1]), *values[extra + 1 :]]
            fields = dict(zip(names, values))
            length = int(fields["length"])
            if length < 0 or end + 1 + length > len(data):
                raise ValueError("a declared length runs over the end of the archive")
            yield fields, view[end + 1 : end + 1 + length]
        at = end + 1 + length


def http_parts(block: memoryview) -> tuple[list[bytes], memoryview]:
    """Header lines and payload of an HTTP response; all of any other block is payload."""
    end = HEAD_END.search(block) if block[:5] == b"HTTP/" else None
    if end is None:
        return [], block
    return bytes(block[: end.start()]).split(b"\r\n"), block[end.end() :]


def header(lines: list[bytes], name: bytes) -> str | None:
    for line in lines:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower():
            return value.strip().decode("utf-8", "replace")
    return None


def base32_sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_date(date: str) -> str:
    """An ISO timestamp from 14 digits; shorter ones are filled, others replaced."""
    digits = (date + NO_DATE[len(date) :])[:14]
    if not (digits.isascii() and digits.isdigit()):
        digits = NO_DATE
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers (lower-case names) and block of every record, by declared lengths."""
    at, view = 0, memoryview(data)
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        if end + 4 + length > len(data):
            raise ValueError("a declared length runs over the end of the archive")
        yield headers, view[end + 4 : end + 4 + length]
        at = end + 4 + length


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """Pages (page_id, url, html) as ARC files, one for each partition."""
    source = pages.select(
        F.col("page_id").cast("string").alias("id"), F.col("url").alias("url"),
        F.col("html").cast("binary").alias("html"),
    )

    def records(batches):
        first = True
        for batch in batches:
            out = []
            if first:
                out.append(arc_version_block(version, "pages.arc"))
                first = False
            for id_, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                html = html or b""
                lines = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=UTF-8"]
                lines.append(b"Content-Length: %d" % len(html))
                if id_ is not None:
                    lines.append(ID_HEADER + b": " + id_.encode())
                block = b"\r\n".join([*lines, b"", html])
                head = arc_header(
                    version, url=url, ip="0.0.0.0", date=NO_DATE, type="text/html", code=200,
                    checksum=None, offset="0", file="pages.arc", length=len(block),
                )
                out.append(head + b"\n" + block)
            # Few records at a time, so that a batch on its way back stays small.
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(out[at : at + 64], pa.binary())], ["value"])

    rows = source.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    rows.write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _arc_rows(files: DataFrame, with_block: bool) -> DataFrame:
    """A row per ARC record, with the parts of its WARC record that do not depend on others."""

    def parse(batches):
        for batch in batches:
            for path, content in zip(*(batch.column(i).to_pylist() for i in range(2))):
                name = path.rsplit("/", 1)[-1]
                rows, size = [], 0
                for number, (fields, block) in enumerate(arc_records(_unpacked(content))):
                    lines, payload = http_parts(block)
                    id_ = header(lines, ID_HEADER)
                    made = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{number} {fields['url']}")
                    row = [
                        int(id_) if id_ is not None else None, fields["url"], fields["ip"],
                        warc_date(fields["date"]), f"<urn:uuid:{made}>", base32_sha1(payload),
                        len(payload), HTTP if lines else _media_type(fields["type"]),
                    ]
                    if with_block:
                        head = bytes(block[: len(block) - len(payload)])
                        row += [base32_sha1(block), base32_sha1(head), head, bytes(payload)]
                    rows.append(row)
                    size += len(block)
                    if size > 1 << 22:
                        yield _batch(rows, with_block)
                        rows, size = [], 0
                yield _batch(rows, with_block)

    more = ", block_digest string, head_digest string, head binary, payload binary"
    return files.mapInArrow(parse, _RECORD + (more if with_block else ""))


_TYPES = {
    "page_id": pa.int64(), "url": pa.string(), "ip": pa.string(), "date": pa.string(),
    "record_id": pa.string(), "digest": pa.string(), "payload_bytes": pa.int64(),
    "content_type": pa.string(),
    "block_digest": pa.string(), "head_digest": pa.string(), "head": pa.binary(),
    "payload": pa.binary(),
}


def _media_type(declared: str) -> str:
    """The type that an ARC header line declares, where it is one."""
    return declared if re.fullmatch(r"[\w.+-]+/[\w.+;=-]+", declared) else UNKNOWN_TYPE


def _batch(rows: list[list], with_block: bool) -> pa.RecordBatch:
    names = list(_TYPES)[: len(_TYPES) if with_block else 8]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[n]) for c, n in zip(columns, names)], names=names
    )


def arc_to_warc(
    spark: SparkSession, arc: str, warc: str, least_bytes: int = 0
) -> None:
    """Convert the ARC files below ``arc`` to WARC files below ``warc``.

    A record of an HTTP response is a ``response`` or a ``revisit``. Any other, such as a DNS
    answer, is a ``resource`` with the content type of its ARC header line. Of responses with equal payloads of at least ``least_bytes`` bytes, the one with the largest
    page id (then record id; null ids come first) is a response and the others revisit it.
    Smaller payloads are all responses. Only payloads that occur twice enter the join.
    """
    files = _files(spark, arc)
    place = F.struct("page_id", "record_id", "date")
    kept = settle(
        _arc_rows(files, with_block=False)
        .filter((F.col("payload_bytes") >= least_bytes) & (F.col("content_type") == HTTP))
        .groupBy("digest", "payload_bytes")
        .agg(F.max(place).alias("kept"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(F.col("digest").alias("_digest"), "kept"),
        "repeated_payloads",
    )
    rows = _arc_rows(files, with_block=True)
    http = rows["content_type"] == HTTP
    rows = rows.join(
        kept, (rows["digest"] == kept["_digest"]) & (rows["payload_bytes"] >= least_bytes) & http, "left"
    )
    revisit = F.coalesce(F.col("kept.record_id") != F.col("record_id"), F.lit(False))
    block_bytes = F.length("head") + F.when(revisit, 0).otherwise(F.length("payload"))

    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").when(http, "response").otherwise("resource")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.col("head_digest")).otherwise(F.col("block_digest")))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", F.col("kept.record_id")),
                line("WARC-Refers-To-Date", F.col("kept.date")),
            ),
        ).otherwise(""),
        line(LENGTH_FIELD, F.col("payload_bytes").cast("string")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", block_bytes.cast("string")),
        F.lit("\r\n"),
    )
    # The writer's line separator is the end of a WARC record.
    record = F.concat(
        head.cast("binary"), F.col("head"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    )
    rows.select(record.cast("string").alias("value")).write.option("compression", "gzip").option(
        "lineSep", WARC_END
    ).text(warc)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: identifiers, type, digest and payload size.

    A revisit's payload size is that of the field ``X-Payload-Length``; archives of other writers
    give it by the HTTP header, if at all. Digests of other records are computed from the payload and must equal the declared ones.
    """

    def parse(batches):
        for batch in batches:
            for content in batch.column(1).to_pylist():
                rows = []
                for headers, block in warc_records(_unpacked(content)):
                    lines, payload = http_parts(block)
                    kind = headers["warc-type"]
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(headers.get(LENGTH_FIELD.lower()) or header(lines, b"Content-Length") or 0)
                    elif base32_sha1(payload) != digest:
                        raise ValueError(f"wrong payload digest in {headers['warc-record-id']}")
                    id_ = header(lines, ID_HEADER)
                    rows.append(
                        [int(id_) if id_ is not None else None, size, digest, kind,
                         headers["warc-record-id"], headers.get("warc-refers-to")]
                    )
                columns = list(zip(*rows)) if rows else [[]] * 6
                types = [pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"],
                )

    return _files(spark, path).mapInArrow(
        parse,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "record_id string, refers_to_id string",
    )


def archived(pages: DataFrame, version: int = 1, least_bytes: int = 0) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back, one row per page.

    A null html is an empty payload, a null url is written as ``-``. Rows with equal page ids,
    null ones too, are records of their own; a revisit of a record without an id has none
    in ``refers_to``. Other columns than page_id, url and html are not archived.
    """
    spark = pages.sparkSession
    arc, warc = staged_path(spark, "arc"), staged_path(spark, "warc")
    write_arc(pages, arc, version)
    arc_to_warc(spark, arc, warc, least_bytes)
    found = settle(read_warc(spark, warc), "archived")
    referred = found.filter("refers_to_id is not null").select(F.col("refers_to_id").alias("_wanted"))
    responses = found.select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"))
    names = responses.join(referred.distinct(), F.col("_id") == F.col("_wanted"), "left_semi")
    return found.join(names, found["refers_to_id"] == names["_id"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
