"""Legacy archive converter: ARC files become WARC files.

ARC 1 records start with ``URL IP date type length``, ARC 2 records with ``URL IP date
type status checksum location offset file length``; the version block of a file says
which. The converter reads each record by its declared length and makes up what a WARC
record needs: a type (``warcinfo`` for the version block, ``response`` for HTTP blocks,
else ``resource``), an identifier that depends on content and place only, a W3C time,
and SHA-1 digests of block and payload. Of records with equal payloads one is stored in
full; the others become ``revisit`` records that refer to it.

Files are written and read by Spark's text source with the end mark of a record as line
separator, so bytes go through as they are, on any file system Spark knows. Compressed
files are not split, so each is read by one task in order, one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

ARC_END, WARC_END = "\n", "\r\n\r\n"
#: Fields of a record line by the version of the file.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CAPTURED = "20240101000000"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Bytes:
    """A file as a stream of chunks that a separator followed; holds little more than asked for."""

    def __init__(self, chunks: Iterator[bytes], separator: bytes):
        self.chunks, self.separator, self.held = chunks, separator, bytearray()

    def _more(self) -> bool:
        for chunk in self.chunks:
            self.held += chunk
            self.held += self.separator
            return True
        return False

    def _take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def read(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        return self._take(n)

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the mark, which is skipped; None at the end of the file."""
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                return None
        out = self._take(found)
        del self.held[: len(mark)]
        return out


def page_key(said: str) -> int | None:
    """A page id as it is written in a header, if it is one: any long."""
    key = int(said) if re.fullmatch(r"-?[0-9]{1,19}", said) else None
    return key if key is not None and -(1 << 63) <= key < 1 << 63 else None


def http_block(page_id: int | None, payload: bytes) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    return "\r\n".join([*head, "", ""]).encode() + payload


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(header fields in lower case, header bytes, payload) of an HTTP response block."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not mark:
        return {}, b"", block
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, head + mark, payload


def arc_url(url: str | None) -> str:
    """The address with white space, controls and letters outside ASCII in percent form."""
    return "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in (url or "unknown:").encode())


def arc_line(version: int, url: str, kind: str, length: int, name: str, date: str = CAPTURED) -> str:
    middle = " " if version == 1 else f" 200 - - 0 {name} "
    return f"{url} 0.0.0.0 {date} {kind}{middle}{length}"


def arc_start(version: int, name: str) -> bytes:
    """The version block that opens a file."""
    body = f"{version} 0 own\n{ARC_FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", "text/plain", len(body), name).encode() + b"\n" + body


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = (1, 2), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One ARC file per task, the versions in turn. A null payload is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = versions[part % len(versions)], f"part-{part:05d}.arc"
        out = [arc_start(version, name)]
        for b in batches:
            for page_id, url, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                block = http_block(page_id, payload)
                out.append(arc_line(version, arc_url(url), "text/html", len(block), name).encode() + b"\n" + block)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
            out = []

    common.small_batches(pages.sparkSession)
    rows = pages.select(id_col, F.col(url_col).alias("url"), common.utf8(html_col).alias("payload"))
    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", ARC_END).option("compression", "gzip").text(path)


def arc_records(chunks: Iterator[bytes], name: str) -> Iterator[dict]:
    """Records of one ARC file as WARC fields. Lines that are no record line are skipped."""
    stream, version, place = Bytes(chunks, ARC_END.encode()), 1, 0
    while (line := stream.until(b"\n")) is not None:
        fields = line.decode("utf-8", "replace").rsplit(" ", len(ARC_FIELDS[version].split()) - 1)
        opening = place == 0 and line.startswith(b"filedesc://")  # a page may have such an address, too
        if opening:  # a version 1 line may stand before a version 2 body
            fields = [*line.decode("utf-8", "replace").split(" ")[:4], line.decode("utf-8", "replace").split(" ")[-1]]
        if len(fields) < 5 or not fields[-1].isdigit() or not re.fullmatch(r"\d{14}", fields[2]):
            continue
        block = stream.read(int(fields[-1]))
        stream.read(1)
        url, date, kind = fields[0], fields[2], fields[3]
        if opening:
            version = 2 if block[:1] == b"2" else 1
            warc_type, http, payload = "warcinfo", {}, block
        else:
            http, head, payload = split_http(block)
            warc_type = "response" if head else "resource"
        yield {
            "record_id": f"<urn:uuid:{uuid.uuid5(SPACE, f'{name} {place} {url}')}>",
            "key": page_key(http.get("x-page-id", "")),
            "type": warc_type, "uri": url, "mime": kind, "place": place,
            "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z",
            "payload_bytes": len(payload), "payload_digest": sha1_base32(payload), "block": block,
        }
        place += 1


def warc_value(r: dict) -> bytes:
    """A WARC record without its end mark. A revisit keeps the HTTP header only."""
    block, kind = r["block"], r["type"]
    _, head, _ = split_http(block)
    if kind == "revisit":
        block = head
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}",
    ]
    if kind == "warcinfo":
        lines.append("Content-Type: application/warc-fields")
    else:
        lines += [f"WARC-Target-URI: {r['uri']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
        lines.append(f"Content-Type: {'application/http; msgtype=response' if head else r['mime']}")
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {r['keep_record']}", f"X-Refers-To-Key: {r['keep_key']}",
        ]
    return "\r\n".join([*lines, "", ""]).encode() + block


def warc_records(chunks: Iterator[bytes], name: str) -> Iterator[dict]:
    """Records of one WARC file; heads without a length are skipped."""
    stream = Bytes(chunks, WARC_END.encode())
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
            continue
        block = stream.read(int(fields["content-length"]))
        stream.read(4)
        http, header, payload = split_http(block)
        whole = fields.get("warc-type") != "revisit"
        number = http.get("content-length", "")
        yield {
            "record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            "page_id": page_key(http.get("x-page-id", "")), "uri": fields.get("warc-target-uri"),
            "refers_to": page_key(fields.get("x-refers-to-key", "")),
            "payload_bytes": len(payload) if whole or not number.isdigit() else int(number),
            "payload_digest": sha1_base32(payload) if whole else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
            "sound": fields.get("warc-block-digest") == f"sha1:{sha1_base32(block)}",
            "payload": payload if whole else None,
        }


def read_files(spark: SparkSession, path: str, end: str, parse: Callable, schema: str, fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    """Records of all files of a folder. Each compressed file is read in order by one task."""
    common.small_batches(spark)
    rows = spark.read.option("lineSep", end).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("file"))
    kind = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = ((f, v) for b in batches for v, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for name, own in groupby(flat, lambda x: x[0]):
            some, size = [], 0
            for r in parse((v for _, v in own), name):
                some.append({n: r[n] for n, _ in fields})
                size += r["payload_bytes"] + 500
                if size > common.BATCH_BYTES // 4:
                    yield pa.RecordBatch.from_pylist(some, kind)
                    some, size = [], 0
            if some:
                yield pa.RecordBatch.from_pylist(some, kind)

    return rows.mapInArrow(run, schema)


ARC_KIND = [(n, pa.string()) for n in ("record_id", "type", "uri", "mime", "date", "payload_digest")] + [("key", pa.int64()), ("payload_bytes", pa.int64())]
ARC_SCHEMA = "record_id string, type string, uri string, mime string, date string, payload_digest string, key bigint, payload_bytes bigint"
WARC_KIND = [(n, pa.string()) for n in ("record_id", "record_type", "uri", "payload_digest")] + [(n, pa.int64()) for n in ("page_id", "refers_to", "payload_bytes")] + [("sound", pa.bool_()), ("payload", pa.binary())]
WARC_SCHEMA = "record_id string, record_type string, uri string, payload_digest string, page_id bigint, refers_to bigint, payload_bytes bigint, sound boolean, payload binary"


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> None:
    """All ARC files of a folder as WARC files of another.

    Of responses with equal payloads of at least ``least_bytes`` bytes, the one with the
    largest key stays whole (of equal keys that with the smallest identifier; without a
    key only if none has one), the others revisit it. Empty payloads are payloads.
    """
    heads = common.stored(read_files(spark, arc, ARC_END, arc_records, ARC_SCHEMA, ARC_KIND).select("record_id", "type", "key", "payload_digest", "payload_bytes"), "heads")
    pages = heads.where((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
    best = F.min_by(F.struct("key", "record_id"), F.struct(F.col("key").isNull().alias("none"), F.bitwise_not("key").alias("large"), "record_id"))
    groups = pages.groupBy("payload_digest", "payload_bytes").agg(best.alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = common.stored(groups, "groups")
    chosen = common.attach(pages.select("record_id", "payload_digest", "payload_bytes"), groups, ["payload_digest", "payload_bytes"], "n")
    revisits = chosen.where("record_id <> keep.record_id").select(F.col("record_id").alias("again"), F.col("keep.key").alias("keep_key"), F.col("keep.record_id").alias("keep_record"))
    records = read_files(spark, arc, ARC_END, arc_records, ARC_SCHEMA + ", block binary", [*ARC_KIND, ("block", pa.binary())])
    records = records.join(revisits, records["record_id"] == revisits["again"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [warc_value(r | ({"type": "revisit"} if r["keep_record"] else {})) for r in b.drop_columns(["again"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", WARC_END).option("compression", "gzip").text(warc)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, uri, page_id, refers_to, payload_bytes, payload_digest, sound, payload."""
    return read_files(spark, path, WARC_END, warc_records, WARC_SCHEMA, WARC_KIND)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages into ARC files, those into WARC files, and what the WARC files hold."""
    home = common.scratch(spark, "op1")
    write_arc(common.table(spark, sf_dir, "pages"), f"{home}/arc")
    convert(spark, f"{home}/arc", f"{home}/warc")
    kinds = [f for f in WARC_KIND if f[0] != "payload"]
    back = read_files(spark, f"{home}/warc", WARC_END, warc_records, WARC_SCHEMA.removesuffix(", payload binary"), kinds)
    return back.where("record_type IN ('response', 'revisit')").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Letter i of base32 is five bits of the hexadecimal digest: from digit 5 * (i // 4) on, 20 bits hold four letters.
_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, {i // 4 * 5 + 1}, 5))::INTEGER) >> {15 - i % 4 * 5}) & 31), 1)"
    for i in range(32)
)
OP1_SQL = f"""
WITH h AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM m
"""
