"""Legacy archives: ARC files read by their declared lengths, WARC written.

``write_arc`` stores pages as ARC records, ``read_arc`` parses ARC files of
version 1 (five header fields) and version 2 (ten), ``to_warc`` gives each
record the WARC fields that ARC lacks, ``write_warc`` and ``read_warc`` store
and read WARC files.

Records go through Spark's own text and binaryFile formats, so archives can be
in any store that Spark reaches. A file holds the records of one task, at most
``RECORDS_PER_FILE`` of them; readers hold one file at a time. WARC files are
gzip streams.

* WARC-Record-ID: UUID version 5 of the archive's name, URL, date, payload
  digest and record number; the same archive always gives the same identifier.
* WARC-Date: the ARC date (YYYYMMDDhhmmss, short forms padded) in ISO 8601.
* WARC-Type: ``response`` for pages, whatever their URL; of records that are
  no pages (ARC files of others), ``resource`` for other schemes than HTTP and
  ``warcinfo`` for a version block; ``revisit`` by payload digest.
* Digests: SHA-1 in base 32, of the payload and (revisits) of the full payload.

Null payloads count as empty. Repeated page rows are separate records; of
records with equal payloads, the largest page_id is the response. A header
line that matches no version, or a length beyond the file, ends the reading of
that file with an error that names it: nothing is skipped in silence.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import saved, scratch_path

RECORDS_PER_FILE = 2000
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-to-warc")

#: The record header fields of the two ARC versions.
FIELDS = {1: b"URL IP-address Archive-date Content-type Archive-length",
          2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}

RECORD = ("archive string, number long, url string, ip string, date string, content_type string,"
          " result_code string, payload binary")
WARC = ("archive string, record_id string, type string, url string, date string, content_type string,"
        " payload_digest string, payload_bytes long, refers_to_id string, page_id long, refers_to long, block binary")


def _as_line(c: Column) -> Column:
    """Bytes as they are, for the text writer."""
    return c.cast("string")


def arc_record(url: Column, date: Column, payload: Column, version: Column) -> Column:
    """The header line and payload of an ARC record (without the line end after it)."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("unknown:")), r"\s", "%20")
    size = F.octet_length(payload)
    head = F.when(version == 2, F.concat_ws(" ", clean, F.lit("0.0.0.0"), date, F.lit("text/html"), F.lit("200"),
                                            F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"), size)) \
        .otherwise(F.concat_ws(" ", clean, F.lit("0.0.0.0"), date, F.lit("text/html"), size))
    return _as_line(F.concat(F.encode(head, "UTF-8"), F.lit(b"\n"), payload))


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> str:
    """Pages (page_id, url, html) as gzip ARC files of both versions, under
    ``path``/version=N. Their file names carry no meaning."""
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    keyed = F.concat(F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("unknown:")),
                     F.lit("#page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    # even ids to version 1, odd ones and null to version 2
    version = F.when(F.col("page_id") % 2 == 0, 1).otherwise(2)
    pages.select(version.alias("version"), arc_record(keyed, F.lit(date), payload, version).alias("value")).write \
        .option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED") \
        .option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy("version").mode("overwrite").text(path)
    return path


_HEAD = {5: 1, 10: 2}


def parse_arc(name: str, data: bytes):
    """The records of one ARC file: (url, ip, date, type, result code, payload)."""
    if data[:2] == b"\x1f\x8b":
        import gzip

        data = gzip.decompress(data)  # also of many members
    at = version = 0
    while at < len(data):
        end = data.find(b"\n", at)
        head = data[at:end if end >= 0 else len(data)].rstrip(b"\r").split(b" ")
        if end < 0 or len(head) not in _HEAD or not head[-1].isdigit():
            raise ValueError(f"{name}: no ARC header at byte {at}")
        size, start = int(head[-1]), end + 1
        if start + size > len(data):
            raise ValueError(f"{name}: record at byte {at} ends beyond the file")
        text = [x.decode("utf-8", "replace") for x in head]
        payload = data[start:start + size]
        if text[0].startswith("filedesc:") and page_key(text[0])[1] is None:  # the version block describes the file itself
            declared = payload.split(b"\n", 2)
            version = int(declared[0].split(b" ")[0])
            if len(declared) > 1 and declared[1].strip() != FIELDS.get(version):
                raise ValueError(f"{name}: fields of version {version} are not known")
            yield (*text[:4], text[4] if len(head) == 10 else None, payload)
        elif version and _HEAD[len(head)] != version:
            raise ValueError(f"{name}: header at byte {at} is not of version {version}")
        else:
            yield (*text[:4], text[4] if len(head) == 10 else None, payload)
        at = start + size
        if data[at:at + 1] not in (b"\n", b""):
            raise ValueError(f"{name}: record before byte {at} is longer than declared")
        while data[at:at + 1] == b"\n":
            at += 1


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files under ``path``; the number counts within a file."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                name = b.column(0)[k].as_py()
                yield from _record_batches(name, parse_arc(name, b.column(1)[k].as_py()))

    return _files(spark, path).mapInArrow(run, RECORD)


def _record_batches(name, records, most: int = 4 << 20):
    import pyarrow as pa

    kind = pa.schema([("archive", pa.string()), ("number", pa.int64()), *((c, pa.string()) for c in (
        "url", "ip", "date", "content_type", "result_code")), ("payload", pa.binary())])
    rows, size = [], 0
    short = name.rsplit("/", 1)[-1]
    for number, r in enumerate(records):
        rows.append((short, number, *r))
        size += len(r[-1])
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def iso_date(date: str) -> str:
    """ARC dates have 8, 12 or 14 digits."""
    d = (re.sub(r"\D", "", date or "") + "00000101000000"[len(re.sub(r"\D", "", date or "")):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def page_key(url: str) -> tuple[str, str | None]:
    """The URL and the page's key, which ``write_arc`` puts last ("" for null);
    None for records that are no pages."""
    found = re.fullmatch(r"(.*)#page_id=(-?\d*)", url, re.DOTALL)
    return found.groups() if found else (url, None)


def record_type(url: str, key: str | None) -> str:
    if key is not None or re.match("https?:|unknown:", url, re.IGNORECASE):
        return "response"
    return "warcinfo" if url.startswith("filedesc:") else "resource"


def to_warc(records: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """ARC records with WARC identifiers, dates, types, digests and block.

    Only the narrow keys of payloads are grouped; of those that occur once,
    none is joined back. Records of equal payloads shorter than
    ``min_revisit_bytes`` are all responses."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            c = b.to_pydict()
            digest = [base32_sha1(p) for p in c["payload"]]
            rid = [f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{a} {u} {d} {g} {n}')}>" for a, u, d, g, n in
                   zip(c["archive"], c["url"], c["date"], digest, c["number"], strict=True)]
            url, key = zip(*(page_key(u) for u in c["url"]), strict=True) if c["url"] else ((), ())
            web = [record_type(u, k) for u, k in zip(url, key, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "archive": c["archive"], "record_id": rid, "type": web,
                "url": url,
                "date": [iso_date(d) for d in c["date"]], "content_type": c["content_type"],
                "payload_digest": digest, "payload_bytes": [len(p) for p in c["payload"]],
                "refers_to_id": pa.nulls(b.num_rows, pa.string()),
                "page_id": pa.array([int(k) if k else None for k in key], pa.int64()),
                "refers_to": pa.nulls(b.num_rows, pa.int64()), "block": c["payload"]},
                schema=pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("type", pa.string()),
                                  ("url", pa.string()), ("date", pa.string()), ("content_type", pa.string()),
                                  ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                                  ("refers_to_id", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()),
                                  ("block", pa.binary())]))

    found = records.mapInArrow(run, WARC)
    # the response of each repeated payload: the largest page_id, then the smallest record id
    first = found.where((F.col("payload_bytes") >= min_revisit_bytes) & (F.col("type") != "warcinfo")) \
        .groupBy("payload_digest", "payload_bytes") \
        .agg(F.count(F.lit(1)).alias("n"),
             F.max(F.struct(F.coalesce("page_id", F.lit(-1)).alias("p"), F.col("record_id"))).alias("top")) \
        .where("n > 1").select("payload_digest", "payload_bytes", "top")
    first = saved(first)  # its size is then known when the join is planned
    joined = found.join(first, ["payload_digest", "payload_bytes"], "left")
    again = F.col("top").isNotNull() & (F.col("type") != "warcinfo") & (F.col("record_id") != F.col("top.record_id"))
    return joined.select(
        "archive", "record_id", F.when(again, "revisit").otherwise(F.col("type")).alias("type"), "url", "date",
        "content_type", "payload_digest", "payload_bytes",
        F.when(again, F.col("top.record_id")).alias("refers_to_id"), "page_id",
        F.when(again, F.when(F.col("top.p") >= 0, F.col("top.p"))).alias("refers_to"),
        F.when(again, F.lit(b"")).otherwise(F.col("block")).alias("block"))


_END = "\r\n"


def warc_record(r: DataFrame) -> Column:
    """Header and block of a WARC record; the writer adds the two line ends."""
    def line(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value.cast("string"), F.lit(_END))).otherwise("")

    head = F.concat(
        F.lit("WARC/1.1" + _END), line("WARC-Type", r["type"]), line("WARC-Record-ID", r["record_id"]),
        line("WARC-Target-URI", r["url"]), line("WARC-Date", r["date"]),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), r["payload_digest"])),
        line("WARC-Refers-To", r["refers_to_id"]),
        line("WARC-Profile", F.when(r["type"] == "revisit", F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("X-Page-Id", r["page_id"]), line("X-Refers-To-Page-Id", r["refers_to"]),
        line("X-Payload-Length", r["payload_bytes"]), line("Content-Type", r["content_type"]),
        line("Content-Length", F.octet_length(r["block"])), F.lit(_END))
    return _as_line(F.concat(F.encode(head, "UTF-8"), r["block"]))


def write_warc(records: DataFrame, path: str) -> str:
    """Records of ``to_warc`` as gzip WARC files under ``path``."""
    records.select(warc_record(records).alias("value")).write.option("lineSep", _END * 2) \
        .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).mode("overwrite").text(path)
    return path


def parse_warc(name: str, data: bytes):
    """(fields, block) of each record of one WARC file."""
    if data[:2] == b"\x1f\x8b":
        import gzip

        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:max(end, at)].decode("utf-8").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = fields.get("Content-Length", "")
        if not lines[0].startswith("WARC/1.") or not size.isdigit() or end + 4 + int(size) > len(data):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        at = end + 4 + int(size)
        yield fields, data[end + 4:at]
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"{name}: record before byte {at} is longer than declared")
        at += 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``. The digest and length of
    responses are those of the block read; a digest in the header that differs
    is an error. Revisits keep the ones declared."""
    def run(batches):
        import pyarrow as pa

        kind = pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("url", pa.string()),
                          ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
                          ("payload_bytes", pa.int64()), ("refers_to_id", pa.string()), ("page_id", pa.int64()),
                          ("refers_to", pa.int64()), ("block", pa.binary())])
        for b in batches:
            for k in range(b.num_rows):
                name = b.column(0)[k].as_py()
                rows, size = [], 0
                for f, block in parse_warc(name, b.column(1)[k].as_py()):
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = f["WARC-Type"] == "revisit"
                    if not revisit and base32_sha1(block) != digest:
                        raise ValueError(f"{name}: {f['WARC-Record-ID']} has another digest")
                    page, to = f.get("X-Page-Id"), f.get("X-Refers-To-Page-Id")
                    rows.append((name.rsplit("/", 1)[-1], f["WARC-Record-ID"], f["WARC-Type"], f.get("WARC-Target-URI"), f["WARC-Date"],
                                 f.get("Content-Type"), digest, int(f["X-Payload-Length"]) if revisit else len(block),
                                 f.get("WARC-Refers-To"), int(page) if page else None, int(to) if to else None, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), kind)], schema=kind)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), kind)], schema=kind)

    return _files(spark, path).mapInArrow(run, WARC)


def convert_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages through ARC files, the converter and WARC files; the records read back."""
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession)
    arc = write_arc(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), f"{path}/arc")
    warc = write_warc(to_warc(read_arc(spark, arc), min_revisit_bytes), f"{path}/warc")
    return read_warc(spark, warc)
