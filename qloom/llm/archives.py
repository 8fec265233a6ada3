"""Legacy archives: ARC files of versions 1 and 2 converted to WARC.

An ARC file starts with a version block: a header line ``filedesc://... `` whose declared length covers a line
``<version> <reserved> <origin>`` and the line that names the fields. Records follow, each a header line and as many
bytes as the line declares, then a newline:

    version 1: URL IP-address Archive-date Content-type Archive-length
    version 2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

The fields are read from the right, as URLs of old archives hold blanks. Each record becomes a WARC record: its
identifier is a UUID made from file, offset and URL, so that a repeated task makes the same; its timestamp is the Archive-date
in ISO form; its type is ``warcinfo`` for the version block, ``response`` for HTTP responses and ``resource`` for
the rest; block and payload digests are SHA-256 of what the converter has read. Of responses with equal payloads of at least
``least`` bytes that with the smallest key is kept whole and the others become ``revisit`` records that refer to it.

Files are gzip, one member per record. They are written to a shared folder under names that no two attempts of a
task share, and a manifest (one row per file, cut by a checkpoint) tells which count. Each file is converted and read as a stream, one
record in memory at a time; a file is closed at ``file_records`` records or ``file_bytes`` bytes, which bounds what is gathered for it.

Damaged places of old archives (lines that are no header, records cut off, unknown versions) are passed over and listed by
``damage``; the records around them are converted.

Null and empty pages are records with an empty payload; null URLs are written as ``about:blank``, and blanks and control characters
in URLs are percent-encoded when pages are written. The key of a page is its page_id and travels as an HTTP header. Null keys
are allowed: such pages refer to others, others refer to them only where all keys of a digest are null.
Repeated page ids are records each. An empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import NO_ID, boxed, cut, open_in, open_out, shared_folder, unboxed
from qloom.sources.tables import scan

LEAST = 100
FILE_RECORDS = 20_000
FILE_BYTES = 64 << 20
KEY_HEADER = "X-Page-Id"

# fixed values: the fields of the two versions
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
FIRST_DAY = datetime(1996, 1, 1, tzinfo=timezone.utc)


class Members:
    """Writes bytes as gzip members and counts them."""

    def __init__(self, folder: str, stem: str):
        self.path, self.out = open_out(folder, stem)
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.out.write(member := packer.compress(data) + packer.flush())
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        self.out.close()


class Unpacked:
    """The bytes of a file of gzip members as one stream, read piece by piece."""

    def __init__(self, path: str, piece: int = 1 << 20):
        self.stream, self.piece = open_in(path), piece
        self.packer = zlib.decompressobj(31)
        self.buffer, self.start, self.offset = b"", 0, 0

    def _fill(self) -> bool:
        while True:
            raw = self.packer.unconsumed_tail or self.packer.unused_data
            if self.packer.eof:
                self.packer = zlib.decompressobj(31)
            raw = raw or self.stream.read(self.piece)
            if not raw:
                return False
            # what a piece unpacks to is bounded too
            if got := self.packer.decompress(raw, 16 * self.piece):
                self.buffer = self.buffer[self.start :] + got
                self.start = 0
                return True

    def line(self) -> bytes | None:
        """Up to and without the next newline; None at the end."""
        while (stop := self.buffer.find(b"\n", self.start)) < 0:
            if not self._fill():
                if self.start < len(self.buffer):
                    raise ValueError(f"a line is cut off at {self.offset}")
                return None
        out = self.buffer[self.start : stop]
        self.offset += stop + 1 - self.start
        self.start = stop + 1
        return out

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            part = self.buffer[self.start : self.start + left]
            parts.append(part)
            self.start += len(part)
            left -= len(part)
            if left and not self._fill():
                raise ValueError(f"a record is cut off at {self.offset}")
        self.offset += n
        return b"".join(parts)

    def close(self) -> None:
        self.stream.close()


# ---------------------------------------------------------------- ARC


def arc_header(fields: dict[str, str], version: int) -> bytes:
    return " ".join(fields.get(name, "-") for name in FIELDS[version].split()).encode()


def arc_version_block(name: str, date: str, version: int) -> bytes:
    block = f"{version} 0 qloom\n{FIELDS[version]}\n".encode()
    given = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
    return arc_header({**given, "Result-code": "200", "Offset": "0", "Filename": name, "Archive-length": str(len(block))}, version) + b"\n" + block + b"\n"


def arc_record(url: str, date: str, content_type: str, block: bytes, version: int, name: str, offset: int) -> bytes:
    given = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": content_type}
    more = {"Result-code": "200", "Checksum": hashlib.md5(block).hexdigest(), "Offset": str(offset), "Filename": name}
    return arc_header({**given, **more, "Archive-length": str(len(block))}, version) + b"\n" + block + b"\n"


def read_arc(path: str, bad: Callable[[int, str], None] | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the version block and of each record, in order.

    With ``bad``, damage is told to it as (offset, reason) and reading goes on at the next line that is a header: one with all
    fields, a date of digits and a length. A file of an unknown version, and what follows a record cut off by the file's
    end, are left. Without it, damage is a ValueError.
    """
    source = Unpacked(path)
    names: list[str] = []
    lost = False
    offset = 0
    try:
        while True:
            offset = source.offset
            line = source.line()
            if line is None:
                return
            if not line.strip():
                continue  # some writers leave more newlines between records than they should
            text = line.decode("utf-8", "replace").rstrip("\r")
            if not names:
                declared = text.rsplit(" ", 1)[-1]
                block = source.take(int(declared)) if declared.isascii() and declared.isdigit() else b""
                head = block.decode("utf-8", "replace").split()
                version = int(head[0]) if head and head[0].isascii() and head[0].isdigit() else None
                if version not in FIELDS:
                    raise ValueError(f"ARC version {version} is unknown")
                names = FIELDS[version].split()
            parts = text.rsplit(" ", len(names) - 1)
            fields = dict(zip(names, parts))
            if len(parts) != len(names) or not (fields["Archive-length"].isascii() and fields["Archive-length"].isdigit() and fields["Archive-date"].isdigit()):
                if bad is None:
                    raise ValueError(f"the header line at {offset} has {len(parts)} fields, not {len(names)}, or no length")
                if not lost:
                    bad(offset, "no header line")
                lost = True
                continue
            lost = False
            if offset:
                block = source.take(int(fields["Archive-length"]))
            yield offset, fields, block
    except (ValueError, zlib.error) as e:
        if bad is None:
            raise
        bad(offset, str(e)[:200])
    finally:
        source.close()


def http_payload(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """(headers, payload) of an HTTP response, else None."""
    if not block.startswith(b"HTTP/"):
        return None
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


# ---------------------------------------------------------------- WARC


def iso(date: str) -> str:
    """An Archive-date, of 14 digits or fewer, as a WARC-Date."""
    digits = (date + "19960101000000"[len(date) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(name: str, offset: int, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset} {url}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def converted(name: str, offset: int, fields: dict[str, str], block: bytes, first: dict | None) -> bytes:
    """The WARC record of one ARC record; ``first`` tells the record that a revisit refers to."""
    url, kind = fields["URL"], fields["Content-type"]
    http = http_payload(block)
    whole = hashlib.sha256(block).hexdigest()
    headers = [("WARC-Record-ID", record_id(name, offset, url)), ("WARC-Date", iso(fields["Archive-date"]))]
    if offset == 0:
        return warc_record([("WARC-Type", "warcinfo"), *headers, ("WARC-Filename", name), ("WARC-Block-Digest", f"sha256:{whole}"), ("Content-Type", "application/warc-fields")], block)
    headers += [("WARC-Target-URI", url), ("WARC-IP-Address", fields["IP-address"])]
    if http is None:
        return warc_record([("WARC-Type", "resource"), *headers, ("WARC-Block-Digest", f"sha256:{whole}"), ("Content-Type", kind)], block)
    payload = ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(http[1]).hexdigest()}")
    form = ("Content-Type", "application/http; msgtype=response")
    if first is None:
        return warc_record([("WARC-Type", "response"), *headers, payload, ("WARC-Block-Digest", f"sha256:{whole}"), form], block)
    head = block[: len(block) - len(http[1])]
    headers += [
        payload,
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(head).hexdigest()}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", first["id"]),
        ("WARC-Refers-To-Target-URI", first["url"]),
        ("WARC-Refers-To-Date", first["date"]),
        form,
    ]
    return warc_record([("WARC-Type", "revisit"), *headers], head)


def read_warc(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record."""
    source = Unpacked(path)
    try:
        while (line := source.line()) is not None:
            line = line.rstrip(b"\r")
            if not line:
                continue
            if not re.fullmatch(rb"WARC/\d+\.\d+", line):
                raise ValueError(f"no record starts before {source.offset}")
            headers: dict[str, str] = {}
            while line := (source.line() or b"").rstrip(b"\r"):
                k, _, v = line.decode().partition(":")
                headers[k.strip().lower()] = v.strip()
            yield headers, source.take(int(headers["content-length"]))
    finally:
        source.close()


# ---------------------------------------------------------------- jobs

FILES = "name string, path string, n_records long"
INDEX = "name string, path string, offset long, key long, url string, date string, record string, digest string, n_bytes long"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])


def _quoted(url) -> str:
    if not isinstance(url, str) or not url:
        return "about:blank"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Pages as ARC files, of version 1 and 2 by turns; one row per file: name, path, n_records."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place, out, raw, name, version = TaskContext.get().partitionId(), 0, None, 0, "", 1
        for f in frames:
            done = []
            for k, u, page in zip(f["key"], f["url"], f["html"]):
                if out is None:
                    version = 1 + (part + place) % 2
                    name = f"pages-{part:05d}-{place:05d}.arc.gz"
                    out = Members(folder, name)
                    first = arc_version_block(name, FIRST_DAY.strftime("%Y%m%d%H%M%S"), version)
                    out.add(first)
                    raw = len(first)
                payload = page.encode() if isinstance(page, str) else b""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{KEY_HEADER}: {'' if k == NO_ID else k}\r\n\r\n".encode()
                date = (FIRST_DAY + timedelta(seconds=(0 if k == NO_ID else abs(k)) % (30 * 365 * 86400))).strftime("%Y%m%d%H%M%S")
                data = arc_record(_quoted(u), date, "text/html", head + payload, version, name, raw)
                out.add(data)
                raw += len(data)
                if out.records > file_records or out.size >= file_bytes:
                    out.close()
                    done.append((name, out.path, out.records - 1))
                    out, place = None, place + 1
            yield _frame(done, FILES)
        if out:
            out.close()
            yield _frame([(name, out.path, out.records - 1)], FILES)

    own = pages.select(boxed(F.col(f"`{key}`")).alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return cut(own.mapInPandas(run, FILES))


def _each(files: DataFrame, *also: str) -> DataFrame:
    """One task per file, at most."""
    n = max(1, files.count())
    return files.select("name", "path", *also).repartition(n, "path")


def index_arc(files: DataFrame) -> DataFrame:
    """One row per HTTP response of ARC files: where it is, its key, and its payload's digest and size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, path in zip(f["name"], f["path"]):
                rows = []
                for offset, fields, block in read_arc(path, _skip):
                    http = http_payload(block)
                    if offset and http:
                        k = http[0].get(KEY_HEADER.lower(), "")
                        rows.append((name, path, offset, int(k) if k else NO_ID, fields["URL"], iso(fields["Archive-date"]), record_id(name, offset, fields["URL"]), hashlib.sha256(http[1]).hexdigest(), len(http[1])))
                    if len(rows) == 10_000:
                        yield _frame(rows, INDEX)
                        rows = []
                yield _frame(rows, INDEX)

    return _each(files).mapInPandas(run, INDEX).withColumn("key", unboxed(F.col("key")))


def _skip(offset: int, reason: str) -> None:
    """Damaged places are passed over; ``damage`` lists them."""


def damage(files: DataFrame) -> DataFrame:
    """The damaged places of ARC files, (name, offset, reason): what conversion leaves out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple] = []
            for name, path in zip(f["name"], f["path"]):
                for _ in read_arc(path, lambda offset, reason, name=name: rows.append((name, offset, reason))):
                    pass
            yield pd.DataFrame(rows, columns=["name", "offset", "reason"])

    return _each(files).mapInPandas(run, "name string, offset long, reason string")


def convert(files: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """ARC files to WARC files, one for one; one row per file: name, path, n_records."""
    rows = cut(index_arc(files))
    place = F.struct(F.isnull("key").alias("none"), "key", "name", "offset", F.col("record").alias("id"), "url", "date")
    big = rows.where(F.col("n_bytes") >= least)
    # equal payloads meet as one row per task and digest
    first = cut(big.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    again = big.join(first, "digest").where((F.col("record") != F.col("first.id")))
    # a file has a bounded number of records
    told = again.groupBy("path").agg(F.collect_list(F.struct("offset", "first.id", "first.url", "first.date")).alias("again"))
    work = files.select("name", "path").join(told, "path", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, path, refs in zip(f["name"], f["path"], f["again"]):
                known = {r["offset"]: r for r in refs} if refs is not None else {}
                out = Members(folder, name.replace(".arc", ".warc"))
                for offset, fields, block in read_arc(path, _skip):
                    out.add(converted(name, offset, fields, block, known.get(offset)))
                out.close()
                yield _frame([(name.replace(".arc", ".warc"), out.path, out.records - 1)], FILES)

    n = max(1, files.count())
    return cut(work.repartition(n, "path").mapInPandas(run, FILES))


RECORDS = "key long, record string, type string, url string, date string, digest string, refers string, n_bytes long, checked boolean"


def read_back(files: DataFrame) -> DataFrame:
    """One row per response, revisit and resource of WARC files. ``checked``: the payload at hand has the digest its header states."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path in f["path"]:
                rows = []
                for h, block in read_warc(path):
                    kind = h["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http = http_payload(block)
                    headers, payload = http if http else ({}, block)
                    k = headers.get(KEY_HEADER.lower(), "")
                    own = hashlib.sha256(payload).hexdigest()
                    stated = h.get("warc-payload-digest", f"sha256:{own}").removeprefix("sha256:")
                    size = len(payload) if kind != "revisit" else None
                    rows.append((int(k) if k else NO_ID, h["warc-record-id"], kind, h["warc-target-uri"], h["warc-date"], stated, h.get("warc-refers-to"), size, kind == "revisit" or own == stated))
                    if len(rows) == 10_000:
                        yield _frame(rows, RECORDS).astype({"n_bytes": "Int64"})
                        rows = []
                yield _frame(rows, RECORDS).astype({"n_bytes": "Int64"})

    return _each(files).mapInPandas(run, RECORDS).withColumn("key", unboxed(F.col("key")))


def resolved(files: DataFrame) -> DataFrame:
    """One row per page record of WARC files, revisits with the size of the payload they refer to: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    rows = cut(read_back(files))
    referred = rows.where("type = 'revisit'").select(F.col("refers").alias("wanted")).distinct()
    # an aggregate before the join, cut so that a payload met very often can be split
    whole = cut(
        rows.where("type = 'response'")
        .join(referred, F.col("record") == F.col("wanted"), "left_semi")
        .select(F.col("record").alias("first"), F.col("key").alias("first_key"), F.col("n_bytes").alias("first_bytes"), F.col("digest").alias("first_digest"))
    )
    joined = rows.join(whole, F.col("refers") == F.col("first"), "left")
    sound = F.col("checked") & ((F.col("type") != "revisit") | F.col("digest").eqNullSafe(F.col("first_digest")))
    return joined.select(
        F.col("key").alias("page_id"),
        F.coalesce("n_bytes", "first_bytes").alias("payload_bytes"),
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("first_key").alias("refers_to"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    return resolved(convert(write_arc(scan(spark, sf_dir, "pages"), f"{folder}/arc"), f"{folder}/warc"))


QUERIES = {"op4_archives": query}

ORACLES = {
    "op4_archives": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
        FROM f
    """
}
