"""WARC records in ZIP packages: a writer, and a reader that never extracts.

A package is a ZIP archive whose members are stored, not deflated: ``archive/data.warc.gz`` (one gzip
member per record) and ``indexes/index.cdxj`` (one line per record: key, offset, length). The
reader finds the end-of-central-directory record, follows ZIP64 locators and extra fields, locates
the stored members by their local headers, and reads single records by byte range.

On Spark: pages that share a payload are found on digests, with salted counts, so a payload that
a third of all pages have is no hot key; every task writes packages of about ``package_bytes`` into the
shared checkpoint folder, under names no other attempt uses, and returns their paths, so that a lost
executor leaves at most an unread file. Packages are read back in two steps: indexes, then records
in ranges spread over all tasks. No page passes through the driver.

Files are opened with ``pyarrow.fs``, so any folder URI that it knows serves (local, HDFS, S3).

Defined results: a null html is the empty payload; pages of null ids rank below all others and are
written with an empty id; rows repeated with the winning id are all responses; an empty table gives
no rows and no package; a null url is written as ``urn:none``, and control characters of a url are
percent-encoded in the archive; extra columns never clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read, text_or_empty
from ledgergraph.session import scratch_folder, staged

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"

# ZIP signatures and fixed record layouts (fixed values of the format)
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# ---- ZIP ---------------------------------------------------------------------------------------

class PackageWriter:
    """Writes stored members one after another into a ZIP; ``zip64`` forces the 64-bit fields."""

    def __init__(self, out: BinaryIO, zip64: bool = False):
        self.out, self.at, self.zip64, self.members = out, 0, zip64, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, data: bytes) -> None:
        self.member_of(name, iter([data]), len(data), zlib.crc32(data))

    def member_of(self, name: str, parts: Iterator[bytes], size: int, crc: int) -> None:
        start, raw, big = self.at, name.encode(), self.zip64 or size >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        shown = FULL32 if big else size
        self._write(LOCAL + struct.pack("<HHHHHIIIHH", 45 if big else 20, 0x800, 0, 0, 0x21, crc, shown, shown,
                                        len(raw), len(extra)) + raw + extra)
        for part in parts:
            self._write(part)
        self.members.append((raw, start, size, crc, big))

    def close(self) -> None:
        start = self.at
        for raw, at, size, crc, big in self.members:
            big = big or at >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
            shown, place = (FULL32, FULL32) if big else (size, at)
            self._write(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, shown,
                                              shown, len(raw), len(extra), 0, 0, 0, 0, place) + raw + extra)
        size, n = self.at - start, len(self.members)
        big = self.zip64 or start >= FULL32 or n >= FULL16
        if big:
            end64 = self.at
            self._write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._write(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self._write(END + struct.pack("<HHHHIIH", 0, 0, FULL16 if big else n, FULL16 if big else n,
                                      FULL32 if big else size, FULL32 if big else start, 0))


def read_range(f: BinaryIO, at: int, size: int) -> bytes:
    f.seek(at)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"the package ends inside a range of {size} bytes at {at}")
    return data


def members(f: BinaryIO, size: int) -> dict[str, tuple[int, int]]:
    """{name: (offset of its data, size)} of the stored members of a ZIP of ``size`` bytes.

    Raises ValueError where the file is no ZIP or a member is compressed or encrypted."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read_range(f, tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0 or len(tail) - end < 22:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
    if n == FULL16 or length == FULL32 or start == FULL32:
        locator = read_range(f, tail_at + end - 20, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = read_range(f, struct.unpack("<Q", locator[8:16])[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        n, length, start = struct.unpack("<QQQ", end64[32:56])
    directory, at, found = read_range(f, start, length), 0, {}
    for _ in range(n):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<HH", directory[at + 8:at + 12])
        packed, plain, names, extras, notes = struct.unpack("<IIHHH", directory[at + 20:at + 34])
        place = struct.unpack("<I", directory[at + 42:at + 46])[0]
        name = directory[at + 46:at + 46 + names].decode("utf-8")
        extra = directory[at + 46 + names:at + 46 + names + extras]
        at += 46 + names + extras + notes
        while len(extra) >= 4:
            kind, size_of = struct.unpack("<HH", extra[:4])
            if kind == 1:         # only the fields that are full in the directory, in this order
                wide = iter(struct.unpack(f"<{size_of // 8}Q", extra[4:4 + size_of // 8 * 8]))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                place = next(wide) if place == FULL32 else place
            extra = extra[4 + size_of:]
        if method or flags & 1:
            raise ValueError(f"{name} is not stored plainly")
        local = read_range(f, place, 30)
        if local[:4] != LOCAL:
            raise ValueError("damaged local header")
        names, extras = struct.unpack("<HH", local[26:30])
        found[name] = (place + 30 + names + extras, packed)
    return found


# ---- records -----------------------------------------------------------------------------------

def record(kind: str, page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit holds the HTTP header alone, with the length of the payload."""
    url = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Target-URI", url or "urn:none"),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if kind == "revisit":
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    else:
        block += payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC header, HTTP header, body) of one record; header names in lower case."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    said = {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])}
    return fields, said, body


def _open(uri: str):
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
    return store, path


# ---- Spark -------------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest`` (SHA-1), ``kind`` and ``refers_to``."""
    salts = max(2, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    body = text_or_empty("html")
    pages = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"),
                         F.octet_length(body).alias("n"))
    # pages too short to be revisited take no part: a key of their own each
    pages = (pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)))
             .withColumn("group", F.when(F.col("n") >= least, F.col("digest"))))
    across = Window.partitionBy("group", "n")
    newest = (pages.filter("group IS NOT NULL").groupBy("group", "n", "salt").agg(F.max("page_id").alias("newest"))
              .select("group", "n", "salt", F.max("newest").over(across).alias("newest")))
    joined = pages.filter("group IS NOT NULL").join(newest, ["group", "n", "salt"])
    alone = pages.filter("group IS NULL").withColumn("newest", F.col("page_id"))
    kind = F.when(F.col("page_id").eqNullSafe(F.col("newest")), "response").otherwise("revisit")
    return (joined.unionByName(alone)
            .select("page_id", "url", "html", "digest", kind.alias("kind"),
                    F.when(kind == "revisit", F.col("newest")).alias("refers_to")))


def write_packages(pages: DataFrame, folder: str, package_bytes: int = 64 << 20) -> DataFrame:
    """Write ``pages`` (as of ``with_revisits``) into packages under ``folder``; (path, size, records) of
    each. A package holds its records in memory until it is closed, ``package_bytes`` at most
    and one record more."""
    def written(batches):
        store, path = _open(folder)
        store.create_dir(path, recursive=True)
        data, index, size = [], [], 0

        def close():
            name = f"{path}/{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(name) as out:
                package, crc = PackageWriter(out), 0
                for part in data:
                    crc = zlib.crc32(part, crc)
                package.member_of(DATA, iter(data), size, crc)
                package.member(INDEX, "".join(index).encode("utf-8", "surrogatepass"))
                package.close()
                return pd.DataFrame({"path": [name], "size": [package.at], "records": [len(index)]})

        for pdf in batches:
            for page_id, url, html, digest, kind, refers_to in pdf.itertuples(index=False):
                page_id, url = page_id or "", url or ""
                raw = record(kind, page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                packed = gzip.compress(raw, 6, mtime=0)
                line = {"url": url, "offset": str(size), "length": str(len(packed)), "id": page_id}
                index.append(f"{page_id} 19700101000000 {json.dumps(line)}\n")
                data.append(packed)
                size += len(packed)
                if size >= package_bytes:
                    yield close()
                    data, index, size = [], [], 0
        if data:
            yield close()

    text = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), "html", "digest", "kind",
                        F.col("refers_to").cast("string"))
    # the manifest is kept: packages that a failed attempt left behind are in no manifest
    return staged(text.mapInPandas(written, "path string, size long, records long"), "packages")


def read_packages(packages: DataFrame, folder: str, run_bytes: int = 4 << 20) -> DataFrame:
    """The records of ``packages`` (path, size): page_id, url, record_type, payload_bytes, payload_digest, refers_to
    and the payload (null in revisits). Indexes are read first; then runs of neighbouring records, about
    ``run_bytes`` each, are read by range and spread over all tasks."""
    def located(batches):
        store, _ = _open(folder)
        for pdf in batches:
            for path, size in zip(pdf["path"], pdf["size"]):
                with store.open_input_file(path) as f:
                    found = members(f, size)
                    data_at, _ = found[DATA]
                    lines = read_range(f, *found[INDEX]).decode("utf-8", "surrogatepass").split("\n")
                runs, begin, sizes = [], None, []
                for line in lines:
                    if not line:
                        continue
                    at = json.loads(line[line.index("{"):])
                    offset, length = int(at["offset"]), int(at["length"])
                    if begin is None or begin + sum(sizes) != offset:     # a gap in the index ends a run
                        begin, sizes = offset, []
                        runs.append((path, data_at + begin, sizes))
                    sizes.append(length)
                    if offset + length - begin >= run_bytes:
                        begin = None
                yield pd.DataFrame(runs, columns=["path", "at", "lengths"])

    def loaded(batches):
        store, _ = _open(folder)
        for pdf in batches:
            for path, at, lengths in pdf.itertuples(index=False):
                with store.open_input_file(path) as f:
                    data = memoryview(read_range(f, at, int(sum(lengths))))
                rows, done = [], 0
                for length in lengths:
                    fields, http, body = parse(gzip.decompress(data[done:done + length]))
                    done += int(length)
                    revisit = fields["warc-type"] == "revisit"
                    said = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if not revisit and hashlib.sha1(body).hexdigest() != said:
                        raise ValueError(f"damaged payload in {path}")
                    rows.append((_id(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"],
                                 int(http["content-length"]), said, _id(fields.get("warc-refers-to")),
                                 None if revisit else body))
                yield pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload_bytes", "payload_digest",
                                                  "refers_to", "payload"])

    spread = max(2, int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = packages.select("path", "size").repartition(spread, "path").mapInPandas(
        located, "path string, at long, lengths array<long>")
    found = runs.repartition(spread, "path", "at").mapInPandas(
        loaded, "page_id string, url string, record_type string, payload_bytes long, payload_digest string, "
                "refers_to string, payload binary")
    return found.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))


def _id(urn: str | None) -> str | None:
    return urn[len("<urn:page:"):-1] or None if urn else None


def archive(pages: DataFrame, package_bytes: int = 64 << 20) -> tuple[DataFrame, str]:
    """Write ``pages`` (page_id, url, html); (manifest of packages, their folder)."""
    folder = scratch_folder(pages.sparkSession, "wacz")
    return write_packages(with_revisits(pages), folder, package_bytes), folder


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM q
"""


def query(spark, sf_dir):
    """op8: every page, written to packages and read back."""
    packages, folder = archive(pick(read(spark, sf_dir, "pages"), ["page_id", "url", "html"]))
    return read_packages(packages, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
