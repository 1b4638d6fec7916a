"""S1, splittable: block files as a PySpark data source whose partitions are byte ranges of files.

A range owns the blocks that start in it. Nothing marks block starts but the blocks before them, so a
range other than a file's first begins at the first place in it where a whole, well-formed block stands
(magic, size and contents hold), and ends at the first such place at or after its end: damage belongs to
the range before it. That guess can only be wrong if a block has a whole block inside of it, as data of
a script. Every range therefore reports where it began and ended; ``scan_ranges`` checks that each
file's ranges join up, and reads those again that don't, from where the range before them ended. What
comes out is what one pass over each file gives, for every size of the ranges, damage included.

Options: ``path``, ``glob``, ``rangeBytes``, ``scripts`` (``all``, ``outputs`` or ``none``: what is left out
is null), ``magic`` (hex), ``only`` (JSON list of [path, start, entry]: just these ranges).

The same format is a stream source. Its offsets are (file, byte): how far a file consists of whole
blocks, junk between them included, found by stepping from size to size. A cut-off last block and zero
padding are no progress; when the file has grown, or its padding was overwritten, reading goes on there.

Files are read through ``pyarrow.fs`` (local paths, S3, HDFS, GCS); for other file systems
``blockfile.scan_block_files`` reads whole files through Spark.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ledgergraph.session import staged
from ledgergraph.sources.blockfile import (MAINNET_MAGIC, SCAN, DamagedBlockFile, block_end, damage_of, gap, holds_block,
                                           parse_source, scan_block_files)

RANGE_BYTES = 64 << 20
READ_BYTES = 8 << 20
#: reason of the row with which a range reports its beginning and length
RANGE = "range"
RANGED = T.StructType([*SCAN.fields, T.StructField("range", T.LongType())])


class FileBytes:
    """The bytes of a stored file, read a few megabytes at a time."""

    def __init__(self, uri: str, size: int | None = None, least: int = READ_BYTES):
        fs, path = open_path(uri)
        self.size = fs.get_file_info(path).size if size is None else size
        self.least, self.at, self.held, self.file = least, 0, b"", fs.open_input_file(path)

    def get(self, start: int, stop: int) -> bytes:
        stop = min(stop, self.size)
        if start < self.at or stop > self.at + len(self.held):
            self.held = self.file.read_at(min(max(stop - start, self.least), self.size - start), start)
            self.at = start
        return self.held[start - self.at:stop - self.at]

    def close(self) -> None:
        self.file.close()


def open_path(uri: str):
    """(file system, path in it)."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def reachable(uri: str) -> bool:
    """Whether ``pyarrow.fs`` knows the file system."""
    try:
        open_path(uri)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def list_files(uri: str, glob: str) -> list[tuple[str, int]]:
    """(path, size) of the files below ``uri`` whose name matches, in order of path."""
    from pyarrow import fs as pafs
    fs, path = open_path(uri)
    infos = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)) \
        if fs.get_file_info(path).type != pafs.FileType.File else [fs.get_file_info(path)]
    head = uri[:uri.index(path)] if path in uri else ""
    return sorted((head + i.path, i.size) for i in infos
                  if i.type == pafs.FileType.File and fnmatch.fnmatch(posixpath.basename(i.path), glob))


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    stop: int
    entry: int      # where reading begins, or -1: to be found


def _first_block(src, start: int, stop: int, magic: bytes) -> int:
    """The first place from ``start`` up to ``stop`` where a block stands, or ``stop``."""
    pos = start
    while 0 <= (pos := gap(Window_(src, stop + len(magic) - 1), pos, magic)[0]) < stop:
        if holds_block(src, pos, magic):
            return pos
        pos += len(magic)
    return stop


class Window_:
    """A source of bytes that ends early."""

    def __init__(self, src, size: int):
        self.src, self.size = src, min(size, src.size)

    def get(self, start: int, stop: int) -> bytes:
        return self.src.get(start, min(stop, self.size))


def _settings(options) -> tuple[str, str, bytes, str, int]:
    return (options["path"], options.get("glob", "blk*.dat"), bytes.fromhex(options.get("magic", MAINNET_MAGIC.hex())),
            options.get("scripts", "all"), int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES))))


def _with_range(batch: pa.RecordBatch, start: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array([start] * batch.num_rows, pa.int64())],
                                      names=[*batch.schema.names, "range"])


def _report(part: Range, entry: int, ended: int, like: pa.Schema) -> pa.RecordBatch:
    row = {"file": part.path, "offset": entry, "length": ended - entry, "reason": RANGE, "range": part.start}
    return pa.RecordBatch.from_pylist([row], schema=like)


def _arrow_schema() -> pa.Schema:
    from ledgergraph.sources.blockfile import _ARROW_SCHEMA
    return _ARROW_SCHEMA.append(pa.field("range", pa.int64()))


class RangeReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob, self.magic, self.scripts, self.bytes = _settings(options)
        self.only = {(p, s): e for p, s, e in json.loads(options.get("only", "[]"))}

    def partitions(self) -> list[Range]:
        out = []
        for path, size in list_files(self.path, self.glob):
            for start in range(0, max(size, 1), self.bytes):
                if not self.only or (path, start) in self.only:
                    entry = self.only.get((path, start), 0 if start == 0 else -1)
                    out.append(Range(path, size, start, min(start + self.bytes, size), entry))
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        src = FileBytes(part.path, part.size, min(READ_BYTES, max(self.bytes, 1 << 16)))
        try:
            entry = part.entry if part.entry >= 0 else _first_block(src, part.start, part.stop, self.magic)
            if part.entry < 0 and entry == part.stop:
                return                                  # no block starts here
            batches, ended = parse_source(src, part.path, self.magic, entry, part.stop, self.scripts), entry
            while True:
                try:
                    yield _with_range(next(batches), part.start)
                except StopIteration as end:
                    ended = end.value
                    break
            yield _report(part, entry, ended, _arrow_schema())
        finally:
            src.close()


# ---- streams --------------------------------------------------------------------------------------

def frontier(src, start: int, magic: bytes) -> int:
    """How far a file consists of whole blocks and what stands between them, from ``start`` on: its blocks
    are stepped over by their sizes, and parsed only where a size leads to no next block."""
    pos, done = start, start
    while pos < src.size:
        if src.get(pos, pos + len(magic)) != magic:
            follow = gap(src, pos, magic)[0]
            if follow < 0:
                break
            pos = follow
            continue
        end = block_end(src, pos)
        nice = end <= src.size and (end == src.size or src.get(end, end + 4) in (magic, bytes(4)))
        if nice or holds_block(src, pos, magic):
            pos = done = end
        else:
            follow = gap(src, pos + len(magic), magic)[0]
            if follow < 0:
                break
            pos = follow
    return done


@dataclass
class Growth(InputPartition):
    path: str
    start: int
    stop: int


class GrowthReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.glob, self.magic, self.scripts, self.bytes = _settings(options)
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for path, size in list_files(self.path, self.glob):
            start = min(self.seen.get(path, 0), size)
            src = FileBytes(path, size, 1 << 16)
            out[path] = frontier(src, start, self.magic)
            src.close()
        self.seen = out
        return {p: n for p, n in out.items() if n}

    def partitions(self, start: dict, end: dict) -> list[Growth]:
        self.seen = {**self.seen, **end}
        return [Growth(p, start.get(p, 0), n) for p, n in sorted(end.items()) if n > start.get(p, 0)]

    def read(self, part: Growth) -> Iterator[pa.RecordBatch]:
        src = FileBytes(part.path, part.stop)
        try:
            for batch in parse_source(src, part.path, self.magic, part.start, None, self.scripts):
                yield _with_range(batch, part.start)
        finally:
            src.close()


class BlockFiles(DataSource):
    """``spark.read.format("blockfiles")`` and ``spark.readStream.format("blockfiles")``."""

    @classmethod
    def name(cls) -> str:
        return "blockfiles"

    def schema(self) -> T.StructType:
        return RANGED

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)

    def streamReader(self, schema) -> GrowthReader:
        return GrowthReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BlockFiles)


def _load(spark: SparkSession, path: str, glob: str, magic: bytes, scripts: str, range_bytes: int, only: list | None = None) -> DataFrame:
    reader = (spark.read.format("blockfiles").option("path", path).option("glob", glob).option("magic", magic.hex())
              .option("scripts", scripts).option("rangeBytes", str(range_bytes)))
    return (reader.option("only", json.dumps(only)) if only else reader).load()


def misread(rows: DataFrame, range_bytes: int, sizes: DataFrame) -> DataFrame:
    """(file, range, entry, wrong): where a file's ranges do not join up first: ``range`` has to be read from
    ``entry`` on; ``wrong`` is the range that began elsewhere."""
    marks = rows.filter(F.col("reason") == RANGE).select("file", "range", F.col("offset").alias("entry"),
                                                        (F.col("offset") + F.col("length")).alias("ended"))
    after = Window.partitionBy("file").orderBy("range")     # the ranges of one file that have blocks
    joined = (marks.join(sizes, "file")
              .withColumn("next", F.coalesce(F.lead("entry").over(after), F.col("size")))
              .withColumn("wrong", F.lead("range").over(after)))
    return (joined.filter("next != ended")
            .groupBy("file").agg(F.min(F.struct("range", "ended", "wrong")).alias("b"))
            .select("file", (F.floor(F.col("b.ended") / range_bytes) * range_bytes).cast("long").alias("range"),
                    F.col("b.ended").alias("entry"), F.col("b.wrong").alias("wrong")))


def scan_ranges(spark: SparkSession, path: str, glob: str = "blk*.dat", magic: bytes = MAINNET_MAGIC,
                scripts: str = "all", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """S1 with rejects, several tasks a file: (file, block, transactions, offset, length, reason), staged."""
    register(spark)
    rows = staged(_load(spark, path, glob, magic, scripts, range_bytes), "lg_ranges")
    sizes = spark.createDataFrame(list_files(path, glob) or [("", 0)], "file string, size long")
    while bad := misread(rows, range_bytes, sizes).collect():    # a block within a block at a range's edge: rare
        again = _load(spark, path, glob, magic, scripts, range_bytes, [[b["file"], b["range"], b["entry"]] for b in bad])
        # a range between the two has no block of its own
        out = spark.createDataFrame([(b["file"], r) for b in bad for r in {b["range"], b["wrong"]} if r is not None and r <= b["range"]],
                                    "file string, range long")
        rows = staged(rows.join(out, ["file", "range"], "left_anti").select(*RANGED.names).unionByName(again), "lg_ranges")
    return rows.filter(F.col("reason").isNull() | (F.col("reason") != RANGE)).drop("range")


def scan_blocks(spark: SparkSession, path: str, glob: str = "blk*.dat", scripts: str = "outputs",
                range_bytes: int = RANGE_BYTES, on_damage: str = "fail") -> tuple[DataFrame, int]:
    """A staged scan with rejects, as ranges wherever Python reaches the file system, and the number of damaged
    places in it; unless ``on_damage`` is "keep", damage is an error."""
    if on_damage not in ("fail", "keep"):
        raise ValueError(f"unknown on_damage {on_damage!r}")
    if reachable(path):
        scan = scan_ranges(spark, path, glob, scripts=scripts, range_bytes=range_bytes)
    else:
        scan = staged(scan_block_files(spark, path, glob), "lg_scan")
    damaged = damage_of(scan).count()
    if damaged and on_damage != "keep":
        first = damage_of(scan).orderBy("file", "offset").first()
        raise DamagedBlockFile(f"{damaged} damaged places, the first in {first.file}: {first.reason}, {first.length} bytes "
                               f"at {first.offset}; on_damage='keep' reads the blocks around them")
    return scan, damaged
