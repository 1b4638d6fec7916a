"""Block-file ingest.

``spark.read.format("binaryFile")`` lists the ``blk*.dat`` files (one row per file, files spread
over tasks); ``mapInArrow`` parses each file's bytes into one row per block with its
transactions nested (the "nested ingest frame"); ``explode``/``posexplode``/``inline`` then
flatten it into the four ledger tables. Parsing is the only Python step and runs per file in
parallel; hashing of headers and transactions uses ``hashlib`` on the exact serialised bytes.

File layout: repeated ``magic (4) | size (4, LE) | block (size bytes)``. No byte is passed over in
silence: whatever is not a whole, well-formed block becomes a reject row (file, offset, length,
reason), and parsing goes on at the next magic. Reasons: ``junk`` (foreign bytes between blocks),
``malformed`` (a block whose transactions do not fill it exactly), ``oversized`` (a size that runs
past the end of the file although another block follows), ``tail`` (the last block is cut off: the file
is still being written) and ``padding`` (zeros up to the end: a pre-allocated file). The first three
are damage; readers fail on them unless told to go on (``on_damage="keep"``).
Transactions may carry the segregated-witness marker; the txid hashes the stripped form.
Hashes are shown the customary way: double SHA-256, byte-reversed, upper-case hex.

The parser appends straight into flat columns and assembles the nested Arrow arrays from
offsets (about 60 MB/s per core including the Arrow batch, measured on a 50 MB file), so a
~130 MB block file is one task of a few seconds; files spread over all executors.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgergraph.functions.script import with_address
from ledgergraph.schemas import Ledger

# fixed values: the main-network block-file magic
MAINNET_MAGIC = bytes.fromhex("F9BEB4D9")

INPUT_T = T.StructType([
    T.StructField("ref_hash", T.StringType()),
    T.StructField("ref_ord", T.LongType()),
    T.StructField("script_sig", T.BinaryType()),
])
OUTPUT_T = T.StructType([
    T.StructField("value", T.LongType()),
    T.StructField("script", T.BinaryType()),
])
TX_T = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("inputs", T.ArrayType(INPUT_T)),
    T.StructField("outputs", T.ArrayType(OUTPUT_T)),
])
BLOCK_T = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("prev_hash", T.StringType()),
    T.StructField("time", T.IntegerType()),
])
NESTED = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", BLOCK_T),
    T.StructField("transactions", T.ArrayType(TX_T)),
])
# a scan has the blocks and, with a reason and without a block, the rejects
SCAN = T.StructType(NESTED.fields + [
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("reason", T.StringType()),
])
DAMAGE = ("junk", "malformed", "oversized")
BATCH_BLOCKS, BATCH_BYTES = 256, 16 << 20
GAP_BYTES = 1 << 20
#: a block that claims more is malformed and never read whole
MOST_BLOCK_BYTES = 64 << 20

_ARROW_INPUT = pa.struct([("ref_hash", pa.string()), ("ref_ord", pa.int64()), ("script_sig", pa.binary())])
_ARROW_OUTPUT = pa.struct([("value", pa.int64()), ("script", pa.binary())])
_ARROW_TX = pa.struct([("hash", pa.string()), ("inputs", pa.list_(_ARROW_INPUT)),
                       ("outputs", pa.list_(_ARROW_OUTPUT))])
_ARROW_SCHEMA = pa.schema([
    ("file", pa.string()),
    ("block", pa.struct([("hash", pa.string()), ("prev_hash", pa.string()), ("time", pa.int32())])),
    ("transactions", pa.list_(_ARROW_TX)),
    ("offset", pa.int64()),
    ("length", pa.int64()),
    ("reason", pa.string()),
])


def _dsha(b: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(b).digest()).digest()


def _display(h: bytes) -> str:
    return h[::-1].hex().upper()


_U32 = struct.Struct("<I").unpack_from
_I64 = struct.Struct("<q").unpack_from


def _varint(b: bytes, pos: int) -> tuple[int, int]:
    first = b[pos]
    if first < 0xFD:
        return first, pos + 1
    size = 2 if first == 0xFD else 4 if first == 0xFE else 8
    if pos + 1 + size > len(b):
        raise ValueError("truncated")
    return int.from_bytes(b[pos + 1:pos + 1 + size], "little"), pos + 1 + size


class _Columns:
    """Flat columns of parsed blocks; the nested Arrow arrays are assembled from offsets, so no
    per-row Python objects are built."""

    def __init__(self):
        self.file, self.bhash, self.bprev, self.btime = [], [], [], []
        self.offset, self.length, self.reason = [], [], []
        self.tx_off, self.thash = [0], []
        self.in_off, self.iref, self.iord, self.isig = [0], [], [], []
        self.out_off, self.oval, self.oscr = [0], [], []

    def add_block(self, path, bhash, bprev, btime, blk: "_Columns") -> None:
        self.file.append(path)
        self.bhash.append(bhash)
        self.bprev.append(bprev)
        self.btime.append(btime)
        self.thash.extend(blk.thash)
        self.tx_off.append(self.tx_off[-1] + len(blk.thash))
        base_in, base_out = self.in_off[-1], self.out_off[-1]
        self.in_off.extend(base_in + o for o in blk.in_off[1:])
        self.out_off.extend(base_out + o for o in blk.out_off[1:])
        self.iref.extend(blk.iref)
        self.iord.extend(blk.iord)
        self.isig.extend(blk.isig)
        self.oval.extend(blk.oval)
        self.oscr.extend(blk.oscr)

    def add_reject(self, path: str, offset: int, length: int, reason: str) -> None:
        self.add_block(path, None, None, None, _Columns())
        self.at(offset, length, reason)

    def at(self, offset: int, length: int, reason: str | None = None) -> None:
        """Where the row added last stands in its file."""
        self.offset.append(offset)
        self.length.append(length)
        self.reason.append(reason)

    def batch(self) -> pa.RecordBatch:
        inputs = pa.StructArray.from_arrays(
            [pa.array(self.iref, pa.string()), pa.array(self.iord, pa.int64()),
             pa.array(self.isig, pa.binary())], fields=list(_ARROW_INPUT))
        outputs = pa.StructArray.from_arrays(
            [pa.array(self.oval, pa.int64()), pa.array(self.oscr, pa.binary())],
            fields=list(_ARROW_OUTPUT))
        txs = pa.StructArray.from_arrays(
            [pa.array(self.thash, pa.string()),
             pa.ListArray.from_arrays(pa.array(self.in_off, pa.int32()), inputs),
             pa.ListArray.from_arrays(pa.array(self.out_off, pa.int32()), outputs)],
            fields=list(_ARROW_TX))
        block = pa.StructArray.from_arrays(
            [pa.array(self.bhash, pa.string()), pa.array(self.bprev, pa.string()),
             pa.array(self.btime, pa.int32())], fields=list(_ARROW_SCHEMA.field("block").type),
            mask=pa.array([r is not None for r in self.reason], pa.bool_()))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.file, pa.string()), block,
             pa.ListArray.from_arrays(pa.array(self.tx_off, pa.int32()), txs),
             pa.array(self.offset, pa.int64()), pa.array(self.length, pa.int64()),
             pa.array(self.reason, pa.string())],
            schema=_ARROW_SCHEMA)


def _parse_tx(b: bytes, pos: int, c: _Columns, scripts: str = "all") -> int:
    """Parse one transaction at ``pos`` into ``c``; returns the position after it."""
    n = len(b)
    start = pos
    pos += 4                                            # version
    segwit = pos + 1 < n and b[pos] == 0 and b[pos + 1] == 1
    if segwit:
        pos += 2
    body_start = pos
    n_in, pos = _varint(b, pos)
    for _ in range(n_in):
        if pos + 36 > n:
            raise ValueError("truncated")
        c.iref.append(b[pos:pos + 32][::-1].hex().upper())
        c.iord.append(_U32(b, pos + 32)[0])
        size, pos = _varint(b, pos + 36)
        if pos + size + 4 > n:
            raise ValueError("truncated")
        c.isig.append(b[pos:pos + size] if scripts == "all" else None)
        pos += size + 4                                 # script, sequence
    n_out, pos = _varint(b, pos)
    for _ in range(n_out):
        c.oval.append(_I64(b, pos)[0])
        size, pos = _varint(b, pos + 8)
        if pos + size > n:
            raise ValueError("truncated")
        c.oscr.append(b[pos:pos + size] if scripts != "none" else None)
        pos += size
    body_end = pos
    if segwit:                                          # witness stacks, one per input
        for _ in range(n_in):
            items, pos = _varint(b, pos)
            for _ in range(items):
                size, pos = _varint(b, pos)
                pos += size
    if pos + 4 > n:
        raise ValueError("truncated")
    end = pos + 4                                       # locktime
    stripped = (b[start:start + 4] + b[body_start:body_end] + b[pos:end]) if segwit else b[start:end]
    c.thash.append(_display(_dsha(stripped)))
    c.in_off.append(c.in_off[-1] + n_in)
    c.out_off.append(c.out_off[-1] + n_out)
    return end


def _parse_block(block: bytes, path: str, cols: _Columns, scripts: str = "all") -> None:
    """Parse a whole block, then append it: a malformed block adds nothing."""
    if len(block) < 81:
        raise ValueError("truncated")
    blk = _Columns()
    n_tx, pos = _varint(block, 80)
    for _ in range(n_tx):
        pos = _parse_tx(block, pos, blk, scripts)
    if pos != len(block):
        raise ValueError("bytes after the last transaction")
    header = block[:80]
    time = _U32(header, 68)[0]
    if time >= 2 ** 31:
        time -= 2 ** 32                                 # INT column, as the converters store it
    cols.add_block(path, _display(_dsha(header)), _display(header[4:36]), time, blk)


class Bytes:
    """The bytes of a file that is in memory; other sources of bytes have the same two members."""

    def __init__(self, content: bytes | None):
        self.content = content or b""
        self.size = len(self.content)

    def get(self, start: int, stop: int) -> bytes:
        return self.content[start:stop]


def gap(src, pos: int, magic: bytes) -> tuple[int, int, int]:
    """(place of the next magic from ``pos`` on or -1, first and one past the last byte before it that is
    not zero, both -1 if there is none), a piece at a time."""
    first = last = -1
    while pos < src.size:
        piece = src.get(pos, min(pos + GAP_BYTES, src.size))
        at_end = pos + len(piece) >= src.size
        found = piece.find(magic)
        # a magic may begin in the last bytes of a piece
        stop = found if found >= 0 else len(piece) if at_end else len(piece) - len(magic) + 1
        body = piece[:stop]
        if left := len(body.lstrip(b"\0")):
            first = pos + len(body) - left if first < 0 else first
            last = pos + len(body.rstrip(b"\0"))
        if found >= 0:
            return pos + found, first, last
        if at_end:
            break
        pos += stop
    return -1, first, last


def block_end(src, pos: int) -> int:
    """Where the block at ``pos`` ends by its size; past the file if that can't be."""
    if pos + 8 > src.size:
        return src.size + 1
    return pos + 8 + _U32(src.get(pos + 4, pos + 8), 0)[0]


def holds_block(src, pos: int, magic: bytes) -> bool:
    """A whole, well-formed block starts at ``pos``."""
    if src.get(pos, pos + len(magic)) != magic or (end := block_end(src, pos)) > src.size or end - pos > MOST_BLOCK_BYTES:
        return False
    try:
        _parse_block(src.get(pos + 8, end), "", _Columns(), "none")
        return True
    except (ValueError, IndexError, struct.error):
        return False


def parse_source(src, path: str, magic: bytes, start: int, stop: int | None = None,
                 scripts: str = "all") -> Generator[pa.RecordBatch, None, int]:
    """The blocks and rejects from byte ``start`` on, a few hundred blocks at a time. With ``stop`` the first
    block that starts there or later is not read any more; damage before it is. Returns the place where
    reading ended."""
    cols, held, pos, n = _Columns(), 0, start, src.size
    while pos < n:
        if stop is not None and pos >= stop and holds_block(src, pos, magic):
            break
        if src.get(pos, pos + len(magic)) != magic:     # no block starts here
            follow, first, last = gap(src, pos, magic)
            end = n if follow < 0 else follow
            if follow < 0 and first < 0:
                cols.add_reject(path, pos, end - pos, "padding")
            elif follow < 0 and magic.startswith(src.get(pos, min(end, pos + len(magic)))):
                cols.add_reject(path, pos, end - pos, "tail")
            elif first >= 0:                            # zeros around foreign bytes are padding and no damage
                cols.add_reject(path, first, last - first, "junk")
                if follow < 0 and last < end:
                    cols.add_reject(path, last, end - last, "padding")
            pos = end
            continue
        end = block_end(src, pos)
        if end <= n:
            reason = "malformed"
            if end - pos <= MOST_BLOCK_BYTES:
                try:
                    _parse_block(src.get(pos + 8, end), path, cols, scripts)
                    cols.at(pos, end - pos)
                    held, pos = held + end - pos, end
                    if len(cols.file) >= BATCH_BLOCKS or held >= BATCH_BYTES:
                        yield cols.batch()
                        cols, held = _Columns(), 0
                    continue
                except (ValueError, IndexError, struct.error):
                    pass
        else:
            reason = "oversized"
        # the size cannot be trusted: go on at the next magic, wherever that is
        follow = gap(src, pos + len(magic), magic)[0]
        if follow < 0 and reason == "oversized":
            cols.add_reject(path, pos, n - pos, "tail")
            pos = n
        else:
            upto = follow if follow >= 0 else n if end > n else end
            cols.add_reject(path, pos, upto - pos, reason)
            pos = upto
    if cols.file:
        yield cols.batch()
    return pos


def parse_batches(content: bytes, path: str = "", magic: bytes = MAINNET_MAGIC, start: int = 0) -> Iterator[pa.RecordBatch]:
    """The blocks and rejects of one block file from byte ``start`` on, a few hundred blocks at a time."""
    yield from parse_source(Bytes(content), path, magic, start)


def parse_file(content: bytes, path: str = "", magic: bytes = MAINNET_MAGIC) -> pa.RecordBatch:
    """The blocks and rejects of one block file in one nested Arrow batch."""
    table = pa.Table.from_batches(parse_batches(content, path, magic), schema=_ARROW_SCHEMA).combine_chunks()
    batches = table.to_batches()
    return batches[0] if batches else _Columns().batch()


class DamagedBlockFile(RuntimeError):
    """A block file has bytes that are neither blocks nor padding."""


def parser(magic: bytes, starts: dict[str, int] | None = None, fail: bool = False):
    """Arrow batches (path, content) -> scan rows. ``starts``: where to begin in a file, by path.
    With ``fail`` the first damage is an error."""
    def parse(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path = path.as_py()
                for out in parse_batches(content.as_py(), path, magic, (starts or {}).get(path, 0)):
                    if fail:
                        for row in out.select(["offset", "length", "reason"]).to_pylist():
                            if row["reason"] in DAMAGE:
                                raise DamagedBlockFile(f"{path}: {row['reason']}, {row['length']} bytes at {row['offset']}; "
                                                       "read with on_damage='keep' to get the blocks around it")
                    yield out
    return parse


def scan_block_files(spark: SparkSession, path: str | list[str], glob: str = "blk*.dat",
                     magic: bytes = MAINNET_MAGIC, starts: dict[str, int] | None = None) -> DataFrame:
    """S1 with rejects: one row per block or reject: (file, block, transactions, offset, length, reason)."""
    reader = spark.read.format("binaryFile")
    if isinstance(path, str):
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "content").mapInArrow(parser(magic, starts), SCAN)


def blocks_of(scan: DataFrame) -> DataFrame:
    """The nested frame of a scan's blocks."""
    return scan.filter(F.col("reason").isNull()).select("file", "block", "transactions")


def rejects_of(scan: DataFrame) -> DataFrame:
    """What a scan could not read: (file, offset, length, reason)."""
    return scan.filter(F.col("reason").isNotNull()).select("file", "offset", "length", "reason")


def damage_of(scan: DataFrame) -> DataFrame:
    return rejects_of(scan).filter(F.col("reason").isin(*DAMAGE))


def read_block_files(spark: SparkSession, path: str, glob: str = "blk*.dat",
                     magic: bytes = MAINNET_MAGIC, on_damage: str = "fail") -> DataFrame:
    """Nested frame, one row per block: (file, block struct, transactions array).

    Damaged bytes make the read fail; ``on_damage="keep"`` returns every good block around them
    (``rejects_of(scan_block_files(...))`` tells what was left out)."""
    if on_damage not in ("fail", "keep"):
        raise ValueError(f"unknown on_damage {on_damage!r}")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "content"))
    return blocks_of(files.mapInArrow(parser(magic, fail=on_damage == "fail"), SCAN))


def flatten(nested: DataFrame, input_address: bool = False) -> Ledger:
    """Nested blocks → (blocks, transactions, outputs, inputs). With ``input_address`` the inputs have
    an ``address`` as well: what the output classifier makes of their unlocking scripts."""
    blocks = nested.select("block.hash", "block.prev_hash", "block.time")
    txs = nested.select(F.col("block.hash").alias("block_hash"), F.col("block.time").alias("time"),
                        F.explode("transactions").alias("tx"))
    transactions = txs.select(F.col("tx.hash").alias("hash"), "block_hash", "time")
    outputs = txs.select(F.col("tx.hash").alias("tx_hash"),
                         F.posexplode("tx.outputs").alias("ord", "o")).select(
        "tx_hash", F.col("ord").cast("long").alias("ord"), F.col("o.value").alias("value"),
        F.col("o.script").alias("script"))
    inputs = txs.select(F.col("tx.hash").alias("tx_hash"), F.explode("tx.inputs").alias("i")).select(
        "tx_hash", F.col("i.ref_hash").alias("ref_hash"), F.col("i.ref_ord").alias("ref_ord"),
        F.col("i.script_sig").alias("script_sig"))
    inputs = with_address(inputs, script_col="script_sig").drop("kind") if input_address else inputs
    inputs = inputs.drop("script_sig")
    return Ledger(blocks, transactions, outputs, inputs)
