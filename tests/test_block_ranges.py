"""Block files as byte ranges (S1) and as a stream source: whatever the ranges, one pass per file."""

import json
import random

import pytest
from blkencode import encode_block, encode_tx, frame
from pyspark.sql import functions as F

from ledgergraph.sources import blockranges as R
from ledgergraph.sources.blockfile import MAINNET_MAGIC, Bytes, parse_batches, scan_block_files

ZERO = "00" * 32
COLUMNS = ["offset", "length", "reason"]


def _block(i, script=b"", outs=1):
    cb, _ = encode_tx([(ZERO, 0xFFFFFFFF, bytes([i % 256]))], [(1 + i, script)] * outs)
    return frame(encode_block(ZERO, 1 + i, [cb])[0])


def _files():
    """Bytes of files with every kind of damage, a block inside of a block's script, padding and tails."""
    rng = random.Random(7)
    inner = _block(99)
    plain = b"".join(_block(i, bytes(rng.randrange(200)), rng.randrange(1, 4)) for i in range(40))
    nested = _block(1) + _block(2, inner * 3) + _block(3) + _block(4, b"x" * 700 + inner) + _block(5)
    cut = _block(6)[:88] + b"\x05" + _block(6)[89:]
    damaged = (_block(1) + b"junk" * 100 + _block(2) + cut + _block(3) + b"\0" * 600 + _block(4)
               + _block(5)[:4] + b"\xff\xff\xff\x7f" + _block(5)[8:] + _block(6) + MAINNET_MAGIC + b"\x09\0\0\0" + _block(7) + b"\0" * 300)
    return {"plain": plain, "nested": nested, "damaged": damaged, "tail": plain[:-5], "half magic": _block(1) + MAINNET_MAGIC[:2],
            "junk only": b"abc" * 500, "zeros": bytes(2000), "empty": b"", "junk end": _block(3) + b"q" * 900}


def _rows(batches):
    return [tuple(r[c] for c in COLUMNS) + ((r["block"] or {}).get("hash"),) for b in batches for r in b.to_pylist()]


@pytest.mark.parametrize("name", list(_files()))
def test_ranges_join_up_by_hand(tmp_path, name):
    """Ranges read alone, without Spark: where every one begins where the last ended, all rows are those of one pass."""
    data = _files()[name]
    path = tmp_path / "blk00000.dat"
    path.write_bytes(data)
    want = _rows(parse_batches(data))
    for size in (64, 100, 257, 1000, 1 << 20):
        reader = R.RangeReader({"path": str(tmp_path), "rangebytes": str(size)})
        got, ended = [], 0
        for part in reader.partitions():
            if ended >= part.stop and not (part.start == 0):
                continue                                    # nothing starts in this range
            part.entry = ended if part.start else 0
            rows = [r for b in reader.read(part) for r in b.to_pylist()]
            mark = rows.pop()
            assert mark["reason"] == R.RANGE
            ended = mark["offset"] + mark["length"]
            got += [tuple(r[c] for c in COLUMNS) + ((r["block"] or {}).get("hash"),) for r in rows]
        assert got == want and ended == len(data), size


def test_scan_ranges_equals_one_pass(spark, tmp_path):
    files = _files()
    for i, (name, data) in enumerate(files.items()):
        (tmp_path / f"blk{i:05d}.dat").write_bytes(data)
    (tmp_path / "rev00000.dat").write_bytes(b"not a block file")
    whole = scan_block_files(spark, str(tmp_path))
    rows = lambda df: sorted((r.file.rsplit("/", 1)[1], r.offset, r.length, r.reason or "", str(r.block), str(r.transactions))
                             for r in df.collect())
    want = rows(whole)
    for size in (300, 4096):
        scan = R.scan_ranges(spark, str(tmp_path), range_bytes=size)
        assert rows(scan) == want, size
    assert R.scan_ranges(spark, f"file:{tmp_path}", range_bytes=4096).filter("reason is null").count() == whole.filter("reason is null").count()
    bare = R.scan_ranges(spark, str(tmp_path), scripts="none").filter("reason is null")
    assert bare.select(F.explode("transactions.outputs").alias("o")).filter("o.script[0] is not null").isEmpty()
    # several tasks for one file
    R.register(spark)
    assert R._load(spark, str(tmp_path), "blk00000.dat", MAINNET_MAGIC, "all", 300).rdd.getNumPartitions() == -(-len(files["plain"]) // 300)


def test_ranges_that_do_not_join_are_found(spark, tmp_path):
    """A whole block inside of a script, where a range begins: the guess is wrong and is mended."""
    data = _files()["nested"]
    (tmp_path / "blk00000.dat").write_bytes(data)
    at = data.index(_block(99)) - 1
    R.register(spark)
    rows = R._load(spark, str(tmp_path), "blk*.dat", MAINNET_MAGIC, "all", at).cache()
    sizes = spark.createDataFrame([(str(tmp_path / "blk00000.dat"), len(data))], "file string, size long")
    assert R.misread(rows, at, sizes).count() == 1
    got = sorted(tuple(r) for r in R.scan_ranges(spark, str(tmp_path), range_bytes=at).select(*COLUMNS).collect())
    assert got == sorted(r[:3] for r in _rows(parse_batches(data)))


def test_frontier_is_the_last_whole_block():
    blocks = [_block(i) for i in range(4)]
    n = [len(b"".join(blocks[:k])) for k in range(5)]
    reach = lambda data, start=0: R.frontier(Bytes(data), start, MAINNET_MAGIC)
    assert reach(b"".join(blocks)) == n[4]
    assert reach(b"".join(blocks)[:-1]) == n[3] and reach(b"".join(blocks) + bytes(500)) == n[4]
    assert reach(blocks[0] + blocks[1][:6]) == n[1] and reach(b"") == 0 and reach(bytes(100)) == 0
    assert reach(blocks[0] + b"junk" + blocks[1]) == n[2] + 4 and reach(blocks[0] + b"junk") == n[1]
    assert reach(b"".join(blocks), n[2]) == n[4]


def test_stream_offsets_survive_a_restart(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    R.register(spark)

    def run():
        from ledgergraph.streaming.ingest import start_stream
        q = start_stream(spark, str(src), str(out), str(ckpt))
        q.awaitTermination(120)
        return spark.read.parquet(f"{out}/blocks").count()
    (src / "blk00000.dat").write_bytes(_block(0) + _block(1))
    (src / "blk00001.dat").write_bytes(_block(2)[:-1])
    assert run() == 2
    (src / "blk00001.dat").write_bytes(_block(2) + _block(3))
    assert run() == 4
    offsets = sorted((ckpt / "offsets").iterdir(), key=lambda p: p.name.zfill(9))
    last = [p for p in offsets if not p.name.startswith(".")][-1].read_text().splitlines()[-1]
    assert set(json.loads(last).values()) == {len(_block(0) + _block(1)), len(_block(2) + _block(3))}
    assert run() == 4
