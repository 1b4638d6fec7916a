"""Conversion job (S13) and the incremental streaming conversion on encoded block files."""

import os
import tempfile

from pyspark.sql import functions as F

from test_ingest import _fixture
from blkencode import encode_block, encode_tx, frame
from ledgergraph.plans.job import convert
from ledgergraph.streaming.ingest import start_stream


def test_convert_job(spark):
    src = tempfile.mkdtemp(prefix="lg-src-")
    out = tempfile.mkdtemp(prefix="lg-out-")
    _fixture(src)
    stats = convert(spark, src, out, debug=1)
    assert stats["edges_block_tx"] == 4 and stats["edges_block_prev"] == 3
    assert stats["edges_tx_address"] == 6 and stats["edges_address_tx"] == 1
    edges = spark.read.parquet(f"{out}/edges")
    assert edges.count() == 4 + 1 + 6 + 2          # first block's prev dangles → dropped
    ids = spark.read.parquet(f"{out}/addresses").count()
    assert ids == 4
    convert(spark, src, out)                        # re-run overwrites
    assert spark.read.parquet(f"{out}/ledger/outputs").count() == 6


def test_convert_registers_outpoint_bucketed_tables(spark):
    src = tempfile.mkdtemp(prefix="lg-src2-")
    out = tempfile.mkdtemp(prefix="lg-out2-")
    _fixture(src)
    convert(spark, src, out, table_db="lg_test_ledger")
    outs = spark.table("lg_test_ledger.ledger_outputs")
    ins = spark.table("lg_test_ledger.ledger_inputs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = outs.join(ins, (outs.tx_hash == ins.ref_hash) & (outs.ord == ins.ref_ord), "left_anti")
        p = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 6 - 1 and p.count("Bucketed: true") == 2
        assert not [l for l in p.splitlines() if "Exchange" in l]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_appends_new_files(spark):
    src = tempfile.mkdtemp(prefix="lg-ssrc-")
    out = tempfile.mkdtemp(prefix="lg-sout-")
    ckpt = tempfile.mkdtemp(prefix="lg-sckpt-")
    h = _fixture(src)
    q = start_stream(spark, src, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/blocks").count() == 3
    # a new file arrives: only it is parsed by the next run
    cb, _ = encode_tx([("00" * 32, 0xFFFFFFFF, b"")], [(1, b"")])
    blk, _ = encode_block(h["h_b3"], 1231008000, [cb])
    with open(os.path.join(src, "blk00002.dat"), "wb") as f:
        f.write(frame(blk))
    q = start_stream(spark, src, out, ckpt)
    q.awaitTermination(120)
    blocks = spark.read.parquet(f"{out}/blocks")
    assert blocks.count() == 4
    assert blocks.select("batch").distinct().count() == 2
    assert spark.read.parquet(f"{out}/outputs").filter(F.col("value") == 1).count() == 1


def _chain(n):
    out, prev = [], "00" * 32
    for i in range(n):
        cb, _ = encode_tx([("00" * 32, 0xFFFFFFFF, bytes([i]))], [(1 + i, b"")])
        raw, prev = encode_block(prev, 1 + i, [cb])
        out.append((frame(raw), prev))
    return out


def test_stream_resumes_a_growing_file(spark, tmp_path):
    """The node's last file grows, first block by block, then into zeros it was padded with."""
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.mkdir(src)
    blocks = _chain(6)
    path = os.path.join(src, "blk00000.dat")

    def run(data, when):
        with open(path, "wb") as f:
            f.write(data)
        os.utime(path, (when, when))
        start_stream(spark, src, out, ckpt).awaitTermination(120)
        return sorted(r.hash for r in spark.read.parquet(f"{out}/blocks").collect())
    raw = [b for b, _ in blocks]
    want = [h for _, h in blocks]
    assert run(raw[0] + raw[1][:50], 1_000_000) == want[:1]
    assert run(raw[0] + raw[1] + raw[2] + raw[3][:9], 1_000_010) == sorted(want[:3])
    size = sum(map(len, raw)) + 100
    pad = lambda n: b"".join(raw[:n]).ljust(size, b"\0")
    assert run(pad(5), 1_000_020) == sorted(want[:5])
    assert run(pad(6), 1_000_030) == sorted(want)          # same length as before, other bytes
    assert run(pad(6), 1_000_030) == sorted(want)          # nothing new: nothing twice
    assert spark.read.parquet(f"{out}/rejects").count() == 0


def test_stream_fails_on_damage(spark, tmp_path):
    import pytest
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.mkdir(src)
    (a, ha), (b, hb) = _chain(2)
    with open(os.path.join(src, "blk00000.dat"), "wb") as f:
        f.write(a + b"x" + b)
    with pytest.raises(Exception, match="junk"):
        start_stream(spark, src, out, ckpt).awaitTermination(120)
    start_stream(spark, src, out, ckpt, on_damage="keep").awaitTermination(120)
    assert sorted(r.hash for r in spark.read.parquet(f"{out}/blocks").collect()) == sorted([ha, hb])
    assert [r.reason for r in spark.read.parquet(f"{out}/rejects").collect()] == ["junk"]
