"""Block-file ingest round trip against the test-side encoder."""

import os
import tempfile

from blkencode import encode_block, encode_tx, frame

from ledgergraph.operators import ledger as L
from ledgergraph.sources.blockfile import flatten, read_block_files
from ledgergraph.functions.script import with_address

ZERO = "00" * 32


def _fixture(tmp):
    p2pkh = bytes.fromhex("76A914" + "AB" * 20 + "88AC")
    p2pkh2 = bytes.fromhex("76A914" + "CD" * 20 + "88AC")
    cb1, h_cb1 = encode_tx([(ZERO, 0xFFFFFFFF, b"\x04coin")], [(5000, p2pkh), (7, b"")])
    b1, h_b1 = encode_block(ZERO, 1231006505, [cb1])
    cb2, h_cb2 = encode_tx([(ZERO, 0xFFFFFFFF, b"\x02cb")], [(5000, p2pkh2)])
    spend, h_spend = encode_tx([(h_cb1, 0, b"\x01sig")], [(3000, p2pkh2), (1999, p2pkh)],
                               witness=[[b"\x30" * 71, b"\x02" * 33]])
    b2, h_b2 = encode_block(h_b1, 1231006600, [cb2, spend])
    cb3, h_cb3 = encode_tx([(ZERO, 0xFFFFFFFF, b"")], [(50, bytes.fromhex("6A0401020304"))])
    b3, h_b3 = encode_block(h_b2, 1231007000, [cb3])
    with open(os.path.join(tmp, "blk00000.dat"), "wb") as f:
        f.write(frame(b1) + frame(b2) + b"\x00" * 64)           # zero-padded tail
    with open(os.path.join(tmp, "blk00001.dat"), "wb") as f:
        f.write(frame(b3) + frame(b3)[:40])                     # truncated last block
    with open(os.path.join(tmp, "rev00000.dat"), "wb") as f:    # not a block file
        f.write(b"junk")
    return dict(h_b1=h_b1, h_b2=h_b2, h_b3=h_b3, h_cb1=h_cb1, h_spend=h_spend)


def test_ingest_round_trip(spark):
    tmp = tempfile.mkdtemp(prefix="lg-blk-")
    h = _fixture(tmp)
    nested = read_block_files(spark, tmp)
    ledger = flatten(nested)
    blocks = {r.hash: (r.prev_hash, r.time) for r in ledger.blocks.collect()}
    assert blocks == {h["h_b1"]: (ZERO.upper(), 1231006505), h["h_b2"]: (h["h_b1"], 1231006600),
                      h["h_b3"]: (h["h_b2"], 1231007000)}
    txs = {r.hash: r.block_hash for r in ledger.transactions.collect()}
    assert len(txs) == 4 and txs[h["h_spend"]] == h["h_b2"]
    outs = sorted((r.tx_hash, r.ord, r.value) for r in ledger.outputs.collect())
    assert (h["h_spend"], 1, 1999) in outs and len(outs) == 6
    ins = {(r.tx_hash, r.ref_hash, r.ref_ord) for r in ledger.inputs.collect()}
    assert (h["h_spend"], h["h_cb1"], 0) in ins and len(ins) == 4

    # the unlocking scripts through the output classifier, on request
    sigs = {r.tx_hash: r.address for r in flatten(nested, input_address=True).inputs.collect()}
    assert sigs[h["h_spend"]] == "unknown" and "anyone" in sigs.values()
    assert flatten(nested).inputs.columns == ["tx_hash", "ref_hash", "ref_ord"]

    # downstream operators run unchanged on the ingested ledger
    outs_c = with_address(ledger.outputs).drop("script")
    bal = {r.address: r.balance for r in L.balances(outs_c, ledger.inputs).collect()}
    assert bal == {"AB" * 20: 1999, "CD" * 20: 8000, "anyone": 7, "unspendable": 50}


def _blocks(n):
    """``n`` chained blocks: (serialised, hash)."""
    out, prev = [], ZERO
    for i in range(n):
        cb, _ = encode_tx([(ZERO, 0xFFFFFFFF, bytes([i]))], [(1 + i, b"")])
        raw, prev = encode_block(prev, 1 + i, [cb])
        out.append((raw, prev))
    return out


def _read(data):
    """(hashes of the blocks, (reason, offset, length) of the rejects) that a parse of ``data`` gives."""
    from ledgergraph.sources.blockfile import parse_file
    rows = parse_file(data, "f").to_pylist()
    return ([r["block"]["hash"] for r in rows if r["reason"] is None],
            [(r["reason"], r["offset"], r["length"]) for r in rows if r["reason"] is not None])


def test_damage_loses_no_good_block():
    (a, ha), (b, hb), (c, hc) = _blocks(3)
    fa, fb, fc = frame(a), frame(b), frame(c)
    cut = b[:80] + b"\x05" + b[81:]                       # claims 5 transactions, holds 1
    wrong_size = fb[:4] + (len(b) + 9).to_bytes(4, "little") + b
    huge = fb[:4] + b"\xff\xff\xff\x7f" + b
    n = len(fa)
    assert _read(fa + fb + fc) == ([ha, hb, hc], [])
    # a malformed block at the start, in the middle, at the end
    assert _read(frame(cut) + fa + fc) == ([ha, hc], [("malformed", 0, len(fb))])
    assert _read(fa + frame(cut) + fc) == ([ha, hc], [("malformed", n, len(fb))])
    assert _read(fa + fc + frame(cut)) == ([ha, hc], [("malformed", n + len(fc), len(fb))])
    # sizes that can't be right
    assert _read(fa + wrong_size + fc) == ([ha, hc], [("malformed", n, len(wrong_size))])
    assert _read(fa + huge + fc) == ([ha, hc], [("oversized", n, len(huge))])
    # foreign bytes, one or many, and a foreign magic
    for junk in (b"\x07", b"junk" * 50, b"\xfa\xbf\xb5\xda" + fb[4:] + b"\x01"):
        assert _read(junk + fa + junk + fc + junk) == ([ha, hc], [
            ("junk", 0, len(junk)), ("junk", len(junk) + n, len(junk)), ("junk", 2 * len(junk) + n + len(fc), len(junk))])
    # zeros between blocks are padding and no damage; so are zeros at the end
    assert _read(fa + b"\0" * 64 + fc) == ([ha, hc], [])
    assert _read(fa + b"\0" * 64) == ([ha], [("padding", n, 64)])
    # a block that is still being written
    for k in (1, 4, 7, 8, 60, len(fb) - 1):
        assert _read(fa + fb[:k]) == ([ha], [("tail", n, k)])
    assert _read(b"") == ([], [])


def test_damage_fails_a_read_unless_kept(spark, tmp_path):
    import pytest

    from ledgergraph.plans.job import convert
    from ledgergraph.sources.blockfile import DamagedBlockFile, damage_of, scan_block_files
    (a, ha), (b, hb), (c, hc) = _blocks(3)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/blk00000.dat").write_bytes(frame(a) + b"\x01" + frame(b))
    (tmp_path / "in/blk00001.dat").write_bytes(frame(c)[:-3])
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    with pytest.raises(Exception, match="junk, 1 bytes"):
        read_block_files(spark, src).count()
    assert {r.block.hash for r in read_block_files(spark, src, on_damage="keep").collect()} == {ha, hb}
    assert [(r.reason, r.length) for r in damage_of(scan_block_files(spark, src)).collect()] == [("junk", 1)]
    with pytest.raises(DamagedBlockFile):
        convert(spark, src, out)
    assert not (tmp_path / "out").exists()
    assert convert(spark, src, out, on_damage="keep")["damaged"] == 1
    assert {r.reason for r in spark.read.parquet(out + "/rejects").collect()} == {"junk", "tail"}
    assert spark.read.parquet(out + "/ledger/blocks").count() == 2


def test_long_files_come_in_several_batches():
    from ledgergraph.sources.blockfile import BATCH_BLOCKS, parse_batches
    blocks = _blocks(200)
    data = b"".join(frame(b) for b, _ in blocks) * 4
    batches = list(parse_batches(data, "f"))
    assert [b.num_rows for b in batches] == [BATCH_BLOCKS] * 3 + [800 - 3 * BATCH_BLOCKS]


def test_parser_round_trip_property():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from ledgergraph.sources.blockfile import parse_file
    tx_in = st.tuples(st.binary(min_size=32, max_size=32).map(lambda b: b.hex().upper()),
                      st.integers(0, 2**32 - 1), st.binary(max_size=300))
    tx_out = st.tuples(st.integers(0, 2**62), st.binary(max_size=300))
    txs = st.lists(st.tuples(st.lists(tx_in, min_size=1, max_size=4),
                             st.lists(tx_out, min_size=0, max_size=4), st.booleans()),
                   min_size=1, max_size=6)

    @settings(max_examples=30, deadline=None)
    @given(st.lists(txs, min_size=1, max_size=4))
    def check(blocks):
        data, prev, want = b"", ZERO, []
        for i, block_txs in enumerate(blocks):
            raws, hashes = [], []
            for ins, outs, seg in block_txs:
                raw, h = encode_tx(ins, outs, witness=[[b"\x01" * 3] for _ in ins] if seg else None)
                raws.append(raw)
                hashes.append((h, ins, outs))
            blk, bh = encode_block(prev, 1000 + i, raws)
            data += frame(blk)
            want.append((bh, prev.upper(), hashes))
            prev = bh
        got = parse_file(data + b"\x00" * 16, "f").to_pylist()
        assert got.pop()["reason"] == "padding"
        assert len(got) == len(want)
        for row, (bh, ph, hashes) in zip(got, want):
            assert row["block"]["hash"] == bh and row["block"]["prev_hash"] == ph
            for tx, (h, ins, outs) in zip(row["transactions"], hashes):
                assert tx["hash"] == h
                assert [(i["ref_hash"], i["ref_ord"], i["script_sig"]) for i in tx["inputs"]] == ins
                assert [(o["value"], o["script"]) for o in tx["outputs"]] == outs

    check()
