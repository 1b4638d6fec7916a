"""Sinks, listing round trip, snapshots layout, chain heights on a forked chain."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgergraph.operators.chain import chain_height
from ledgergraph.operators.snapshots import snapshot_counts
from ledgergraph.sources.io import (read_ledger, read_listing, read_table, write_ledger,
                                    write_listing, write_table)
from ledgergraph.sources.star import ledger_from_dir
from conftest import SF0001


def test_chain_height_fork(spark):
    z = "0" * 64
    rows = [("a", z, 1), ("b", "a", 2), ("c", "b", 3), ("d", "c", 4), ("e", "b", 5), ("f", "e", 6)]
    blocks = spark.createDataFrame(rows, "hash string, prev_hash string, time int")
    h = {r.hash: r.height for r in chain_height(blocks).collect()}
    assert h == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 2, "f": 3}


def test_ledger_parquet_round_trip_and_listing(spark):
    root = tempfile.mkdtemp(prefix="lg-io-")
    ledger = ledger_from_dir(spark, SF0001)
    write_ledger(ledger, root)
    write_ledger(ledger, root)                                   # overwrite: idempotent re-run
    back = read_ledger(spark, root)
    assert back.outputs.count() == 6000 and back.inputs.count() == 3701
    heights = chain_height(back.blocks)
    write_listing(heights, os.path.join(root, "listing"))
    lst = read_listing(spark, os.path.join(root, "listing"))
    got = [r.hash for r in lst.orderBy("line_no").collect()]
    want = [r.hash for r in heights.orderBy("height").collect()]
    assert got == want


def test_snapshot_partitioned_write(spark):
    root = tempfile.mkdtemp(prefix="lg-snap-")
    ledger = ledger_from_dir(spark, SF0001)
    counts = snapshot_counts(ledger)
    write_table(counts, root + "/counts", partition_by=["snapshot"], num_files=2)
    back = read_table(spark, root + "/counts")
    assert back.filter(F.col("snapshot") == 1996).count() == 1
    assert back.agg(F.sum("n_outputs")).first()[0] == 6000
    try:
        write_table(counts, root + "/counts", mode="errorifexists")
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path_already_exists" in str(e).lower()


def test_chain_height_property_random_forests(spark):
    import random

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.integers(0, 10_000), st.integers(1, 200))
    def check(seed, n):
        rnd = random.Random(seed)
        parent = {}
        for b in range(n):      # each block's parent is an earlier block, or outside the data
            parent[f"b{b}"] = f"b{rnd.randrange(b)}" if b and rnd.random() < 0.9 else f"ext{b}"
        want = {}
        for b in parent:
            d, p = 0, parent[b]
            while p in parent:
                d, p = d + 1, parent[p]
            want[b] = d
        blocks = spark.createDataFrame([(b, p, 0) for b, p in parent.items()],
                                       "hash string, prev_hash string, time int")
        assert {r.hash: r.height for r in chain_height(blocks).collect()} == want

    check()


def test_part_range_names_the_first_files():
    import fnmatch

    from ledgergraph.sources.io import part_range
    for files in (1, 4, 10, 12, 100, 1005, 100_000, 100_234):
        names = part_range(files).removeprefix("part-{").removesuffix("}-*").split(",")
        for k in {0, 3, files // 2, files - 2, files - 1, files, files + 1, 10 * files, 99_999, 100_000}:
            if k >= 0:
                assert any(fnmatch.fnmatch(f"{k:05d}", x) for x in names) == (k < files), (files, k)


def test_job_edge_files_grow_with_the_edges(spark, monkeypatch):
    from ledgergraph.plans import queries as Q
    Q.release(spark)
    monkeypatch.setattr(Q, "EDGES_PER_FILE", 1000)
    got = Q.q_job_edges_roundtrip(spark, SF0001)
    files = Q._edge_files(spark, SF0001)
    assert files > 10 and len(got.inputFiles()) == files
    assert got.count() == Q.QUERIES["edges_indexed"](spark, SF0001).count()
    Q.release(spark)
