"""What the ledger queries shuffle and write: no table that a query does not need, numbers and bytes instead of texts."""

import re

from pyspark.sql import functions as F

from conftest import SF0001
from ledgergraph.functions.hashing import packed, unpacked
from ledgergraph.functions.script import with_address
from ledgergraph.operators import edges as E
from ledgergraph.operators import ledger as L
from ledgergraph.schemas import Ledger
from ledgergraph.sources.star import derive_ledger, ledger_from_dir, read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def orders_of(spark):
    return spark.createDataFrame([(1, 7, 100), (2, 7, 200), (3, 8, 300)], "o_orderkey long, o_custkey long, t long").select(
        "o_orderkey", "o_custkey", F.timestamp_seconds("t").alias("o_orderdate"))


def items_of(spark):
    return spark.createDataFrame([(1, 1, 16, 1, 1.5, "R"), (1, 2, 10, 1, 2.5, "N"), (2, 1, 11, 1, 3.5, "A"), (3, 1, 12, 1, 4.5, "N"),
                                  (3, 1, 12, 1, 4.5, "N")],
                                 "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string")


def test_transactions_derive_no_other_table(spark):
    ledger = derive_ledger(orders_of(spark), items_of(spark))
    assert ledger.transactions.count() == 3 and ledger.blocks.count() == 1
    assert not {"outputs", "inputs", "buckets"} & set(vars(ledger))
    assert ledger.outputs.count() == 5 and "inputs" not in vars(ledger)


def test_stored_ledger_equals_the_plain_one(spark):
    stored = derive_ledger(orders_of(spark), items_of(spark))
    plain = derive_ledger(orders_of(spark), items_of(spark), materialize=False)
    for a, b in zip(stored, plain):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    coinbase = plain.inputs.filter(F.col("ref_hash") == "0" * 64)
    assert coinbase.count() == 2


def test_outputs_are_shuffled_as_numbers(spark):
    """Hash and script are made after the exchange into the outpoint's buckets, not carried through it."""
    ledger = derive_ledger(orders_of(spark), items_of(spark))
    p = ledger.placed_outputs._jdf.queryExecution().optimizedPlan().toString()
    above, below = p.split("RepartitionByExpression", 1)
    assert "unhex" in above and "unhex" not in below and "tx_hash" not in below


def test_addresses_are_classified_in_place(spark):
    outputs = derive_ledger(orders_of(spark), items_of(spark)).outputs
    p = plan(with_address(outputs))
    assert "Exchange" not in p and "Join" not in p
    kinds = {(r.kind, len(r.address)) for r in with_address(outputs).collect()}
    assert kinds == {("p2pkh", 40), ("p2pk", 40), ("puzzle", 71)} or {k for k, _ in kinds} == {"p2pkh", "p2pk", "puzzle"}


def test_packed_texts_are_equal_keys(spark):
    texts = ["", "0", "00", "0A", "0a", "A", "ABC", "0ABC", "F" * 64, "f" * 64, "anyone", "puzzle_AA", "é", "\x00", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    got = rows.select("t", "p", unpacked(F.col("p")).alias("u")).collect()
    assert all(r.t == r.u for r in got)
    assert len({None if r.p is None else bytes(r.p) for r in got}) == len(texts)
    assert next(len(r.p) for r in got if r.t == "F" * 64) == 33


def test_payment_pairs_are_grouped_in_the_partitions_of_their_transaction(spark):
    ledger = ledger_from_dir(spark, SF0001)
    outs = L.classified_outputs(ledger, "sha256")
    ids = E.vertex_ids(ledger, outs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.payment_edges_weighted(ledger, E.resolve_addresses(outs, ids.addresses)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", p)]
    assert "t2, payee" not in keys and "t2, payer" not in keys and keys.count("t2") == 2


def test_graph_on_texts_that_are_no_hex(spark):
    """Any text may be a hash or an address: hex of either case, odd lengths, words."""
    blocks = spark.createDataFrame([("b", "0", 1)], "hash string, prev_hash string, time int")
    txs = spark.createDataFrame([("ab", "b", 1), ("AB", "b", 2), ("t three", "b", 3)], "hash string, block_hash string, time int")
    outs = spark.createDataFrame([("ab", 0, 5, "x y"), ("AB", 0, 6, "CD"), ("t three", 0, 7, "cd"), ("t three", 1, 8, "anyone")],
                                 "tx_hash string, ord long, value long, address string")
    ins = spark.createDataFrame([("ab", "0", 9), ("AB", "ab", 0), ("t three", "AB", 0)], "tx_hash string, ref_hash string, ref_ord long")
    ledger = Ledger(blocks, txs, outs, ins)
    ids = E.vertex_ids(ledger, outs)
    name = {r.id: r.address for r in ids.addresses.collect()}
    got = {(name[r.src], name[r.dst], r.n) for r in E.payment_edges_weighted(ledger, E.resolve_addresses(outs, ids.addresses)).collect()}
    assert got == {("CD", "x y", 1), ("cd", "CD", 1), ("anyone", "CD", 1)}
    assert {(r.address, r.n_tx) for r in L.address_totals(outs, ins).collect()} == {("x y", 2), ("CD", 2), ("cd", 1), ("anyone", 1)}
    assert {(r.address, r.first_seen) for r in L.first_seen(outs, txs).collect()} == {("x y", 1), ("CD", 2), ("cd", 3), ("anyone", 3)}


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_shuffles_are_deleted_with_the_write_that_needed_them(spark, tmp_path):
    import time

    from ledgergraph.session import bucketed_table, cut_lineage, staged
    from ledgergraph.sources.io import write_table
    rows = spark.range(0, 20000).select("id", (F.col("id") % 97).alias("k"))
    grouped = rows.repartition(4, "k").groupBy("k").agg(F.sum("id").alias("s"))
    before = shuffle_files(spark)
    got = [staged(grouped, "lg_x"), bucketed_table(grouped, "lg_y", ["k"], 3)[0], cut_lineage(grouped)]
    write_table(grouped, str(tmp_path / "t"))
    until = time.time() + 20                    # deleted in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    expected = sorted((r.k, r.s) for r in grouped.collect())
    for df in [*got, spark.read.parquet(str(tmp_path / "t"))]:
        assert sorted((r.k, r.s) for r in df.collect()) == expected
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_payers_in_buckets_give_the_same_payments(spark):
    from ledgergraph.session import scratch_tables, staged_alone
    ledger = ledger_from_dir(spark, SF0001)
    outs = L.classified_outputs(ledger, "sha256")
    resolved = E.resolve_addresses(outs, E.vertex_ids(ledger, outs).addresses)
    rows = lambda df: sorted(map(tuple, df.collect()))
    before = scratch_tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = E.payment_edges_weighted(ledger, resolved, buckets=5)
        assert "lg_payers" in plan(got) and "Bucketed: true" in plan(got)
        assert rows(got) == rows(E.payment_edges_weighted(ledger, resolved))
        stored = staged_alone(spark, lambda: E.payment_edges_weighted(ledger, resolved, buckets=5), "lg_alone")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    made = [p for p in scratch_tables(spark) if p not in before]
    assert sum("lg_payers" in p for p in made) == 1 and sum("lg_alone" in p for p in made) == 1     # the first frame's own, lazily read
    assert rows(stored) == rows(got)


def test_pagerank_leaves_its_ranks_alone(spark):
    from ledgergraph.operators.pagerank import graph_vertices, pagerank
    from ledgergraph.session import scratch_tables
    before = scratch_tables(spark)
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 1)], "src long, dst long")
    ranks = pagerank(graph_vertices(e.select(F.col("src").alias("id")), e), e, fold_every=2)
    assert [("lg_ranks" in p) for p in scratch_tables(spark) if p not in before] == [True]
    assert sorted((r.id, round(r.rank, 6)) for r in ranks.collect()) == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_a_batch_leaves_the_store_alone(spark, tmp_path):
    from ledgergraph.operators.incremental import UtxoStore
    from ledgergraph.session import scratch_tables
    before = scratch_tables(spark)
    store = UtxoStore(spark, str(tmp_path / "s"), buckets=4)
    for b, (made, used) in enumerate([([("t1", 0, 5, "a"), ("t1", 1, 6, "b")], [("none", 0)]), ([("t2", 0, 7, "a")], [("t1", 0)])]):
        store.apply(f"b{b}", spark.createDataFrame(made, "tx_hash string, ord long, value long, address string"),
                    spark.createDataFrame(used, "ref_hash string, ref_ord long"))
        assert scratch_tables(spark) == before
    assert sorted(map(tuple, store.utxo().collect())) == [("t1", 1, 6, "b"), ("t2", 0, 7, "a")]


def test_conversion_keeps_no_parsed_copy_beside_the_ledger(spark, tmp_path, monkeypatch):
    import ledgergraph.plans.job as job
    from ledgergraph.session import scratch_tables
    from test_ingest import _fixture
    (tmp_path / "in").mkdir()
    _fixture(str(tmp_path / "in"))
    before, real, seen = scratch_tables(spark), job.bucketed_table, []

    def spy(df, prefix, *args, **kwargs):
        if not seen:
            seen.append([p for p in scratch_tables(spark) if p not in before])
            p = df._jdf.queryExecution().optimizedPlan().toString()
            assert "unhex" in p.split("RepartitionByExpression", 1)[1]
        return real(df, prefix, *args, **kwargs)
    monkeypatch.setattr(job, "bucketed_table", spy)
    job.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert seen == [[]] and scratch_tables(spark) == before
    kinds = {r.kind for r in spark.read.parquet(str(tmp_path / "out" / "ledger" / "outputs")).collect()}
    assert kinds and spark.read.parquet(str(tmp_path / "out" / "edges")).count() == 13


def test_number_of_edge_files_needs_no_table_of_outputs(spark, tmp_path):
    from ledgergraph.plans.queries import _edge_files
    orders_of(spark).write.parquet(str(tmp_path / "orders.parquet"))
    items_of(spark).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert _edge_files(spark, str(tmp_path)) == 4
    assert "outputs" not in vars(ledger_from_dir(spark, str(tmp_path)))
