"""The physical plans we want (Spark 4.1): asserted, so a regression in the plan shape fails."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ledgergraph.operators import ledger as L
from ledgergraph.plans.queries import queries
from ledgergraph.sources.star import ledger_from_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ledger(spark):
    return ledger_from_dir(spark, SF0001)


def test_totals_one_join_partial_aggregates(spark, ledger):
    outs = L.classified_outputs(ledger, "sha256")
    p = plan(L.address_totals(outs, ledger.inputs))
    assert len(re.findall(r"(SortMerge|ShuffledHash|BroadcastHash)Join", p)) == 1
    # every shuffle keyed on the address is fed by a map-side (partial) aggregate, so a hot
    # address is combined before it is shuffled
    lines = p.splitlines()
    agg_exchanges = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(address" in l]
    assert len(agg_exchanges) == 2
    for i in agg_exchanges:
        assert "HashAggregate" in lines[i + 1] and "partial_" in lines[i + 1]


def test_scan_pushdown_and_pruning(spark):
    """json_fields reads three columns of the events table; a filter on its result reaches the scan."""
    from ledgergraph.plans.queries import q_json_fields
    p = plan(q_json_fields(spark, SF0001).filter(F.col("user_id") == 7))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,props:string>" in p


def test_no_cartesian_products(spark):
    for name, fn in queries().items():
        p = plan(fn(spark, SF0001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_python_only_for_hash160(spark, ledger):
    from ledgergraph.functions.script import with_address
    p = plan(with_address(ledger.outputs, "hash160"))
    assert len(re.findall(r"ArrowEvalPython", p)) == 1     # hash160 of p2pk keys only
    assert "BatchEvalPython" not in p                       # never row-at-a-time
    assert "ArrowEvalPython" not in plan(with_address(ledger.outputs, "sha256"))


def test_pagerank_shuffles_edges_once_and_rounds_stream_them(spark, monkeypatch):
    """The plans of a real run: the edge table is shuffled by (src, salt) only, never by plain src,
    and a round reads it bucketed, without an exchange on that side."""
    import ledgergraph.operators.pagerank as P
    rounds, edges = [], []
    real_round, real_table = P._round, P.bucketed_table

    def round_spy(*args):
        out = real_round(*args)
        rounds.append(plan(out))
        return out

    def table_spy(df, prefix, keys, buckets):
        if prefix == "lg_pagerank_edges":
            edges.append(plan(df.repartition(buckets, *keys)))
        return real_table(df, prefix, keys, buckets)
    monkeypatch.setattr(P, "_round", round_spy)
    monkeypatch.setattr(P, "bucketed_table", table_spy)
    e = spark.range(0, 3000).select((F.col("id") % 97).alias("src"), (F.col("id") % 89).alias("dst"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert P.pagerank(P.graph_vertices(e.select(F.col("src").alias("id")), e), e).count() == 97
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(edges) == 1
    exchanges = [x for x in edges[0].splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "salt" in exchanges[0]
    # the first round: senders into the edge buckets, messages by destination, nothing else
    assert "Bucketed: true" in rounds[0]
    exchanges = [x for x in rounds[0].splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and "dst" in exchanges[0] and "src" in exchanges[1] and "salt" in exchanges[1]


def test_payment_pairs_carry_ids(spark):
    """No join or aggregation of pair size carries an address text."""
    from ledgergraph.plans.queries import _resolved, _vertex_ids
    from ledgergraph.operators.edges import payment_edges_weighted
    ledger, _, _ = _vertex_ids(spark, SF0001)
    p = plan(payment_edges_weighted(ledger, _resolved(spark, SF0001)))
    assert "address" not in p


def test_ledger_outputs_need_no_python(spark):
    from ledgergraph.sources.star import derive_ledger, read_table
    ledger = derive_ledger(read_table(spark, SF0001, "orders"), read_table(spark, SF0001, "lineitem"), materialize=False)
    for table in ledger:
        p = plan(table)
        assert "Python" not in p and "Pandas" not in p and "Arrow" not in p


def test_spend_join_reads_bucketed_tables_in_place(spark, ledger):
    """Outputs and inputs are bucketed on the outpoint: without a broadcast (as at scale) the
    anti join of balances shuffles neither side — only the aggregation by address shuffles."""
    from ledgergraph.functions.script import with_address
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        outs = with_address(ledger.outputs, "sha256").drop("script")
        p = plan(L.balances(outs, ledger.inputs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert p.count("Bucketed: true") == 2
    exchanges = [l for l in p.splitlines() if "Exchange" in l]
    assert len(exchanges) == 1 and "hashpartitioning(address" in exchanges[0]


def test_bucketed_table_refused_by_the_catalog_is_staged(spark, monkeypatch):
    from pyspark.errors import AnalysisException
    from pyspark.sql.readwriter import DataFrameWriter

    from ledgergraph.session import bucketed_table

    def refuse(self, *a, **k):
        raise AnalysisException("no bucketed tables here")
    df = spark.range(0, 100).withColumn("k", F.col("id") % 7)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", refuse)
    with pytest.warns(UserWarning):
        t, name = bucketed_table(df, "lg_fallback", ["k"], 4)
    assert name == "" and t.count() == 100

    def fail(self, *a, **k):
        raise RuntimeError("disk full")
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", fail)
    with pytest.raises(RuntimeError):            # any other failure is not hidden
        bucketed_table(df, "lg_fallback", ["k"], 4)


def test_scratch_tables_are_deleted_with_their_files(spark):
    import os

    from ledgergraph.operators.pagerank import graph_vertices, pagerank
    from ledgergraph.session import bucketed_table, drop_table, release_scratch, scratch_tables, staged
    before = scratch_tables(spark)
    t, name = bucketed_table(spark.range(50), "lg_drop", ["id"], 2)
    path = next(p for p in scratch_tables(spark) if p.endswith(name))
    assert os.listdir(path.removeprefix("file:"))
    drop_table(spark, name)
    assert not os.path.exists(path.removeprefix("file:")) and not spark.catalog.tableExists(name)
    staged(spark.range(5), "lg_x")
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    pagerank(graph_vertices(e.select(F.col("src").alias("id")), e), e).count()
    made = [p for p in scratch_tables(spark) if p not in before]
    assert made and not any("pagerank" in p for p in made)       # the loop's own tables are gone already
    release_scratch(spark, since=before)
    assert scratch_tables(spark) == before and not any(os.path.exists(p.removeprefix("file:")) for p in made)


def test_buckets_follow_the_data(spark):
    from ledgergraph.session import buckets_for
    assert buckets_for(spark, 10 ** 9, 10 ** 6) == 1000          # however few shuffle partitions are set
    assert buckets_for(spark, 1, 10 ** 6) == spark.sparkContext.defaultParallelism
