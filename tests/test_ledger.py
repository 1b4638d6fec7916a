"""Derived-ledger counts (FIXTURES §4) and ledger properties at sf0.001."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ledgergraph.operators import edges as E
from ledgergraph.operators import ledger as L
from ledgergraph.sources.star import ledger_from_dir


@pytest.fixture(scope="module")
def ledger(spark):
    return ledger_from_dir(spark, SF0001)


@pytest.fixture(scope="module")
def outs(ledger):
    return L.classified_outputs(ledger, "hash160")


def test_counts(ledger):
    assert ledger.blocks.count() == 1094
    assert ledger.transactions.count() == 1500
    assert ledger.outputs.count() == 6000
    assert ledger.inputs.count() == 3701
    assert ledger.inputs.filter(F.col("ref_ord") == 4294967295).count() == 150


def test_kinds(outs):
    prof = {r.kind: r.n_outputs for r in L.address_profile(outs).collect()}
    assert prof == {"p2pkh": 3825, "p2pk": 713, "puzzle": 379, "unspendable": 371,
                    "anyone": 352, "unknown": 360}
    assert L.distinct_addresses(outs).count() == 167


def test_spends_and_edges(ledger, outs):
    assert L.spends(outs, ledger.inputs).count() == 3551
    assert E.edges_named(ledger, outs).count() == 12145
    assert E.edges_indexed(ledger, outs).count() == 12144
    ids = E.vertex_ids(ledger, outs)
    w = E.payment_edges_weighted(ledger, outs, ids.addresses)
    assert w.agg(F.sum("n")).first()[0] == 35174
    assert E.expand_multigraph(w).count() == 35174


def test_totals_identity(ledger, outs):
    t = L.address_totals(outs, ledger.inputs)
    assert t.filter(F.col("total_received") != F.col("total_sent") + F.col("final_balance")).count() == 0
    bal = {r.address: r.balance for r in L.balances(outs, ledger.inputs).collect()}
    for r in t.filter(F.col("final_balance") > 0).collect():
        assert bal[r.address] == r.final_balance


def test_dense_ids_disjoint(ledger, outs):
    ids = E.vertex_ids(ledger, outs)
    a = [r.id for r in ids.addresses.collect()]
    b = [r.id for r in ids.blocks.collect()]
    t = [r.id for r in ids.transactions.collect()]
    allv = sorted(a + b + t)
    assert allv == list(range(len(allv)))
    assert max(a) < min(b) and max(b) < min(t)


def test_legacy_direction(ledger, outs):
    doc = E.edges_named(ledger, outs).filter(F.col("edge_kind") == "block_tx").select("src", "dst")
    leg = E.edges_named(ledger, outs, direction="legacy").filter(F.col("edge_kind") == "block_tx")
    assert doc.exceptAll(leg.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).count() == 0


def test_expand_multigraph_chunks(spark):
    w = spark.createDataFrame([(1, 2, 10001), (3, 4, 1), (5, 6, 4096)], "src long, dst long, n long")
    got = E.expand_multigraph(w, chunk=4096).groupBy("src", "dst").count().collect()
    assert {(r.src, r.dst): r["count"] for r in got} == {(1, 2): 10001, (3, 4): 1, (5, 6): 4096}


def test_ledger_memo_is_per_session(spark):
    other = spark.newSession()
    a = ledger_from_dir(spark, SF0001)
    b = ledger_from_dir(other, SF0001)
    assert a is ledger_from_dir(spark, SF0001)
    assert a is not b and b.outputs.sparkSession is other
    assert b.outputs.count() == 6000


def test_payment_graph_equals_literal_flattening(spark):
    """G3 against the literal v1 construction: per transaction, every (input, output) pair is a
    row keyed twice — by the spent outpoint and by the transaction's own outpoint; the edges
    are the key-equal pairs (payee of the spending tx → owner of the spent output)."""
    import collections
    import random

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from ledgergraph.schemas import Ledger

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.integers(0, 10_000))
    def check(seed):
        rnd = random.Random(seed)
        pool = [f"A{i}" for i in range(5)]
        outputs, inputs, live = [], [], []
        for t in range(12):
            tx = f"T{t}"
            for _ in range(rnd.randint(0, 3)):               # inputs: spend live outputs or coinbase
                if live and rnd.random() < 0.8:
                    ref = live.pop(rnd.randrange(len(live)))
                else:
                    ref = ("0" * 64, 4294967295)
                inputs.append((tx, ref[0], ref[1]))
            for k in range(rnd.randint(0, 3)):
                outputs.append((tx, k, rnd.randint(1, 9), rnd.choice(pool)))
                live.append((tx, k))
        # literal flattening
        addr = {(t, k): a for t, k, _, a in outputs}
        outs_of = collections.defaultdict(list)
        for t, k, _, a in outputs:
            outs_of[t].append(k)
        ins_of = collections.defaultdict(list)
        for t, rh, ro in inputs:
            ins_of[t].append((rh, ro))
        rows = [(addr[(t, k)], (rh, ro), (t, k)) for t in outs_of for (rh, ro) in ins_of[t] for k in outs_of[t]]
        by_prev = collections.defaultdict(list)
        by_own = collections.defaultdict(list)
        for a, prev, own in rows:
            by_prev[prev].append(a)
            by_own[own].append(a)
        want = collections.Counter()
        for key, payees in by_prev.items():
            for payee in payees:
                for payer in by_own.get(key, []):
                    want[(payee, payer)] += 1

        o = spark.createDataFrame(outputs, "tx_hash string, ord long, value long, address string")
        i = spark.createDataFrame(inputs, "tx_hash string, ref_hash string, ref_ord long")
        ids = spark.createDataFrame([(n, a) for n, a in enumerate(pool)], "id long, address string")
        ledger = Ledger(None, None, o, i)
        got = {(pool[r.src], pool[r.dst]): r.n for r in E.payment_edges_weighted(ledger, o, ids).collect()}
        assert got == dict(want)

    check()


def test_aggregates_equal_brute_force(spark):
    """Balances and totals (received, sent, balance, distinct transactions) on random ledgers
    against plain Python."""
    import collections
    import random

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.integers(0, 10_000))
    def check(seed):
        rnd = random.Random(seed)
        pool = ["unknown", "anyone", "B1", "B2", "B3"]
        outputs, inputs, live = [], [], []
        for t in range(15):
            tx = f"T{t}"
            for _ in range(rnd.randint(0, 3)):
                if live:
                    ref = live.pop(rnd.randrange(len(live)))
                    inputs.append((tx, ref[0], ref[1]))
            for k in range(rnd.randint(0, 4)):
                outputs.append((tx, k, rnd.randint(1, 100), rnd.choice(pool)))
                live.append((tx, k))
        spent_by = {(rh, ro): t for t, rh, ro in inputs}
        recv, sent, txs, bal = (collections.Counter(), collections.Counter(),
                                collections.defaultdict(set), collections.Counter())
        for t, k, v, a in outputs:
            recv[a] += v
            txs[a].add(t)
            if (t, k) in spent_by:
                sent[a] += v
                txs[a].add(spent_by[(t, k)])
            else:
                bal[a] += v
        o = spark.createDataFrame(outputs, "tx_hash string, ord long, value long, address string")
        i = spark.createDataFrame(inputs or [("x", "y", -1)], "tx_hash string, ref_hash string, ref_ord long")
        got_t = {r.address: (r.total_received, r.total_sent, r.final_balance, r.n_tx)
                 for r in L.address_totals(o, i).collect()}
        want_t = {a: (recv[a], sent[a], recv[a] - sent[a], len(txs[a])) for a in recv}
        assert got_t == want_t
        got_b = {r.address: r.balance for r in L.balances(o, i).collect()}
        assert got_b == {a: v for a, v in bal.items() if any(
            a == oa and (t, k) not in spent_by for t, k, _, oa in outputs)}

    check()
