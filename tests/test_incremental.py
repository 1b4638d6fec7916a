"""Incremental balances, main chain, several PageRanks at once, Poisson samples, seed documents: hand-made cases."""

import json
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgergraph.operators.chain import block_listing, main_chain
from ledgergraph.operators.incremental import UtxoStore
from ledgergraph.operators.pagerank import graph_vertices, pagerank, pagerank_by_graph
from ledgergraph.operators.sampling import poisson_by_hash, poisson_thresholds
from ledgergraph.operators.subgraph import best_k, seed_documents

OUT, IN = "tx_hash string, ord long, value long, address string", "ref_hash string, ref_ord long"


def _random_batches(rng, batches=5, txs=30):
    """Outputs and inputs of ``batches`` batches; spends of any age, of unknown outputs, and repeated ones."""
    out, live = [], []
    for b in range(batches):
        outs, ins = [], []
        for t in range(txs):
            for o in range(rng.randrange(4)):
                outs.append((f"t{b}-{t}", o, rng.randrange(1, 100), f"a{rng.randrange(12)}"))
        live += outs
        for _ in range(rng.randrange(2 * txs)):
            if live:
                x = live.pop(rng.randrange(len(live)))
                ins.append(x[:2])
        ins += [("nowhere", 0)]
        out.append((outs, ins))
    return out


def test_batches_merge_to_the_batch_result(spark, tmp_path):
    batches = _random_batches(random.Random(3))
    store = UtxoStore(spark, str(tmp_path / "s"), buckets=8)
    assert store.utxo().count() == 0 and store.balances().count() == 0
    known: dict[tuple, tuple] = {}
    for b, (outs, ins) in enumerate(batches):
        made, used = spark.createDataFrame(outs, OUT), spark.createDataFrame(ins, IN)
        assert store.apply(f"b{b}", made, used)
        assert not store.apply(f"b{b}", made, used)      # once only
        known |= {o[:2]: o for o in outs}
        for i in ins:
            known.pop(i, None)
        assert sorted(map(tuple, store.utxo().collect())) == sorted(known.values())
        money, n = Counter(), Counter()
        for o in known.values():
            money[o[3]] += o[2]
            n[o[3]] += 1
        assert sorted(map(tuple, store.balances().collect())) == sorted((a, money[a], n[a]) for a in n)
    assert UtxoStore(spark, str(tmp_path / "s"), buckets=99).buckets == 8     # the store's own


def test_a_small_batch_rewrites_only_its_buckets(spark, tmp_path):
    store = UtxoStore(spark, str(tmp_path / "s"), buckets=64)
    many = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("tx_hash"), F.lit(0).cast("long").alias("ord"),
                                    F.lit(1).cast("long").alias("value"), F.concat(F.lit("a"), "id").alias("address"))
    none = spark.createDataFrame([], IN)
    store.apply("all", many, none)
    before = store.versions.manifest()["tables"]
    assert len(before["utxo"]) == len(before["balances"]) == 64
    store.apply("one", spark.createDataFrame([("new", 0, 9, "a17")], OUT), spark.createDataFrame([("t42", 0)], IN))
    after = store.versions.manifest()["tables"]
    new = {t: set(after[t]) - set(before[t]) for t in after}
    assert len(new["utxo"]) <= 2 and len(new["balances"]) <= 2 and len(after["utxo"]) == 64
    rewritten = sum(spark.read.parquet(f"{store.versions.root}/{f}").count() for f in new["utxo"])
    assert rewritten < 5000 * 2 / 64 * 2
    assert store.utxo().count() == 5000 and store.balances().filter("address = 'a17'").first().balance == 10


def test_a_batch_that_dies_is_applied_later(spark, tmp_path, monkeypatch):
    store = UtxoStore(spark, str(tmp_path / "s"), buckets=4)
    made, none = spark.createDataFrame([("t", 0, 5, "a"), ("t", 1, 6, "b")], OUT), spark.createDataFrame([], IN)
    store.apply("one", made, none)
    monkeypatch.setattr(store.versions, "publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.apply("two", spark.createDataFrame([("u", 0, 1, "a")], OUT), spark.createDataFrame([("t", 1)], IN))
    monkeypatch.undo()
    assert store.utxo().count() == 2
    assert store.apply("two", spark.createDataFrame([("u", 0, 1, "a")], OUT), spark.createDataFrame([("t", 1)], IN))
    assert sorted(map(tuple, store.balances().collect())) == [("a", 6, 2)]


def test_main_chain_against_a_walk(spark):
    rng = random.Random(5)
    for trial in range(3):
        n = 60
        parent = {0: None}
        for i in range(1, n):
            parent[i] = None if rng.random() < 0.03 else rng.randrange(max(0, i - 4), i)
        name = lambda i: f"h{(i * 37) % 101:03d}" if i is not None else "none"
        blocks = spark.createDataFrame([(name(i), name(p), i) for i, p in parent.items()], "hash string, prev_hash string, time int")
        height = {}
        for i in range(n):
            height[i] = 0 if parent[i] is None else height[parent[i]] + 1
        tip = min((i for i in range(n) if height[i] == max(height.values())), key=name)
        main = set()
        while tip is not None:
            main.add(tip)
            tip = parent[tip]
        got = {r.hash: (r.height, r.main) for r in main_chain(blocks).collect()}
        assert got == {name(i): (height[i], i in main) for i in range(n)}
        listing = block_listing(main_chain(blocks).filter("main")).collect()
        assert [r.height for r in listing] == list(range(len(main)))
    one = spark.createDataFrame([("only", "none", 1)], "hash string, prev_hash string, time int")
    assert [tuple(r) for r in main_chain(one).collect()] == [("only", 0, True)]


def test_graphs_at_once_equal_separate_runs(spark):
    rng = random.Random(11)
    graphs = {g: [(rng.randrange(20), rng.randrange(20), rng.randrange(1, 4)) for _ in range(5 + 25 * k)] for k, g in enumerate((3, 1998, 7))}
    edges = spark.createDataFrame([(g, *e) for g, es in graphs.items() for e in es], "graph int, src long, dst long, n long")
    ends = edges.select("graph", F.col("src").alias("id")).union(edges.select("graph", "dst")).distinct()
    got = defaultdict(dict)
    rounds = {}
    for r in pagerank_by_graph(ends, edges).collect():
        got[r.graph][r.id] = r.rank
        rounds.setdefault(r.graph, set()).add(r.rounds)
    for g, es in graphs.items():
        e = spark.createDataFrame(es, "src long, dst long, n long")
        alone = {r.id: r.rank for r in pagerank(graph_vertices(e.select(F.col("src").alias("id")), e), e).collect()}
        assert alone.keys() == got[g].keys() and all(math.isclose(alone[i], got[g][i], rel_tol=1e-9) for i in alone)
        assert math.isclose(sum(got[g].values()), len(got[g])) and len(rounds[g]) == 1
    with pytest.raises(ValueError):
        pagerank_by_graph(ends, edges.withColumn("src", F.lit(-1).cast("long")))


def test_poisson_sample(spark):
    df = spark.range(20_000).select("id")
    one = sorted(tuple(r) for r in poisson_by_hash(df, ["id"], 0.7).collect())
    assert one == sorted(tuple(r) for r in poisson_by_hash(df.repartition(13, "id"), ["id"], 0.7).collect())
    times = Counter(i for i, _ in one)
    share = Counter(times.values())
    for k in range(1, 5):
        assert abs(share[k] / 20_000 - math.exp(-0.7) * 0.7 ** k / math.factorial(k)) < 0.01
    assert all(sorted(c for j, c in one if j == i) == list(range(1, times[i] + 1)) for i in list(times)[:20])
    first = [tuple(r) for r in poisson_by_hash(df, ["id"], 0.7, n=50).collect()]
    assert len(first) == 50 and set(first) <= set(one)
    assert poisson_by_hash(df, ["id"], 0.7, seed=1).count() != 0 and poisson_by_hash(df.limit(0), ["id"], 0.7).count() == 0
    assert poisson_thresholds(0.7) == sorted(poisson_thresholds(0.7)) and poisson_by_hash(df, ["id"], 0.0).count() == 0


def test_seed_documents_of_a_hub(spark):
    hub = [(0, i, 1 + i % 7) for i in range(1, 3001)] + [(5, 0, 100), (0, 0, 9), (8, 9, 1)]
    edges = spark.createDataFrame(hub, "src long, dst long, n long")
    docs = {r.seed: r for r in seed_documents(edges, spark.createDataFrame([(0,), (9,), (7777,)], "id long"), k=20).collect()}
    assert set(docs) == {0, 9, 7777}
    weight = Counter()
    for a, b, n in hub:
        if a != b and 0 in (a, b):
            weight[a + b] += n
    best = sorted(weight, key=lambda i: (-weight[i], i))[:20]
    doc = json.loads(docs[0].json)
    assert [n["id"] for n in doc["nodes"]] == [0, *sorted(best)] and docs[0].n_nodes == 21 and docs[0].n_edges == 21
    assert {"source": 5, "target": 0, "color": "#999"} in doc["edges"] and len(docs[0].json) <= 180 * 20
    assert json.loads(docs[7777].json) == {"nodes": [{"id": 7777, "color": "#ec5148"}], "edges": []}
    rows = edges.select(F.col("src").alias("seed"), F.col("dst").alias("id"), F.col("n").alias("weight"))
    assert best_k(rows.repartition(9), 3).filter("seed = 0").count() == 3


def test_listing_lines_of_split_files(spark, tmp_path):
    from ledgergraph.session import scoped_conf
    from ledgergraph.sources.io import read_listing, write_listing
    heights = spark.range(5000).select(F.col("id").alias("height"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    write_listing(heights, str(tmp_path / "l"))
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": "7000", "spark.sql.files.openCostInBytes": "0"}):
        assert spark.read.text(str(tmp_path / "l")).rdd.getNumPartitions() > 20
        got = {r.line_no: r.hash for r in read_listing(spark, str(tmp_path / "l")).collect()}
    assert got == {r.height: r.hash for r in heights.collect()}
