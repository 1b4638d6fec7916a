"""G6/S16/J11 semantics on tiny hand-made inputs."""

import json
import tempfile

from ledgergraph.functions.script import with_address
from ledgergraph.operators.chain import block_drilldown, chain_height
from ledgergraph.operators.neighbours import (DIM_COLOR, EDGE_COLOR, NODE_COLOR, graph_elements,
                                              kept_edges, neighbourhood)
from ledgergraph.sources.blockfile import flatten, read_block_files
from test_ingest import _fixture


def test_neighbourhood_both_directions(spark):
    edges = spark.createDataFrame([(1, 2), (3, 1), (2, 3), (4, 5), (2, 4), (1, 2)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "id long")
    kept = {r.id: r.role for r in neighbourhood(edges, seeds).collect()}
    assert kept == {1: "seed", 2: "neighbour", 3: "neighbour"}
    ke = sorted(tuple(r) for r in kept_edges(edges, neighbourhood(edges, seeds)).select("src", "dst").collect())
    assert ke == [(1, 2), (1, 2), (2, 3), (3, 1)]


def test_graph_elements_colours(spark):
    edges = spark.createDataFrame([(1, 2), (2, 4)], "src long, dst long")
    verts = spark.createDataFrame([(i,) for i in (1, 2, 4, 9)], "id long")
    kept = neighbourhood(edges, spark.createDataFrame([(1,)], "id long"))
    docs = [(r.element, json.loads(r.json)) for r in graph_elements(verts, edges, kept).collect()]
    nodes = {d["id"]: d["color"] for e, d in docs if e == "node"}
    assert nodes == {1: NODE_COLOR, 2: NODE_COLOR, 4: DIM_COLOR, 9: DIM_COLOR}
    links = {(d["source"], d["target"]): d["color"] for e, d in docs if e == "edge"}
    assert links == {(1, 2): EDGE_COLOR, (2, 4): DIM_COLOR}


def test_drilldown_on_ingested_blocks(spark):
    tmp = tempfile.mkdtemp(prefix="lg-dd-")
    h = _fixture(tmp)
    ledger = flatten(read_block_files(spark, tmp))
    outs = with_address(ledger.outputs).drop("script")
    heights = chain_height(ledger.blocks)
    assert {r.hash: r.height for r in heights.collect()} == {h["h_b1"]: 0, h["h_b2"]: 1, h["h_b3"]: 2}
    rows = block_drilldown(heights, ledger.transactions, outs, ledger.inputs, k=2).collect()
    docs = {r.tx_hash: json.loads(r.tx_json) for r in rows}
    assert len(docs) == 3 and {r.height for r in rows} == {0, 1}
    spend = docs[h["h_spend"]]
    assert spend["vin"] == [{"ref_hash": h["h_cb1"], "ref_ord": 0}]
    assert [o["n"] for o in spend["vout"]] == [0, 1] and spend["vout"][1]["value"] == 1999
