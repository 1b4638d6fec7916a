"""S16, bounded: one viewer document per seed, with its ``k`` strongest neighbours.

The neighbours of a seed are a top-k aggregate: every task keeps a heap of k per seed and hands on what
is in it, and the heaps of all tasks are merged, so that a hub's edges never meet in one task; what
meets is k rows per task and seed. A document has at most k + 1 nodes and 2 k edges, between 30 and 70 bytes each
for ids of up to 19 digits: at most about ``180 * k`` bytes.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.operators.neighbours import EDGE_COLOR, NODE_COLOR

#: seeds whose heaps a task holds at a time
HELD = 50_000


def best_k(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows (seed, id, weight) of the largest weight per seed, ties by smaller id."""
    def partial(batches):
        heaps: dict[int, list[tuple[int, int]]] = {}

        def flush():
            out = [(s, -i, w) for s, h in heaps.items() for w, i in h]
            heaps.clear()
            return pd.DataFrame(out, columns=["seed", "id", "weight"], dtype="int64")
        for pdf in batches:
            for s, i, w in zip(pdf["seed"].tolist(), pdf["id"].tolist(), pdf["weight"].tolist()):
                heap = heaps.setdefault(s, [])
                if len(heap) < k:
                    heapq.heappush(heap, (w, -i))
                else:
                    heapq.heappushpop(heap, (w, -i))
            if len(heaps) > HELD:
                yield flush()
        yield flush()
    kept = rows.select("seed", "id", "weight").mapInPandas(partial, "seed long, id long, weight long")
    # merged twice: by a salt first, then what is left of each
    for groups in (["seed", "salt"], ["seed"]):
        kept = (kept.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(16)))
                .groupBy(*groups).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "id"))), 1, k).alias("best"))
                .select("seed", F.explode("best").alias("b")).select("seed", F.col("b.id").alias("id"), (-F.col("b.w")).alias("weight")))
    return kept


def seed_documents(edges: DataFrame, seeds: DataFrame, k: int = 50) -> DataFrame:
    """(seed, n_nodes, n_edges, json) per seed: its ``k`` neighbours with the most payments in either direction
    and the edges between it and them. ``edges`` (src, dst, n), one row per pair; a loop is no neighbour."""
    s = seeds.select(F.col("id").alias("seed")).distinct()
    out = edges.filter("src != dst").join(s, F.col("src") == F.col("seed")).select("seed", F.col("dst").alias("id"), "n", F.lit(True).alias("out"))
    in_ = edges.filter("src != dst").join(s, F.col("dst") == F.col("seed")).select("seed", F.col("src").alias("id"), "n", F.lit(False).alias("out"))
    # per neighbour: its payments, and which of the two edges there are
    near = (out.unionByName(in_).groupBy("seed", "id")
            .agg(F.sum("n").alias("weight"), F.max("out").alias("to"), F.min("out").alias("only_to")))
    best = best_k(near, k).select("seed", "id")
    kept = near.join(best, ["seed", "id"]).select("seed", "id", "to", (~F.col("only_to")).alias("from"))
    # at most k rows per seed
    lists = kept.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("id", "to", "from"))).alias("near"))
    text = lambda c: c.cast("string")
    node = lambda i: F.concat(F.lit('{"id":'), text(i), F.lit(f',"color":"{NODE_COLOR}"}}'))
    edge = lambda a, b: F.concat(F.lit('{"source":'), text(a), F.lit(',"target":'), text(b), F.lit(f',"color":"{EDGE_COLOR}"}}'))
    seed, near_ = F.col("seed"), F.coalesce("near", F.array().cast("array<struct<id:bigint,to:boolean,from:boolean>>"))
    nodes = F.concat(F.array(node(seed)), F.transform(near_, lambda x: node(x["id"])))
    arcs = F.concat(F.transform(F.filter(near_, lambda x: x["to"]), lambda x: edge(seed, x["id"])),
                    F.transform(F.filter(near_, lambda x: x["from"]), lambda x: edge(x["id"], seed)))
    return (s.join(lists, "seed", "left").select("seed", nodes.alias("nodes"), arcs.alias("edges"))
            .select("seed", F.size("nodes").alias("n_nodes"), F.size("edges").alias("n_edges"),
                    F.concat(F.lit('{"nodes":['), F.array_join("nodes", ","), F.lit('],"edges":['), F.array_join("edges", ","),
                             F.lit("]}")).alias("json")))
