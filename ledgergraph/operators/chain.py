"""Block heights along the prev-hash chain, the height-ordered listing, and the
drill-down into the first listed blocks.

Height is found by pointer doubling: each block holds (pointer, distance), starting with its
parent at distance 1; every round replaces the pointer by the pointer's pointer and adds the
distances, so a chain of n blocks needs ⌈log2 n⌉ equi-join rounds rather than n recursive steps.
Forks are fine (every block has one parent). A row whose pointer has passed the chain's root is finished
and takes no further part in the joins' left side, so no null key is ever shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.session import staged


def chain_height(blocks: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(hash, height) — the number of ancestors of each block present in ``blocks``."""
    b = blocks.select("hash", "prev_hash")
    known = blocks.select(F.col("hash").alias("prev_hash"), F.lit(True).alias("_known"))
    state = staged(
        b.join(known, "prev_hash", "left")
        .select("hash",
                F.when(F.col("_known"), F.col("prev_hash")).alias("ptr"),
                F.when(F.col("_known"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("d")), "lg_heights")
    # a pointer spans 2^r ancestors after r rounds, and no chain is deeper than the number of
    # blocks: ⌈log2 n⌉ rounds always suffice
    n = state.count()
    rounds = max(1, math.ceil(math.log2(max(n, 2))))
    if rounds > max_rounds:
        raise RuntimeError("chain deeper than 2**max_rounds blocks")
    for _ in range(rounds):
        live = state.filter(F.col("ptr").isNotNull())
        if live.isEmpty():
            break
        at = state.select(F.col("hash").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("d").alias("d2"))
        moved = live.join(at, "ptr").select("hash", F.col("ptr2").alias("ptr"), (F.col("d") + F.col("d2")).alias("d"))
        state = staged(moved.unionByName(state.filter(F.col("ptr").isNull())), "lg_heights")
    if not state.filter(F.col("ptr").isNotNull()).isEmpty():
        raise AssertionError("pointer doubling did not reach the chain roots")
    return state.select("hash", F.col("d").alias("height"))


def main_chain(blocks: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(hash, height, main): ``main`` marks the chain that ends at the tip, the block of the greatest height
    (of several the one with the least hash); the others are orphans of a fork. One hash per height is main.

    Pointer doubling gives, per round r, every block's ancestor 2^r blocks back. The marks go the other way:
    from the tip, with the longest pointers first, every marked block marks its ancestor, so that after the
    last round all ancestors are marked, each once."""
    heights = staged(chain_height(blocks, max_rounds), "lg_heights")
    known = blocks.select(F.col("hash").alias("ptr"))
    back = staged(blocks.select("hash", F.col("prev_hash").alias("ptr")).join(known, "ptr", "left_semi"), "lg_back")
    jumps = []
    while not back.isEmpty():
        jumps.append(back)
        onward = back.select(F.col("hash").alias("ptr"), F.col("ptr").alias("ptr2"))
        back = staged(back.join(onward, "ptr").select("hash", F.col("ptr2").alias("ptr")), "lg_back")
    marked = heights.orderBy(F.desc("height"), F.asc("hash")).limit(1).select("hash")
    for jump in reversed(jumps):
        marked = staged(marked.unionByName(marked.join(jump, "hash").select(F.col("ptr").alias("hash"))), "lg_marked")
    return (heights.join(marked.withColumn("main", F.lit(True)), "hash", "left")
            .select("hash", "height", F.coalesce("main", F.lit(False)).alias("main")))


def block_listing(heights: DataFrame) -> DataFrame:
    """One hash per line in height order. Of a ledger with forks hand in the main chain only
    (``main_chain(blocks).filter("main")``), as the command-line tool has one hash per height."""
    return heights.select("height", "hash").orderBy("height")


def block_drilldown(heights: DataFrame, transactions: DataFrame, outputs: DataFrame,
                    inputs: DataFrame, k: int = 1) -> DataFrame:
    """The transactions of the first ``k`` listed blocks, each as a JSON document of
    its inputs and outputs (the per-transaction lookup of the CLI tool)."""
    first = heights.filter(F.col("height") < k).select(F.col("hash").alias("block_hash"), "height")
    txs = transactions.join(first, "block_hash").select(
        "block_hash", "height", F.col("hash").alias("tx_hash"), "time")
    # one document per transaction: the lists are that transaction's inputs and outputs, whose
    # number the block size limits — the document is the output format itself
    vin = (inputs.join(txs.select("tx_hash"), "tx_hash")
           .groupBy("tx_hash")
           .agg(F.array_sort(F.collect_list(F.struct("ref_hash", "ref_ord"))).alias("vin")))
    vout = (outputs.join(txs.select("tx_hash"), "tx_hash")
            .groupBy("tx_hash")
            .agg(F.array_sort(F.collect_list(
                F.struct(F.col("ord").alias("n"), "value", "address"))).alias("vout")))
    empty_in = F.array().cast("array<struct<ref_hash:string,ref_ord:bigint>>")
    empty_out = F.array().cast("array<struct<n:bigint,value:bigint,address:string>>")
    return (txs.join(vin, "tx_hash", "left").join(vout, "tx_hash", "left")
            .select("block_hash", "height", "tx_hash",
                    F.to_json(F.struct(F.col("tx_hash").alias("txid"), "time",
                                       F.coalesce("vin", empty_in).alias("vin"),
                                       F.coalesce("vout", empty_out).alias("vout"))).alias("tx_json")))
