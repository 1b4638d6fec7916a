"""Graph edges of the ledger.

* ``edges_named``   — four edge classes on readable keys (block→tx, address→tx, tx→address,
                      block→previous block); dangling references are kept.
* ``edges_indexed`` — the same graph on dense BIGINT ids; ids of addresses, blocks and
                      transactions occupy disjoint ranges; unresolved references are dropped.
* ``payment_edges`` — the address→address multigraph (payee → payer), aggregated per
                      (src, dst) with its multiplicity; the expanded multigraph is derived
                      from the aggregate, never from a per-transaction inputs × outputs product.

Addresses are swapped for their ids once, on the outputs (``resolve_addresses``); both graphs on ids are
built from that, so the joins and aggregations after it carry longs.

``direction="legacy"`` reproduces the reversed block→tx and block→block order of the
long-key converter; the default is the documented direction.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.functions.hashing import packed, unpacked
from ledgergraph.functions.script import ANYONE, UNKNOWN, UNSPENDABLE
from ledgergraph.operators.ids import dense_ids
from ledgergraph.operators.ledger import spends
from ledgergraph.schemas import Ledger
from ledgergraph.session import bucketed_table, staged

EDGE_KINDS = ("block_tx", "address_tx", "tx_address", "block_prev")


def _edge(df: DataFrame, src, dst, value, kind: str) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"), value.cast("long").alias("value"),
                     F.lit(kind).alias("edge_kind"))


def edges_named(ledger: Ledger, outputs: DataFrame, direction: str = "documented") -> DataFrame:
    """UNION ALL of the four edge classes (src, dst, value, edge_kind)."""
    t, b = ledger.transactions, ledger.blocks
    zero = F.lit(0)
    block_tx = _edge(t, F.col("block_hash"), F.col("hash"), zero, "block_tx")
    block_prev = _edge(b, F.col("hash"), F.col("prev_hash"), zero, "block_prev")
    if direction == "legacy":
        block_tx = _edge(t, F.col("hash"), F.col("block_hash"), zero, "block_tx")
        block_prev = _edge(b, F.col("prev_hash"), F.col("hash"), zero, "block_prev")
    sp = spends(outputs.select("tx_hash", "ord", "value", "address"), ledger.inputs)
    address_tx = _edge(sp, F.col("address"), F.col("spent_by"), F.col("value"), "address_tx")
    tx_address = _edge(outputs, F.col("tx_hash"), F.col("address"), F.col("value"), "tx_address")
    return (block_tx.unionByName(address_tx).unionByName(tx_address).unionByName(block_prev))


def edge_counts(edges: DataFrame) -> DataFrame:
    """A2: rows per edge class in one aggregation pass."""
    return edges.groupBy("edge_kind").agg(F.count(F.lit(1)).alias("n"))


class VertexIds(NamedTuple):
    addresses: DataFrame     # id, address
    blocks: DataFrame        # id, hash, time
    transactions: DataFrame  # id, hash


def vertex_ids(ledger: Ledger, outputs: DataFrame) -> VertexIds:
    """W1 for the three vertex kinds: addresses [0, A), blocks [A, A+B), txs [A+B, A+B+T).

    One dense numbering of the union ordered by (kind, key) — the same ids as three
    numberings with offsets, in a single range shuffle.
    """
    keyed = (outputs.select(F.lit(0).alias("kind"), F.col("address").alias("key"),
                            F.lit(None).cast("int").alias("time")).distinct()
             .unionByName(ledger.blocks.select(F.lit(1).alias("kind"), F.col("hash").alias("key"), "time"))
             .unionByName(ledger.transactions.select(F.lit(2).alias("kind"), F.col("hash").alias("key"),
                                                     F.lit(None).cast("int").alias("time"))))
    # the ids are joined several times: materialise once (vertex-sized), each kind a partition
    ids = staged(dense_ids(keyed, ["kind", "key"])[0], "lg_vertex_ids", ["kind"])
    return VertexIds(ids.filter(F.col("kind") == 0).select("id", F.col("key").alias("address")),
                     ids.filter(F.col("kind") == 1).select("id", F.col("key").alias("hash"), "time"),
                     ids.filter(F.col("kind") == 2).select("id", F.col("key").alias("hash")))


def resolve_addresses(outputs: DataFrame, addresses: DataFrame, buckets: int | None = None) -> DataFrame:
    """(tx_hash, ord, value, aid): outputs with their address's id; with ``buckets`` partitioned into those
    of their outpoint. Hashes and addresses are shuffled as bytes.

    The pseudo-addresses that very many outputs share (at most three ids, looked up first) are no join
    keys; the others join evenly."""
    labels = [ANYONE, UNSPENDABLE, UNKNOWN]
    known = {r.address: r.id for r in addresses.filter(F.col("address").isin(labels)).collect()}     # at most three
    rows = outputs.select(packed(F.col("tx_hash")).alias("tx"), "ord", "value", "address")
    shared = rows.filter(F.col("address").isin(labels))
    aid = F.lit(None).cast("long")
    for address, i in known.items():
        aid = F.when(F.col("address") == address, F.lit(i).cast("long")).otherwise(aid)
    key = packed(F.col("address")).alias("key")
    own = rows.filter(~F.col("address").isin(labels)).select("tx", "ord", "value", key).join(
        addresses.select(key, F.col("id").alias("aid")), "key")
    found = (own.select("tx", "ord", "value", "aid")
             .unionByName(shared.select("tx", "ord", "value", aid.alias("aid")).filter("aid IS NOT NULL")))
    if buckets:
        found = found.repartition(buckets, unpacked(F.col("tx")), F.col("ord"))
    return found.select(unpacked(F.col("tx")).alias("tx_hash"), "ord", "value", "aid")


def edges_indexed(ledger: Ledger, outputs: DataFrame, ids: VertexIds | None = None,
                  direction: str = "documented") -> DataFrame:
    """The ledger graph on dense ids; references outside the data are dropped. ``outputs`` may
    be resolved already (``resolve_addresses``)."""
    ids = ids or vertex_ids(ledger, outputs)
    tx = ids.transactions
    bk = ids.blocks.select("id", "hash")

    # transactions are looked up by the bytes of their hash
    def tx_id(col_name: str, alias: str) -> DataFrame:
        return tx.select(packed(F.col("hash")).alias(col_name), F.col("id").alias(alias))

    block_tx = (ledger.transactions.select(packed(F.col("hash")).alias("tx"), "block_hash")
                .join(tx_id("tx", "tid"), "tx")
                .join(bk.select(F.col("hash").alias("block_hash"), F.col("id").alias("bid")), "block_hash"))
    block_prev = (ledger.blocks.select("hash", "prev_hash")
                  .join(bk.select("hash", F.col("id").alias("bid")), "hash")
                  .join(bk.select(F.col("hash").alias("prev_hash"), F.col("id").alias("pid")), "prev_hash"))
    o = outputs if "aid" in outputs.columns else resolve_addresses(outputs, ids.addresses)
    tx_address = o.select(packed(F.col("tx_hash")).alias("tx"), "value", "aid").join(tx_id("tx", "tid"), "tx")
    sp = (spends(o.select("tx_hash", "ord", "value", "aid"), ledger.inputs)
          .select(packed(F.col("spent_by")).alias("tx"), "value", "aid").join(tx_id("tx", "sid"), "tx"))

    zero = F.lit(0)
    if direction == "legacy":
        e_block_tx = _edge(block_tx, F.col("tid"), F.col("bid"), zero, "block_tx")
        e_block_prev = _edge(block_prev, F.col("pid"), F.col("bid"), zero, "block_prev")
    else:
        e_block_tx = _edge(block_tx, F.col("bid"), F.col("tid"), zero, "block_tx")
        e_block_prev = _edge(block_prev, F.col("bid"), F.col("pid"), zero, "block_prev")
    return (e_block_tx
            .unionByName(_edge(sp, F.col("aid"), F.col("sid"), F.col("value"), "address_tx"))
            .unionByName(_edge(tx_address, F.col("tid"), F.col("aid"), F.col("value"), "tx_address"))
            .unionByName(e_block_prev))


def payment_edges_weighted(ledger: Ledger, outputs: DataFrame, address_ids: DataFrame | None = None,
                           flow: str = "payee_to_payer", graph: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """G3 aggregated: (src, dst, n) with n = multiplicity of the v1 address multigraph.

    For an output of tx T1 (payer address) spent in tx T2, every output of T2 (payee) gets one
    edge per input of T1. Both sides are pre-aggregated per (T2, address id) before the only
    per-transaction join, so its size is distinct payers × distinct payees per transaction,
    which is the size of the result itself. ``outputs`` are resolved, or are resolved here. With
    ``graph`` (t2, graph) every transaction's payments go to its graph: (graph, src, dst, n).

    With ``buckets`` the payers are written first, as a table of so many buckets by transaction, which the payees
    then meet in place: the shuffles that either side needs are not on disk together.
    """
    o = outputs if "aid" in outputs.columns else resolve_addresses(outputs, address_ids)
    # transactions are keyed by the bytes of their hash, and what is grouped within a transaction is
    # partitioned by it alone, as the join of the pairs needs it
    tx = lambda c: packed(F.col(c))
    parts = [buckets] if buckets else []
    n_in = ledger.inputs.groupBy(tx("tx_hash").alias("t1")).agg(F.count(F.lit(1)).alias("n_in"))
    payer = (spends(o.select("tx_hash", "ord", "aid"), ledger.inputs)
             .select(tx("tx_hash").alias("t1"), tx("spent_by").alias("t2"), F.col("aid").alias("payer"))
             .join(n_in, "t1")                            # T1 must have inputs (v1 flattening)
             .select("t2", "payer", "n_in").repartition(*parts, "t2")
             .groupBy("t2", "payer").agg(F.sum("n_in").alias("w")))
    if buckets:
        payer = bucketed_table(payer, "lg_payers", ["t2"], buckets, placed=True)[0]
    payee = (o.select(tx("tx_hash").alias("t2"), F.col("aid").alias("payee")).repartition(*parts, "t2")
             .groupBy("t2", "payee").agg(F.count(F.lit(1)).alias("c")))
    src, dst = ("payer", "payee") if flow == "money" else ("payee", "payer")
    pairs = payer.join(payee, "t2")
    by = []
    if graph is not None:
        pairs, by = pairs.join(graph.select(tx("t2").alias("t2"), "graph"), "t2"), ["graph"]
    return (pairs.groupBy(*by, F.col(src).alias("src"), F.col(dst).alias("dst"))
            .agg(F.sum(F.col("w") * F.col("c")).cast("long").alias("n")))


def expand_multigraph(weighted: DataFrame, chunk: int = 4096) -> DataFrame:
    """(src, dst, n) → n rows of (src, dst): the v1 multigraph with parallel edges.

    Two-level expansion — ⌈n / chunk⌉ chunks, then up to ``chunk`` rows each — so no single
    generated array exceeds a few thousand elements even for a very heavy pair.
    """
    n = F.col("n").cast("long")
    chunks = weighted.select("src", "dst", "n", F.explode(
        F.sequence(F.lit(0).cast("long"), F.ceil(n / chunk).cast("long") - 1)).alias("_c"))
    size = F.least(F.lit(chunk).cast("long"), n - F.col("_c") * chunk)
    return chunks.select("src", "dst", F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_k")).drop("_k")
