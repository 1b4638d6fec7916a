"""Spend matching and per-address aggregates.

All joins are equi-joins on the outpoint ``(tx_hash, ord) = (ref_hash, ref_ord)``, which is
unique per output, so they shuffle evenly. The hub pseudo-addresses (``anyone``, ``unknown``,
``unspendable``) only ever appear as *grouping* keys, where partial (map-side) aggregation
collapses them before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.functions.hashing import packed, unpacked
from ledgergraph.functions.script import with_address
from ledgergraph.schemas import Ledger


def _outpoint():
    return (F.col("o.tx_hash") == F.col("i.ref_hash")) & (F.col("o.ord") == F.col("i.ref_ord"))


def classified_outputs(ledger: Ledger, pubkey_digest: str = "hash160", outputs: DataFrame | None = None) -> DataFrame:
    """Outputs with ``address`` and ``kind`` (the script column is dropped unless asked for); ``outputs`` are
    the ledger's, if they are read in another way than as its table."""
    outputs = ledger.outputs if outputs is None else outputs
    if "address" in outputs.columns:
        return outputs
    return with_address(outputs, pubkey_digest).drop("script")


def spent_outputs(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Every output with the spending transaction (``spent_by``, null when unspent)."""
    return (outputs.alias("o")
            .join(inputs.select("tx_hash", "ref_hash", "ref_ord").alias("i"), _outpoint(), "left")
            .select("o.*", F.col("i.tx_hash").alias("spent_by")))


def spends(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Matched (output, spending input) pairs — inputs referencing unknown txs drop out."""
    return (outputs.alias("o")
            .join(inputs.select("tx_hash", "ref_hash", "ref_ord").alias("i"), _outpoint(), "inner")
            .select("o.*", F.col("i.tx_hash").alias("spent_by")))


def utxo(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Outputs no input spends (left anti join on the outpoint)."""
    return (outputs.alias("o")
            .join(inputs.select("ref_hash", "ref_ord").alias("i"), _outpoint(), "left_anti"))


def balances(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """A3: balance per address = sum of its unspent output values."""
    return (utxo(outputs, inputs).groupBy("address")
            .agg(F.sum("value").alias("balance"), F.count(F.lit(1)).alias("n_utxo")))


def distinct_addresses(outputs: DataFrame) -> DataFrame:
    """A1."""
    return outputs.select("address").distinct()


def address_kinds(outputs: DataFrame) -> DataFrame:
    return outputs.select("address", "kind").distinct()


def address_profile(outputs: DataFrame) -> DataFrame:
    """Per kind, number of outputs and of distinct addresses (one pass)."""
    return outputs.groupBy("kind").agg(F.count(F.lit(1)).alias("n_outputs"),
                                       F.countDistinct("address").alias("n_addresses"))


def address_totals(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """A4: total received, total sent, final balance and number of transactions per address.

    n_tx counts distinct transactions among those paying the address and those spending
    its outputs.
    """
    so = spent_outputs(outputs.select("tx_hash", "ord", "value", "address"), inputs)
    # one pass: each output contributes (paying tx, value received, value sent) and
    # (spending tx, 0, 0); the distinct count is planned as (address, tx) then address —
    # both partially aggregated, so a hot address is combined before the shuffle
    zero = F.lit(0).cast("long")
    # addresses and transactions are grouped and counted as bytes
    tx = lambda c: packed(F.col(c)).alias("tx")
    legs = so.select(packed(F.col("address")).alias("address"), F.explode(F.array(
        F.struct(tx("tx_hash"), F.col("value").alias("recv"),
                 F.when(F.col("spent_by").isNotNull(), F.col("value")).otherwise(zero).alias("sent")),
        F.struct(tx("spent_by"), zero.alias("recv"), zero.alias("sent")))).alias("leg"))
    return (legs.groupBy("address")
            .agg(F.sum("leg.recv").alias("total_received"), F.sum("leg.sent").alias("total_sent"),
                 F.countDistinct("leg.tx").alias("n_tx"))
            .select(unpacked(F.col("address")).alias("address"), "total_received", "total_sent",
                    (F.col("total_received") - F.col("total_sent")).alias("final_balance"), "n_tx"))


def first_seen(outputs: DataFrame, transactions: DataFrame) -> DataFrame:
    """A5: first time an address received an output (min transaction time)."""
    return (outputs.select(packed(F.col("tx_hash")).alias("tx"), packed(F.col("address")).alias("key"))
            .join(transactions.select(packed(F.col("hash")).alias("tx"), "time"), "tx")
            .groupBy("key").agg(F.min("time").alias("first_seen"))
            .select(unpacked(F.col("key")).alias("address"), "first_seen"))


def flat_size(transactions: DataFrame, outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Per block, Σ over its transactions of n_inputs × n_outputs (the v1 flat row count)."""
    n_out = outputs.groupBy(F.col("tx_hash").alias("hash")).agg(F.count(F.lit(1)).alias("n_out"))
    n_in = inputs.groupBy(F.col("tx_hash").alias("hash")).agg(F.count(F.lit(1)).alias("n_in"))
    per_tx = (transactions.select("hash", "block_hash")
              .join(n_out, "hash", "left").join(n_in, "hash", "left")
              .select("block_hash", (F.coalesce("n_in", F.lit(0)) * F.coalesce("n_out", F.lit(0)))
                      .alias("flat")))
    return per_tx.groupBy("block_hash").agg(F.sum("flat").cast("long").alias("flat_size"),
                                           F.count(F.lit(1)).alias("n_tx"))


def duplicate_hashes(transactions: DataFrame) -> DataFrame:
    """Quality check: transaction hashes occurring more than once (they would fan out every
    hash join). Empty on a clean ledger."""
    return (transactions.groupBy("hash").agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))
