"""The conversion job — block files → ledger tables, vertex-id tables and edge tables.

    spark-submit --py-files ledgergraph.zip convert_job.py <input> <output> [debug] [keep] [atomic]

Output folders (Parquet, gzip, overwrite so a re-run is idempotent):

  ledger/{blocks,transactions,outputs,inputs}   flat ledger (outputs carry address and kind)
  addresses, blocks, transactions               (id, address) / (id, hash, time) / (id, hash)
  edges                                         indexed ledger graph (src, dst, value, edge_kind)
  edges_named                                   the same graph on readable keys
  payment_edges                                 the weighted payment graph on the ids in addresses

  rejects                                       (file, offset, length, reason) of unread bytes

With ``atomic`` (argument ``atomic``) the folders belong to a version that readers do not know until
one manifest, written last, names them all: whoever reads with ``sources.versions.Versions(spark, out)
.read("edges")`` sees the tables of the last whole run, never some of this and some of that one. Older
versions are deleted after the commit, the last ``keep_versions`` stay.

Damaged block files end the job before a table is written; ``on_damage="keep"`` (fourth argument
``keep``) converts every good block and reports the number of rejects.

The parsed blocks are staged once as Parquet (in ``spark.checkpoint.dir``) and the ledger tables are derived
from that copy, reading only the columns it needs: files are never parsed twice and a lost executor
re-reads the copy instead of re-parsing. All other tables are derived from the ledger tables as written, when
the copy is deleted. The other scratch tables are deleted when the job ends.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgergraph.functions.hashing import placed_as_bytes
from ledgergraph.functions.script import KINDS, with_address
from ledgergraph.operators import edges as E
from ledgergraph.operators.sampling import sample_rows
from ledgergraph.schemas import Ledger
from ledgergraph.session import bucketed_table, ensure_checkpoint_dir, release_scratch, scratch_tables, ship_package
from ledgergraph.sources.blockfile import blocks_of, flatten, rejects_of
from ledgergraph.sources.blockranges import RANGE_BYTES, scan_blocks
from ledgergraph.sources.io import LEDGER_TABLES, write_ledger, write_table
from ledgergraph.sources.star import ledger_buckets
from ledgergraph.sources.versions import Versions


def convert(spark: SparkSession, input_path: str, output_dir: str, glob: str = "blk*.dat",
            debug: int = 0, direction: str = "documented", compression: str = "gzip",
            edge_files: int | None = None, table_db: str | None = None,
            on_damage: str = "fail", atomic: bool = False, keep_versions: int = 2,
            range_bytes: int = RANGE_BYTES) -> dict[str, int]:
    """Run the conversion, reading files as ranges of ``range_bytes``. With ``table_db`` the outputs and inputs are also registered in that
    metastore database as tables bucketed on the outpoint (``ledger_outputs`` on
    (tx_hash, ord), ``ledger_inputs`` on (ref_hash, ref_ord), same bucket count), so later
    sessions sharing the metastore join spends without shuffling either table."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    before = scratch_tables(spark)
    try:
        if not atomic:
            return _convert(spark, input_path, output_dir, glob, debug, direction, compression, edge_files, table_db,
                            on_damage, range_bytes)
        versions = Versions(spark, output_dir)
        base, draft = versions.manifest()["version"], versions.draft()
        stats = _convert(spark, input_path, f"{output_dir}/{draft}", glob, debug, direction, compression, edge_files,
                         table_db, on_damage, range_bytes)
        versions.publish({name: [f"{draft}/{name}"] for name in TABLES}, base)
        versions.collect(keep_versions)
        return stats
    finally:
        release_scratch(spark, since=before)


#: what a run writes
TABLES = ("rejects", *(f"ledger/{t}" for t in LEDGER_TABLES), "addresses", "blocks", "transactions", "edges", "edges_named",
          "payment_edges")


def _convert(spark: SparkSession, input_path: str, output_dir: str, glob: str, debug: int, direction: str,
             compression: str, edge_files: int | None, table_db: str | None, on_damage: str,
             range_bytes: int) -> dict[str, int]:
    before = scratch_tables(spark)
    scan, damaged = scan_blocks(spark, input_path, glob, range_bytes=range_bytes, on_damage=on_damage)
    write_table(rejects_of(scan), f"{output_dir}/rejects", compression=compression)
    flat = flatten(blocks_of(scan))
    # what the debug report counts is counted while it is written
    kinds, edges, odd = Observation("kinds"), Observation("edges"), Observation("addresses")
    flat = flat._replace(outputs=with_address(flat.outputs))
    write_ledger(flat._replace(outputs=_counted(flat.outputs, kinds, "kind", KINDS)), f"{output_dir}/ledger", compression=compression)
    # from here on the ledger is what was written; the parsed copy goes
    ledger = Ledger(*(spark.read.schema(df.schema).parquet(f"{output_dir}/ledger/{name}") for name, df in zip(LEDGER_TABLES, flat)))
    release_scratch(spark, since=before)

    if table_db:
        write_outpoint_tables(spark, ledger, output_dir, table_db)

    # all graphs match spends: outputs and inputs are shuffled to their outpoint once, not by every match
    n = ledger_buckets(spark, ledger.outputs.count())
    outs = bucketed_table(placed_as_bytes(ledger.outputs.drop("script"), n, ["tx_hash", "ord"], ["tx_hash", "address"]),
                          "lg_outputs", ["tx_hash", "ord"], n, placed=True)[0]
    ledger = ledger._replace(inputs=bucketed_table(
        placed_as_bytes(ledger.inputs, n, ["ref_hash", "ref_ord"], ["tx_hash", "ref_hash"]), "lg_inputs", ["ref_hash", "ref_ord"], n, placed=True)[0])
    ids = E.vertex_ids(ledger, outs)
    write_table(ids.addresses.observe(odd, F.count(F.when(F.col("address").contains("_"), 1)).alias("n")),
                f"{output_dir}/addresses", compression=compression)
    write_table(ids.blocks, f"{output_dir}/blocks", compression=compression)
    write_table(ids.transactions, f"{output_dir}/transactions", compression=compression)
    resolved = bucketed_table(E.resolve_addresses(outs, ids.addresses, n), "lg_resolved", ["tx_hash", "ord"], n, placed=True)[0]
    write_table(E.edges_indexed(ledger, resolved, ids, direction=direction), f"{output_dir}/edges",
                compression=compression, num_files=edge_files)
    write_table(_counted(E.edges_named(ledger, outs, direction=direction), edges, "edge_kind", E.EDGE_KINDS),
                f"{output_dir}/edges_named", compression=compression, num_files=edge_files)
    write_table(E.payment_edges_weighted(ledger, resolved, buckets=n), f"{output_dir}/payment_edges",
                compression=compression)

    stats: dict[str, int] = {"damaged": damaged} if damaged else {}
    if debug >= 1:
        stats.update({f"edges_{k}": n for k, n in edges.get.items() if n})
        stats.update({f"kind_{k}": n for k, n in kinds.get.items() if n})
        stats["nonstandard_addresses"] = odd.get["n"]
        print(stats)
    if debug >= 2:
        sample_rows(outs, 0.001, 5, seed=1).show(truncate=False)
    return stats


def _counted(df: DataFrame, into: Observation, column: str, values: tuple[str, ...]) -> DataFrame:
    """``df``, whose rows are counted per value of ``column`` by whatever action runs it first."""
    return df.observe(into, *[F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values])


def write_outpoint_tables(spark: SparkSession, ledger: Ledger, output_dir: str, db: str) -> None:
    n = ledger_buckets(spark, ledger.outputs.count())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, df, keys in (("ledger_outputs", ledger.outputs, ["tx_hash", "ord"]),
                           ("ledger_inputs", ledger.inputs, ["ref_hash", "ref_ord"])):
        (df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys)
         .option("path", f"{output_dir}/tables/{name}").saveAsTable(f"{db}.{name}"))


def main(argv: list[str] | None = None) -> None:
    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) < 2:
        raise SystemExit("usage: job <input path> <output dir> [debug] [keep] [atomic]")
    spark = SparkSession.builder.appName("ledgergraph-convert").getOrCreate()
    convert(spark, args[0], args[1], debug=int(args[2]) if len(args) > 2 else 0,
            on_damage="keep" if "keep" in args[3:] else "fail", atomic="atomic" in args[3:])
    spark.stop()


if __name__ == "__main__":
    main()
