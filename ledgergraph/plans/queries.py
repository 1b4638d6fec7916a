"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator of the inventory.

Every query derives the ledger from the star tables in ``sf_dir`` and runs over whole tables.
Within one session the derived tables a query needs (the materialised ledger, classified
outputs, vertex ids, the payment graph, ranks, chain heights) are built once and shared by
the queries that need them, as a user session would reuse them.
P2PK addresses are hash160 (RIPEMD-160 of SHA-256) of the public key, as in the reference;
the SQL oracle computes the same digest itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgergraph.functions.hashing import (display_hash, double_sha256, hash160_hex, hash160_to_address, packed, tagged_hash,
                                           unpacked)
from ledgergraph.functions.script import LEGACY_ADDRESS_PREFIX, pubkey_bytes, script_kind, with_address
from ledgergraph.functions.text import (block_record_text, input_record_text, json_fields, nested_tx_text,
                                        output_record_text, parse_id_list, ref_text, tx_record_text)
from ledgergraph.operators import edges as E
from ledgergraph.operators import ledger as L
from ledgergraph.operators.chain import block_drilldown, block_listing, chain_height, main_chain
from ledgergraph.operators.incremental import UtxoStore
from ledgergraph.operators.neighbours import graph_elements, neighbourhood
from ledgergraph.operators.pagerank import graph_counts, graph_vertices, pagerank, pagerank_by_graph, top_k
from ledgergraph.operators.report import address_report, usd_columns
from ledgergraph.operators.sampling import clean_nodes, poisson_by_hash, sample_by_hash
from ledgergraph.operators.snapshots import balances_by_snapshot, payment_edges_by_snapshot, snapshot_counts, snapshot_of
from ledgergraph.operators.subgraph import seed_documents
from ledgergraph.plans.job import convert
from ledgergraph.schemas import Ledger
from ledgergraph.session import (bucketed_table, drop_scratch, release_scratch, scratch_folder, scratch_tables, staged, staged_alone,
                                 write_scratch)
from ledgergraph.sources.blockfile import MAINNET_MAGIC, SCAN, blocks_of, flatten, parser, rejects_of
from ledgergraph.sources.blockranges import scan_ranges
from ledgergraph.sources.encode import block_files, transactions, write_block_files
from ledgergraph.sources.io import part_range, read_ledger, read_listing, write_ledger, write_listing, write_table
from ledgergraph.sources.io import read_table as read_parquet
from ledgergraph.sources.star import ledger_buckets, ledger_from_dir, ledger_key, read_table, release_ledgers
from ledgergraph.sources.versions import Versions

EDGES_PER_FILE = 4_000_000
IDS_PER_TEXT = 256

ORACLE_DIGEST = "hash160"


# What a session has built, by ledger (and kind of result): emptied by ``release``.
_BUILT: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    """``build()``, once per session and version of the input."""
    key = (what, *ledger_key(spark, sf_dir))
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def release(spark: SparkSession) -> None:
    """Forget everything the queries have built and delete its tables."""
    _BUILT.clear()
    release_ledgers()
    release_scratch(spark)


def _ledger(spark: SparkSession, sf_dir: str, digest: str = ORACLE_DIGEST) -> tuple[Ledger, DataFrame]:
    """The materialised ledger and its classified outputs (classified once per ledger)."""
    ledger = ledger_from_dir(spark, sf_dir)

    def build():
        # in the buckets of the outpoint, like the ledger's inputs: spend joins stay shuffle-free
        outs = L.classified_outputs(ledger, digest, ledger.placed_outputs)
        return bucketed_table(outs, "lg_classified", ["tx_hash", "ord"], ledger.buckets, placed=True)[0]
    return ledger, _once(spark, sf_dir, f"classified-{digest}", build)


def q_balances(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return L.balances(outs, ledger.inputs)


def q_blocks(spark, sf_dir):
    return ledger_from_dir(spark, sf_dir).blocks


def q_transactions(spark, sf_dir):
    return ledger_from_dir(spark, sf_dir).transactions


def q_outputs(spark, sf_dir):
    ledger = ledger_from_dir(spark, sf_dir)
    return (with_address(ledger.outputs, ORACLE_DIGEST)
            .select("tx_hash", "ord", "value", F.hex("script").alias("script_hex"), "address", "kind"))


def q_inputs(spark, sf_dir):
    return ledger_from_dir(spark, sf_dir).inputs


def q_address_kind(spark, sf_dir):
    return L.address_kinds(_ledger(spark, sf_dir)[1])


def q_address_profile(spark, sf_dir):
    return L.address_profile(_ledger(spark, sf_dir)[1])


def q_addresses(spark, sf_dir):
    return L.distinct_addresses(_ledger(spark, sf_dir)[1])


def q_spent_outputs(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return L.spent_outputs(outs.select("tx_hash", "ord", "value", "address"), ledger.inputs)


def q_utxo(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return L.utxo(outs.select("tx_hash", "ord", "value", "address"), ledger.inputs)


def q_address_totals(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return L.address_totals(outs, ledger.inputs)


def q_first_seen(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return L.first_seen(outs, ledger.transactions)


def q_tx_flat_size(spark, sf_dir):
    ledger = ledger_from_dir(spark, sf_dir)
    return L.flat_size(ledger.transactions, ledger.outputs, ledger.inputs)


def q_edges_named(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return E.edges_named(ledger, outs)


def q_edge_counts(spark, sf_dir):
    ledger, outs = _ledger(spark, sf_dir)
    return E.edge_counts(E.edges_named(ledger, outs))


def _vertex_ids(spark, sf_dir) -> tuple[Ledger, DataFrame, E.VertexIds]:
    ledger, outs = _ledger(spark, sf_dir)
    return ledger, outs, _once(spark, sf_dir, "ids", lambda: E.vertex_ids(ledger, outs))


def _resolved(spark, sf_dir) -> DataFrame:
    """Outputs with the ids of their addresses, bucketed on the outpoint: what both graphs start from."""
    ledger, outs, ids = _vertex_ids(spark, sf_dir)

    def build():
        rows = E.resolve_addresses(outs, ids.addresses, ledger.buckets)
        return bucketed_table(rows, "lg_resolved", ["tx_hash", "ord"], ledger.buckets, placed=True)[0]
    return _once(spark, sf_dir, "resolved", build)


def q_address_ids(spark, sf_dir):
    return _vertex_ids(spark, sf_dir)[2].addresses


def q_block_ids(spark, sf_dir):
    return _vertex_ids(spark, sf_dir)[2].blocks


def q_tx_ids(spark, sf_dir):
    return _vertex_ids(spark, sf_dir)[2].transactions


def q_edges_indexed(spark, sf_dir):
    ledger, _, ids = _vertex_ids(spark, sf_dir)
    return E.edges_indexed(ledger, _resolved(spark, sf_dir), ids)


def q_edges_indexed_legacy(spark, sf_dir):
    """U2 in the order of the long-key converter: block edges reversed."""
    ledger, _, ids = _vertex_ids(spark, sf_dir)
    return E.edges_indexed(ledger, _resolved(spark, sf_dir), ids, direction="legacy")


def q_payment_edges_weighted(spark, sf_dir):
    return _payment_graph(spark, sf_dir)[3]


def q_payment_edges(spark, sf_dir):
    return E.expand_multigraph(_payment_graph(spark, sf_dir)[3])


def q_p2pk_addresses(spark, sf_dir):
    """hash160 of every distinct P2PK public key and its Base58Check address."""
    ledger = ledger_from_dir(spark, sf_dir)
    s = F.col("script")
    keys = (ledger.outputs.filter(script_kind(s) == "p2pk")
            .select(pubkey_bytes(s).alias("pubkey")).distinct())
    return (keys.withColumn("hash160", hash160_hex(F.col("pubkey")))
            .select(F.hex("pubkey").alias("pubkey_hex"), "hash160",
                    hash160_to_address(F.col("hash160")).alias("base58")))


def _payment_graph(spark, sf_dir):
    """Address ids and the weighted payment graph, built once per materialised ledger."""
    ledger, outs, ids = _vertex_ids(spark, sf_dir)

    def build():
        resolved, _ = _resolved(spark, sf_dir), ledger.inputs       # others share these: not deleted with the payers
        return staged_alone(spark, lambda: E.payment_edges_weighted(ledger, resolved, buckets=ledger.buckets), "lg_payments")
    w = _once(spark, sf_dir, "payments", build)
    return ledger, outs, ids.addresses, w


def _ranks(spark, sf_dir) -> DataFrame:
    _, _, addr, w = _payment_graph(spark, sf_dir)
    return _once(spark, sf_dir, "ranks", lambda: pagerank(graph_vertices(addr, w), w, distinct_pairs=True))


def q_pagerank(spark, sf_dir):
    """G5 on the address payment graph (tolerance 0.001); rank rounded to 6 decimals."""
    _, _, addr, w = _payment_graph(spark, sf_dir)
    return (_ranks(spark, sf_dir).join(addr, "id", "left")
            .select("id", "address", F.round("rank", 6).alias("rank")))


def star_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(nodes, weighted edges) of the customer → supplier → part graph of the star tables:
    edges weighted by line items; ids are kind × 10^9 + key."""
    li = (read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
          .join(read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                           "o_custkey"), "l_orderkey"))
    supplier = F.lit(1_000_000_000) + F.col("l_suppkey")
    part = F.lit(2_000_000_000) + F.col("l_partkey")
    edges = (li.groupBy(F.col("o_custkey").alias("src"), supplier.alias("dst")).agg(F.count(F.lit(1)).alias("n"))
             .unionByName(li.groupBy(supplier.alias("src"), part.alias("dst"))
                          .agg(F.count(F.lit(1)).alias("n"))))
    nodes = (read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
             .unionByName(read_table(spark, sf_dir, "supplier")
                          .select((F.lit(1_000_000_000) + F.col("s_suppkey")).alias("id")))
             .unionByName(read_table(spark, sf_dir, "part")
                          .select((F.lit(2_000_000_000) + F.col("p_partkey")).alias("id"))))
    return nodes, staged(edges, "lg_star_edges")


def q_star_pagerank(spark, sf_dir):
    """G4/G5 on the customer → supplier → part graph of the star tables; rank rounded to 6."""
    nodes, edges = star_graph(spark, sf_dir)
    return (pagerank(graph_vertices(nodes, edges), edges, distinct_pairs=True)
            .select("id", F.round("rank", 6).alias("rank")))


def q_graph_counts(spark, sf_dir):
    """Vertex and edge counts of the payment graph PageRank runs on."""
    _, _, addr, w = _payment_graph(spark, sf_dir)
    return graph_counts(graph_vertices(addr, w), w)


def q_top_addresses(spark, sf_dir):
    """The ten highest-ranked addresses."""
    _, _, addr, w = _payment_graph(spark, sf_dir)
    return top_k(_ranks(spark, sf_dir), addr, k=10)


def q_address_report(spark, sf_dir):
    """Top ten by rank with received / sent / balance as dollar text and tx count."""
    ledger, outs, addr, w = _payment_graph(spark, sf_dir)
    top = top_k(_ranks(spark, sf_dir), addr, k=10)
    # totals only for the ten reported addresses: restrict their outputs first (semi-join
    # against a k-row table) instead of aggregating every address and joining afterwards
    mine = outs.join(top.select("address"), "address", "left_semi")
    return address_report(top, L.address_totals(mine, ledger.inputs))


def q_usd_format(spark, sf_dir):
    """F15–F17 over every address balance."""
    ledger, outs = _ledger(spark, sf_dir)
    return usd_columns(L.address_totals(outs, ledger.inputs))


def q_json_fields(spark, sf_dir):
    """a field of the JSON ``props`` object of every event (null when unparsable)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id",
                     json_fields(F.col("props"), {"k": T.LongType()}).getField("k").alias("k"))


def q_tx_text(spark, sf_dir):
    """every transaction rendered as the converter's record text (UTC times)."""
    t = ledger_from_dir(spark, sf_dir).transactions
    return t.select("hash", tx_record_text(F.col("hash"), F.col("time"), F.col("block_hash")).alias("text"))


def _heights(spark, sf_dir) -> DataFrame:
    ledger = ledger_from_dir(spark, sf_dir)
    return _once(spark, sf_dir, "heights", lambda: chain_height(ledger.blocks))


def q_chain_height(spark, sf_dir):
    """Height of every block along the prev-hash chain (pointer doubling)."""
    return _heights(spark, sf_dir)


def q_block_listing(spark, sf_dir):
    """The height-ordered hash listing."""
    return block_listing(_heights(spark, sf_dir))


def q_block_drilldown(spark, sf_dir):
    """Transactions of the first three listed blocks with their inputs and outputs."""
    ledger, outs = _ledger(spark, sf_dir)
    return block_drilldown(_heights(spark, sf_dir), ledger.transactions, outs, ledger.inputs, k=3)


def _seeds(ledger, outs, addr):
    # the address that received most: a plain per-address sum, no spend join needed
    top = (outs.groupBy("address").agg(F.sum("value").alias("total_received"))
           .orderBy(F.desc("total_received"), F.asc("address")).limit(1))
    return addr.join(F.broadcast(top.select("address")), "address").select("id")   # bound: 1 row


def q_neighbourhood(spark, sf_dir):
    """The top-receiving address and all its payment-graph neighbours."""
    ledger, outs, addr, w = _payment_graph(spark, sf_dir)
    kept = neighbourhood(w, _seeds(ledger, outs, addr))
    return kept.join(addr, "id").select("id", "address", "role")


def q_graph_json(spark, sf_dir):
    """node/edge JSON documents of the payment graph, neighbourhood highlighted."""
    ledger, outs, addr, w = _payment_graph(spark, sf_dir)
    kept = _once(spark, sf_dir, "kept", lambda: staged(neighbourhood(w, _seeds(ledger, outs, addr)), "lg_kept"))
    return graph_elements(addr, w, kept)


def q_clean_nodes(spark, sf_dir):
    """A positional node table, addresses with the old converters' prefix (ids that are
    multiples of 3) and nulls (multiples of 7) among them, cleaned to (id, address)."""
    ids = _vertex_ids(spark, sf_dir)[2].addresses
    raw = ids.select("id", F.when(F.col("id") % 7 == 0, F.lit(None)).when(
        F.col("id") % 3 == 0, F.concat(F.lit(LEGACY_ADDRESS_PREFIX), "address")).otherwise(F.col("address")))
    return clean_nodes(raw.toDF("_1", "_2"))


def q_sample_outputs(spark, sf_dir):
    """A repeatable sample of one output in a hundred, its first 20 rows."""
    _, outs = _ledger(spark, sf_dir)
    return sample_by_hash(outs.select("tx_hash", "ord", "value", "address", "kind"), ["tx_hash", "ord"], 0.01, 20)


def q_balances_by_snapshot(spark, sf_dir):
    """Unspent balance per snapshot (year of the paying transaction) and address."""
    ledger, outs = _ledger(spark, sf_dir)
    return balances_by_snapshot(outs, ledger.inputs, ledger.transactions)


def q_snapshot_counts(spark, sf_dir):
    """Per snapshot (block year): blocks, transactions, outputs, inputs, value."""
    return snapshot_counts(ledger_from_dir(spark, sf_dir))


def q_nonstandard_addresses(spark, sf_dir):
    """P9/A7 debug profile: addresses carrying a ``_`` (the puzzle_ prefix) with their outputs."""
    _, outs = _ledger(spark, sf_dir)
    return (outs.filter(F.col("address").contains("_"))
            .groupBy("address").agg(F.count(F.lit(1)).alias("n_outputs")))


def q_duplicate_tx_hashes(spark, sf_dir):
    """Quality check: repeated transaction hashes, in a table where every hash that ends in 00 was
    written twice more."""
    txs = ledger_from_dir(spark, sf_dir).transactions.select("hash")
    again = txs.filter(F.col("hash").endswith("00"))
    return L.duplicate_hashes(txs.unionByName(again).unionByName(again))


def _parsed(spark, sf_dir) -> DataFrame:
    """Block files built from orders and line items, parsed with the file reader's parser."""
    def build():
        files = block_files(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))
        return staged(files.mapInArrow(parser(MAINNET_MAGIC), SCAN), "lg_parsed")
    return _once(spark, sf_dir, "parsed", build)


def _ledger_rows(scan: DataFrame) -> DataFrame:
    """One row per block, transaction, output and input of a scan."""
    ledger = flatten(blocks_of(scan))
    none, zero = F.lit(""), F.lit(0).cast("long")

    def rows(df, item, hash_, parent, n, value, script):
        return df.select(F.lit(item).alias("item"), hash_.alias("hash"), parent.alias("parent"), n.cast("long").alias("n"),
                         value.alias("value"), script.alias("script"))
    c = F.col
    return (rows(ledger.blocks, "block", c("hash"), c("prev_hash"), c("time"), zero, none)
            .unionByName(rows(ledger.transactions, "tx", c("hash"), c("block_hash"), c("time"), zero, none))
            .unionByName(rows(ledger.outputs, "output", c("tx_hash"), none, c("ord"), c("value"), F.hex("script")))
            .unionByName(rows(ledger.inputs, "input", c("tx_hash"), c("ref_hash"), c("ref_ord"), zero, none)))


def _reject_rows(scan: DataFrame) -> DataFrame:
    return (rejects_of(scan).groupBy(F.regexp_extract("file", "[^/]+$", 0).alias("file"), "reason")
            .agg(F.count(F.lit(1)).alias("places"), F.sum("length").alias("bytes")))


def q_ingest_ledger(spark, sf_dir):
    """Serialised blocks parsed and flattened into the four ledger tables, one row per
    block, transaction, output and input."""
    return _ledger_rows(_parsed(spark, sf_dir))


def _block_folder(spark, sf_dir) -> tuple[str, int]:
    """The block files of ``_parsed`` as files of a folder, and the size of the ranges to read them in: several
    a file, and not more than some thousands however large the tables are."""
    def build():
        folder = f"{scratch_folder(spark, 'lg_files')}/blocks"
        files = block_files(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))
        return folder, max(1 << 18, write_block_files(files, folder) // 4096)
    return _once(spark, sf_dir, "files", build)


def _ranges(spark, sf_dir) -> DataFrame:
    folder, size = _block_folder(spark, sf_dir)
    return _once(spark, sf_dir, "ranges", lambda: scan_ranges(spark, folder, range_bytes=size))


def q_ingest_ranges(spark, sf_dir):
    """The same blocks written as files and read as byte ranges of them, several tasks a file."""
    return _ledger_rows(_ranges(spark, sf_dir))


def q_ingest_ranges_rejects(spark, sf_dir):
    """What the ranges of those files report as no blocks."""
    return _reject_rows(_ranges(spark, sf_dir))


def _converted(spark, sf_dir) -> str:
    """The folder of a conversion of those files, published as one version after another one (a re-run)."""
    def build():
        folder, size = _block_folder(spark, sf_dir)
        out = f"{scratch_folder(spark, 'lg_converted')}/out"
        for _ in range(2):
            convert(spark, folder, out, on_damage="keep", atomic=True, keep_versions=1, range_bytes=size)
        return out
    return _once(spark, sf_dir, "converted", build)


#: columns of the tables that a conversion writes, as the checksums read them
JOB_COLUMNS = {"ledger/blocks": ["hash", "prev_hash", "time"], "ledger/transactions": ["hash", "block_hash", "time"],
               "ledger/outputs": ["tx_hash", "ord", "value", "address", "kind"], "ledger/inputs": ["tx_hash", "ref_hash", "ref_ord"],
               "addresses": ["id", "address"], "blocks": ["id", "hash", "time"], "transactions": ["id", "hash"],
               "edges": ["src", "dst", "value", "edge_kind"], "edges_named": ["src", "dst", "value", "edge_kind"],
               "payment_edges": ["src", "dst", "n"], "rejects": ["reason", "length"]}


def q_job_tables(spark, sf_dir):
    """Every table that the conversion job published from block files: rows and a checksum of all
    their columns; then those of a table written over it with ``errorifexists``, which must be refused."""
    root = _converted(spark, sf_dir)
    versions = Versions(spark, root)

    def summed(name, df, columns):
        h = F.substring(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256), 1, 8)
        return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.conv(h, 16, 10).cast("long")), F.lit(0)).alias("checksum")).select(
            F.lit(name).alias("table"), "n", "checksum")
    out = None
    for name, columns in JOB_COLUMNS.items():
        part = summed(name, versions.read(name), columns)
        out = part if out is None else out.unionByName(part)
    folder = versions.manifest()["tables"]["blocks"][0]
    try:
        write_table(versions.read("blocks").limit(0), f"{root}/{folder}", mode="errorifexists")
        refused = "overwritten"
    except AnalysisException:
        refused = "blocks, written again"
    return out.unionByName(summed(refused, versions.read("blocks"), JOB_COLUMNS["blocks"]))


def q_ingest_rejects(spark, sf_dir):
    """The bytes of the same files that are no blocks: per file and reason, places and bytes."""
    return _reject_rows(_parsed(spark, sf_dir))


def q_tx_hashes(spark, sf_dir):
    """hash of every serialised transaction by column functions: SHA-256 twice, byte-reversed."""
    txs = transactions(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))
    return txs.select("o_orderkey", display_hash(double_sha256(F.unhex("tx"))).alias("hash"))


def _edge_files(spark, sf_dir) -> int:
    """Files of the job's edges. A transaction, output, input or block makes one edge at most."""
    ledger, outs, _ = _vertex_ids(spark, sf_dir)
    # the classified outputs are the ledger's, whose own table need not be written for their number
    return max(4, -(-sum(t.count() for t in (ledger.blocks, ledger.transactions, outs, ledger.inputs)) // EDGES_PER_FILE))


def _job_output(spark, sf_dir) -> str:
    """The edges and the ledger tables as the job writes them into the shared folder; the blocks
    are written over once more (a re-run overwrites)."""
    def build():
        ledger, outs, ids = _vertex_ids(spark, sf_dir)
        root = scratch_folder(spark, "lg_job")
        write_table(E.edges_indexed(ledger, _resolved(spark, sf_dir), ids), f"{root}/edges", num_files=_edge_files(spark, sf_dir))
        write_ledger(Ledger(ledger.blocks, ledger.transactions, outs, ledger.inputs), f"{root}/ledger")
        write_table(ledger.blocks, f"{root}/ledger/blocks")
        return root
    return _once(spark, sf_dir, "job", build)


def q_job_edges_roundtrip(spark, sf_dir):
    """The indexed edges written as gzip files, four at least and more with the edges, and read
    by a range of file names."""
    return read_parquet(spark, f"{_job_output(spark, sf_dir)}/edges", glob=part_range(_edge_files(spark, sf_dir)))


def q_job_ledger_roundtrip(spark, sf_dir):
    """Balances from the ledger tables the job wrote."""
    ledger = read_ledger(spark, f"{_job_output(spark, sf_dir)}/ledger")
    # these tables are not bucketed: their outpoints and addresses are shuffled as bytes
    outs = ledger.outputs.select(packed(F.col("tx_hash")).alias("tx_hash"), "ord", "value", packed(F.col("address")).alias("address"))
    ins = ledger.inputs.select(packed(F.col("ref_hash")).alias("ref_hash"), "ref_ord")
    return L.balances(outs, ins).withColumn("address", unpacked(F.col("address")))


def q_listing_roundtrip(spark, sf_dir):
    """The hash listing written as text in height order and read back with line numbers."""
    def build():
        path = f"{scratch_folder(spark, 'lg_listing')}/listing"
        write_listing(_heights(spark, sf_dir), path)
        return path
    return read_listing(spark, _once(spark, sf_dir, "listing", build))


def q_block_tx_ids(spark, sf_dir):
    """the transaction ids of every block, taken out of their text form."""
    ledger = ledger_from_dir(spark, sf_dir)
    heights = _heights(spark, sf_dir).select(F.col("hash").alias("block_hash"), "height")
    # texts as the command-line tool prints them, of about IDS_PER_TEXT ids: a block of any size is many texts
    sizes = ledger.transactions.groupBy("block_hash").agg(F.ceil(F.count(F.lit(1)) / IDS_PER_TEXT).alias("texts"))
    texts = (ledger.transactions.join(sizes, "block_hash")
             .groupBy("block_hash", F.pmod(F.xxhash64("hash"), F.col("texts")).alias("text_no"))
             .agg(F.concat(F.lit("[\n  \""), F.array_join(F.array_sort(F.collect_list("hash")), "\",\n  \""),
                           F.lit("\"\n]")).alias("text")))
    return texts.join(heights, "block_hash").select("height", F.explode(parse_id_list(F.col("text"))).alias("hash"))


def q_address_json(spark, sf_dir):
    """five named fields out of the JSON document of every address; empty text and -1 where it can't
    be parsed (every document whose address ends in 0 is cut short)."""
    ledger, outs = _ledger(spark, sf_dir)
    doc = F.to_json(F.struct("address", "total_received", "total_sent", "final_balance", "n_tx"))
    docs = L.address_totals(outs, ledger.inputs).select(
        F.col("address").alias("key"), F.when(F.col("address").endswith("0"), F.substring(doc, 1, 20)).otherwise(doc).alias("doc"))
    long, text = T.LongType(), T.StringType()
    return docs.select("key", json_fields(F.col("doc"), {"address": text, "total_received": long, "total_sent": long,
                                                        "final_balance": long, "n_tx": long}).alias("j")) \
        .select("key", "j.*").na.fill("", ["address"]).na.fill(-1)


def q_block_text(spark, sf_dir):
    """every block as the converter's record text."""
    b = ledger_from_dir(spark, sf_dir).blocks
    return b.select("hash", block_record_text(F.col("hash"), F.col("time"), F.col("prev_hash")).alias("text"))


def _io_columns(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(tx_hash, ord, value, address) of outputs; (tx_hash, ref_hash, ref_ord, value, address) of inputs, the last
    two being those of the output that they spend (null for a coinbase)."""
    ledger, outs = _ledger(spark, sf_dir)
    c = F.col
    spent = outs.select(c("tx_hash").alias("ref_hash"), c("ord").alias("ref_ord"), "value", "address")
    inputs = ledger.inputs.join(spent, ["ref_hash", "ref_ord"], "left")
    return outs.select("tx_hash", "ord", "value", "address"), inputs.select("tx_hash", "ref_hash", "ref_ord", "value", "address")


def _output_text(value, address, tx_hash, ord_):
    return output_record_text(value, address, ref_text(tx_hash, ord_))


def _input_text(value, address, ref_hash, ref_ord, tx_hash):
    """An input's text; 0 and unknown for a coinbase."""
    return input_record_text(F.coalesce(value, F.lit(0)), F.coalesce(address, F.lit("unknown")), ref_text(ref_hash, ref_ord), tx_hash)


def _io_texts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(tx_hash, ord, text) of outputs; (tx_hash, ref_hash, ref_ord, text) of inputs."""
    c = F.col
    outputs, inputs = _io_columns(spark, sf_dir)
    return (outputs.select("tx_hash", "ord", _output_text(c("value"), c("address"), c("tx_hash"), c("ord")).alias("text")),
            inputs.select("tx_hash", "ref_hash", "ref_ord", _input_text(
                c("value"), c("address"), c("ref_hash"), c("ref_ord"), c("tx_hash")).alias("text")))


def q_output_text(spark, sf_dir):
    """every output as the converter's record text."""
    return _io_texts(spark, sf_dir)[0]


def q_input_text(spark, sf_dir):
    """every input as the converter's record text."""
    return _io_texts(spark, sf_dir)[1]


def q_nested_tx_text(spark, sf_dir):
    """every transaction with the texts of its inputs and outputs in it."""
    c = F.col
    outputs, inputs = _io_columns(spark, sf_dir)
    # a transaction's own inputs and outputs: bounded by block size. They meet as columns, their hashes and
    # addresses as bytes; the texts are made where they have met
    outs = (outputs.select(packed(c("tx_hash")).alias("tx"), "ord", "value", packed(c("address")).alias("address"))
            .groupBy("tx").agg(F.collect_list(F.struct("ord", "value", "address")).alias("o")))
    ins = (inputs.select(packed(c("tx_hash")).alias("tx"), packed(c("ref_hash")).alias("ref_hash"), "ref_ord", "value",
                         packed(c("address")).alias("address"))
           .groupBy("tx").agg(F.collect_list(F.struct("ref_hash", "ref_ord", "value", "address")).alias("i")))
    txs = ledger_from_dir(spark, sf_dir).transactions.select(packed(c("hash")).alias("tx"), packed(c("block_hash")).alias("block"), "time")
    tx_hash = unpacked(c("tx"))

    def texts(items, keys, text):
        found = F.transform(c(items), lambda x: F.struct(*[k(x).alias(f"k{i}") for i, k in enumerate(keys)], text(x).alias("text")))
        return F.coalesce(F.transform(F.array_sort(found), lambda x: x["text"]), F.array().cast("array<string>"))
    ref = lambda x: unpacked(x["ref_hash"])
    o = texts("o", [lambda x: x["ord"]], lambda x: _output_text(x["value"], unpacked(x["address"]), tx_hash, x["ord"]))
    i = texts("i", [ref, lambda x: x["ref_ord"]],
              lambda x: _input_text(x["value"], unpacked(x["address"]), ref(x), x["ref_ord"], tx_hash))
    return (txs.join(ins, "tx", "left").join(outs, "tx", "left")
            .select(tx_hash.alias("hash"), nested_tx_text(tx_hash, c("time"), unpacked(c("block")), i, o).alias("text")))


def forked_blocks(blocks: DataFrame) -> DataFrame:
    """The chain with forks: every block whose hash begins with 0, and the last one, has a rival on the same
    parent; rivals of blocks that begin with 00, and the last one, have two successors each. So the last rival's
    successors are higher than the chain, and a tie."""
    last = blocks.agg(F.max("time")).first()[0]
    marked = blocks.select("hash", "prev_hash", "time", (F.col("time") == F.lit(last)).alias("is_last"))
    rivals = marked.filter(F.col("hash").startswith("0") | F.col("is_last"))
    rival = tagged_hash("F", F.col("hash"))
    longer = rivals.filter(F.col("hash").startswith("00") | F.col("is_last"))
    out = blocks.select("hash", "prev_hash", "time").unionByName(rivals.select(rival.alias("hash"), "prev_hash", "time"))
    for tag in ("G", "K"):
        out = out.unionByName(longer.select(tagged_hash(tag, F.col("hash")).alias("hash"), rival.alias("prev_hash"), "time"))
    return out


def q_main_chain(spark, sf_dir):
    """Height of every block of a chain with forks, and which of them are on the chain of the tip."""
    return main_chain(forked_blocks(ledger_from_dir(spark, sf_dir).blocks))


def q_pagerank_by_snapshot(spark, sf_dir):
    """PageRank of every snapshot's payment graph (year of the transaction), all in one loop; rank
    rounded to 6 and the rounds that the snapshot took."""
    ledger = _vertex_ids(spark, sf_dir)[0]

    def build():
        resolved, *_ = _resolved(spark, sf_dir), ledger.inputs, ledger.transactions
        return staged_alone(spark, lambda: payment_edges_by_snapshot(ledger, resolved, ledger.buckets), "lg_payments")
    edges = _once(spark, sf_dir, "payments-by-snapshot", build)
    ends = edges.select("graph", F.col("src").alias("id")).unionByName(edges.select("graph", F.col("dst").alias("id"))).distinct()
    ranks = _once(spark, sf_dir, "ranks-by-snapshot", lambda: pagerank_by_graph(ends, edges, distinct_pairs=True))
    return ranks.select(F.col("graph").alias("snapshot"), "id", F.round("rank", 6).alias("rank"), "rounds")


#: the last year of every batch of blocks but the last one
BATCH_YEARS = (1993, 1995, 1996)


def _utxo_store(spark, sf_dir) -> UtxoStore:
    """The ledger applied in four batches, by the time of its blocks."""
    def build():
        ledger, outs = _ledger(spark, sf_dir)
        n = max(32, ledger_buckets(spark, outs.count()))
        store = UtxoStore(spark, f"{scratch_folder(spark, 'lg_utxo')}/store", buckets=n)
        inputs, transactions = ledger.inputs, ledger.transactions
        shared = scratch_tables(spark)
        batch = sum(((snapshot_of(F.col("time")) > y).cast("int") for y in BATCH_YEARS), F.lit(0))
        c, tx = F.col, packed(F.col("tx_hash")).alias("tx")
        when = staged(transactions.select(packed(c("hash")).alias("tx"), batch.alias("batch")), "lg_batches")
        made = outs.select(tx, "ord", "value", packed(c("address")).alias("address")).join(when, "tx")
        made = made.select(unpacked(c("tx")).alias("tx_hash"), "ord", "value", unpacked(c("address")).alias("address"), "batch")
        used = inputs.select(tx, packed(c("ref_hash")).alias("ref"), "ref_ord").join(when, "tx")
        used = used.select(unpacked(c("ref")).alias("ref_hash"), "ref_ord", "batch")
        parts = [(df.schema, write_scratch(df, tag, ["batch"])) for df, tag in ((made, "lg_made"), (used, "lg_used"))]
        release_scratch(spark, since=[*shared, *(path for _, path in parts)])
        for k in range(len(BATCH_YEARS) + 1):
            store.apply(f"batch {k}", *(spark.read.schema(schema).parquet(path).filter(F.col("batch") == k) for schema, path in parts))
            store.versions.collect()                # only the newest version is read
            for _, path in parts:
                drop_scratch(spark, f"{path}/batch={k}")
        release_scratch(spark, since=shared)
        return store
    return _once(spark, sf_dir, "utxo-store", build)


def q_utxo_incremental(spark, sf_dir):
    """The unspent outputs after four batches of blocks, each merged into the ones before."""
    return _utxo_store(spark, sf_dir).utxo()


def q_balances_incremental(spark, sf_dir):
    """A3: the balances after the same four batches."""
    return _utxo_store(spark, sf_dir).balances()


def q_sample_with_replacement(spark, sf_dir):
    """Outputs sampled with replacement at a rate of one in twenty, repeatable."""
    _, outs = _ledger(spark, sf_dir)
    return poisson_by_hash(outs.select("tx_hash", "ord", "value", "address"), ["tx_hash", "ord"], 0.05)


def q_seed_documents(spark, sf_dir):
    """A viewer document for every tenth address, of its 50 strongest neighbours."""
    _, _, addr, w = _payment_graph(spark, sf_dir)
    return seed_documents(w, addr.filter("id % 10 = 0"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "balances": q_balances,
    "blocks": q_blocks,
    "transactions": q_transactions,
    "outputs": q_outputs,
    "inputs": q_inputs,
    "address_kind": q_address_kind,
    "address_profile": q_address_profile,
    "addresses": q_addresses,
    "spent_outputs": q_spent_outputs,
    "utxo": q_utxo,
    "address_totals": q_address_totals,
    "first_seen": q_first_seen,
    "tx_flat_size": q_tx_flat_size,
    "edges_named": q_edges_named,
    "edge_counts": q_edge_counts,
    "address_ids": q_address_ids,
    "block_ids": q_block_ids,
    "tx_ids": q_tx_ids,
    "edges_indexed": q_edges_indexed,
    "payment_edges_weighted": q_payment_edges_weighted,
    "payment_edges": q_payment_edges,
    "p2pk_addresses": q_p2pk_addresses,
    "pagerank": q_pagerank,
    "top_addresses": q_top_addresses,
    "graph_counts": q_graph_counts,
    "star_pagerank": q_star_pagerank,
    "address_report": q_address_report,
    "usd_format": q_usd_format,
    "json_fields": q_json_fields,
    "tx_text": q_tx_text,
    "chain_height": q_chain_height,
    "block_listing": q_block_listing,
    "block_drilldown": q_block_drilldown,
    "neighbourhood": q_neighbourhood,
    "graph_json": q_graph_json,
    "clean_nodes": q_clean_nodes,
    "sample_outputs": q_sample_outputs,
    "snapshot_counts": q_snapshot_counts,
    "balances_by_snapshot": q_balances_by_snapshot,
    "nonstandard_addresses": q_nonstandard_addresses,
    "duplicate_tx_hashes": q_duplicate_tx_hashes,
    "edges_indexed_legacy": q_edges_indexed_legacy,
    "ingest_ledger": q_ingest_ledger,
    "ingest_rejects": q_ingest_rejects,
    "tx_hashes": q_tx_hashes,
    "job_edges_roundtrip": q_job_edges_roundtrip,
    "job_ledger_roundtrip": q_job_ledger_roundtrip,
    "listing_roundtrip": q_listing_roundtrip,
    "block_tx_ids": q_block_tx_ids,
    "address_json": q_address_json,
    "block_text": q_block_text,
    "output_text": q_output_text,
    "input_text": q_input_text,
    "nested_tx_text": q_nested_tx_text,
    "ingest_ranges": q_ingest_ranges,
    "ingest_ranges_rejects": q_ingest_ranges_rejects,
    "job_tables": q_job_tables,
    "main_chain": q_main_chain,
    "pagerank_by_snapshot": q_pagerank_by_snapshot,
    "utxo_incremental": q_utxo_incremental,
    "balances_incremental": q_balances_incremental,
    "sample_with_replacement": q_sample_with_replacement,
    "seed_documents": q_seed_documents,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
