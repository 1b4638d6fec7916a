"""``LedgerGraph``: the reference's workflow — convert blocks, build the graphs, rank, report —
as one object over a ledger, whichever way the ledger was obtained.

    g = LedgerGraph.from_block_files(spark, "hdfs:///blocks")     # or from_parquet / from_star
    g.balances(); g.address_totals(); g.edges_indexed()
    g.top_addresses(10); g.report(10); g.neighbourhood(seeds); g.export_graph(path, seeds)

Intermediate tables used by several results (classified outputs, vertex ids, the payment
graph, ranks, heights) are materialised once per object. Every method returns a lazy DataFrame.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgergraph.operators import edges as E
from ledgergraph.operators import ledger as L
from ledgergraph.operators.chain import block_drilldown, block_listing, chain_height, main_chain
from ledgergraph.operators.neighbours import graph_elements, neighbourhood
from ledgergraph.operators.pagerank import graph_counts, graph_vertices, pagerank, top_k
from ledgergraph.operators.report import address_report, usd_columns
from ledgergraph.operators.snapshots import snapshot_counts
from ledgergraph.operators.subgraph import seed_documents
from ledgergraph.schemas import Ledger
from ledgergraph.session import bucketed_table, ensure_checkpoint_dir, ship_package, staged
from ledgergraph.sources.blockfile import blocks_of, flatten
from ledgergraph.sources.blockranges import scan_blocks
from ledgergraph.sources.io import LEDGER_TABLES, read_ledger, write_graph_json
from ledgergraph.sources.star import ledger_buckets, ledger_from_dir
from ledgergraph.sources.versions import Versions


class LedgerGraph:
    def __init__(self, ledger: Ledger, pubkey_digest: str = "hash160", tol: float = 0.001):
        self.ledger = ledger
        self.spark: SparkSession = ledger.outputs.sparkSession
        self.pubkey_digest = pubkey_digest
        self.tol = tol
        ensure_checkpoint_dir(self.spark)
        ship_package(self.spark)

    # --- construction ---------------------------------------------------------------------
    @classmethod
    def from_block_files(cls, spark: SparkSession, path: str, glob: str = "blk*.dat", on_damage: str = "fail",
                         **kw) -> LedgerGraph:
        """Parse block files once (staged, as byte ranges) and flatten them into the ledger tables."""
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return cls(flatten(blocks_of(scan_blocks(spark, path, glob, on_damage=on_damage)[0])), **kw)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, **kw) -> LedgerGraph:
        """A ledger written by ``io.write_ledger`` / the conversion job (``<out>/ledger``)."""
        return cls(read_ledger(spark, root), **kw)

    @classmethod
    def from_published(cls, spark: SparkSession, root: str, version: int | None = None, **kw) -> LedgerGraph:
        """The ledger of the newest (or the given) version that a conversion with ``atomic`` published."""
        tables = Versions(spark, root)
        return cls(Ledger(*(tables.read(f"ledger/{t}", version) for t in LEDGER_TABLES)), **kw)

    @classmethod
    def from_star(cls, spark: SparkSession, sf_dir: str, **kw) -> LedgerGraph:
        """The ledger derived from the ``orders``/``lineitem`` tables of ``sf_dir``."""
        return cls(ledger_from_dir(spark, sf_dir), **kw)

    # --- shared intermediates ---------------------------------------------------------------
    @cached_property
    def outputs(self) -> DataFrame:
        """Classified outputs (address, kind), bucketed on the outpoint like the inputs."""
        n = ledger_buckets(self.spark, self.ledger.outputs.count())
        classified = L.classified_outputs(self.ledger, self.pubkey_digest)
        return bucketed_table(classified, "lg_api_outputs", ["tx_hash", "ord"], n)[0]

    @cached_property
    def inputs(self) -> DataFrame:
        n = ledger_buckets(self.spark, self.ledger.outputs.count())
        return bucketed_table(self.ledger.inputs, "lg_api_inputs", ["ref_hash", "ref_ord"], n)[0]

    @cached_property
    def ids(self) -> E.VertexIds:
        return E.vertex_ids(self.ledger, self.outputs)

    @cached_property
    def resolved(self) -> DataFrame:
        """Outputs with the ids of their addresses, bucketed like the inputs."""
        n = ledger_buckets(self.spark, self.ledger.outputs.count())
        return bucketed_table(E.resolve_addresses(self.outputs, self.ids.addresses), "lg_api_resolved",
                              ["tx_hash", "ord"], n)[0]

    @cached_property
    def payment_graph(self) -> DataFrame:
        """Weighted address → address multigraph (src, dst, n)."""
        ledger = Ledger(self.ledger.blocks, self.ledger.transactions, self.outputs, self.inputs)
        return staged(E.payment_edges_weighted(ledger, self.resolved), "lg_api_payments")

    @cached_property
    def ranks(self) -> DataFrame:
        w = self.payment_graph
        return pagerank(graph_vertices(self.ids.addresses, w), w, tol=self.tol, distinct_pairs=True)

    @cached_property
    def heights(self) -> DataFrame:
        return chain_height(self.ledger.blocks)

    # --- results -------------------------------------------------------------------------
    def balances(self) -> DataFrame:
        return L.balances(self.outputs, self.inputs)

    def utxo(self) -> DataFrame:
        return L.utxo(self.outputs, self.inputs)

    def spent_outputs(self) -> DataFrame:
        return L.spent_outputs(self.outputs, self.inputs)

    def address_totals(self) -> DataFrame:
        return L.address_totals(self.outputs, self.inputs)

    def first_seen(self) -> DataFrame:
        return L.first_seen(self.outputs, self.ledger.transactions)

    def flat_size(self) -> DataFrame:
        return L.flat_size(self.ledger.transactions, self.outputs, self.inputs)

    def address_profile(self) -> DataFrame:
        return L.address_profile(self.outputs)

    def edges_named(self, direction: str = "documented") -> DataFrame:
        return E.edges_named(self._spend_ledger(), self.outputs, direction)

    def edges_indexed(self, direction: str = "documented") -> DataFrame:
        return E.edges_indexed(self._spend_ledger(), self.resolved, self.ids, direction)

    def payment_edges(self, expanded: bool = False) -> DataFrame:
        return E.expand_multigraph(self.payment_graph) if expanded else self.payment_graph

    def graph_counts(self) -> DataFrame:
        return graph_counts(graph_vertices(self.ids.addresses, self.payment_graph), self.payment_graph)

    def top_addresses(self, k: int = 10) -> DataFrame:
        return top_k(self.ranks, self.ids.addresses, k=k)

    def report(self, k: int = 10) -> DataFrame:
        top = self.top_addresses(k)
        mine = self.outputs.join(top.select("address"), "address", "left_semi")
        return address_report(top, L.address_totals(mine, self.inputs))

    def usd(self) -> DataFrame:
        return usd_columns(self.address_totals())

    def listing(self) -> DataFrame:
        return block_listing(self.heights)

    def main_chain(self) -> DataFrame:
        """Heights with the chain of the tip marked, for a ledger with forks."""
        return main_chain(self.ledger.blocks)

    def drilldown(self, k: int = 1) -> DataFrame:
        return block_drilldown(self.heights, self.ledger.transactions, self.outputs, self.inputs, k)

    def neighbourhood(self, seeds: DataFrame) -> DataFrame:
        """``seeds``: a frame of vertex ids (``id``) or of addresses (``address``)."""
        if "id" not in seeds.columns:
            seeds = self.ids.addresses.join(seeds.select("address"), "address").select("id")
        return neighbourhood(self.payment_graph, seeds).join(self.ids.addresses, "id")

    def seed_documents(self, seeds: DataFrame, k: int = 50) -> DataFrame:
        """One bounded viewer document per seed, given as for ``neighbourhood``."""
        if "id" not in seeds.columns:
            seeds = self.ids.addresses.join(seeds.select("address"), "address").select("id")
        return seed_documents(self.payment_graph, seeds, k)

    def export_graph(self, path: str, seeds: DataFrame) -> None:
        kept = staged(self.neighbourhood(seeds).select("id"), "lg_api_kept")
        write_graph_json(graph_elements(self.ids.addresses, self.payment_graph, kept), path)

    def snapshot_counts(self) -> DataFrame:
        return snapshot_counts(self.ledger)

    def _spend_ledger(self) -> Ledger:
        return Ledger(self.ledger.blocks, self.ledger.transactions, self.outputs, self.inputs)
