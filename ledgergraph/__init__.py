"""ledgergraph — ledger-graph analytics expressed as lazy Spark DataFrame plans.

Subpackages:
  sources    ledger tables (derived from the star tables or ingested from block files), scans, sinks
  functions  column-level functions (script classification, hashes, money and text formatting)
  operators  DataFrame-in / DataFrame-out operators (ids, spends, edges, PageRank, chain, report)
  plans      the named query registry, its SQL oracles and the conversion job
  streaming  incremental conversion of newly arriving block files
"""

from ledgergraph.schemas import Ledger

__all__ = ["Ledger", "LedgerGraph"]


def __getattr__(name):
    if name == "LedgerGraph":        # lazy: importing the package stays light
        from ledgergraph.api import LedgerGraph
        return LedgerGraph
    raise AttributeError(name)
