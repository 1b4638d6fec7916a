"""The operators' queries ``(spark, sf_dir) -> DataFrame`` over whole tables, and their SQL."""

from __future__ import annotations

from ledgergraph.llm import (exact_dedup, fingerprints, hard_negatives, html_text, jaccard_join, langid, mixing,
                             packing, sharding, simhash, toxicity, vector_codes, warc)

_MODULES = {
    "op1_toxicity": toxicity,
    "op2_simhash": simhash,
    "op3_html_text": html_text,
    "op4_fingerprints": fingerprints,
    "op5_sharding": sharding,
    "op6_exact_dedup": exact_dedup,
    "op7_packing": packing,
    "op8_warc": warc,
    "op9_mixing": mixing,
    "op10_langid": langid,
    "op11_hard_negatives": hard_negatives,
    "op12_jaccard_join": jaccard_join,
    "op13_vector_codes": vector_codes,
}


def queries():
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force."""
    return {name: module.ORACLE for name, module in _MODULES.items() if hasattr(module, "ORACLE")}
