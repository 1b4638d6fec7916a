"""Output script → destination address and kind, as one Catalyst ``CASE`` chain.

Test order (first match wins):
  null                       → unknown
  empty                      → anyone
  25 bytes 76 A9 14 .. 88 AC → hex of the 20 pushed bytes                   (p2pkh)
  last byte AC, ≥ 2 bytes    → hash160 of bytes [1, len-1)                 (p2pk)
  first AA, last 87, ≥ 3     → 'puzzle_' + hex of bytes [1, len-2)          (puzzle)
  first 6A                   → unspendable
  anything else              → unknown (P2SH, multisig, segwit, and the too-short
                               ``AC`` / ``AA 87`` scripts that cannot be sliced)

Everything but hash160 is JVM-side; hash160 runs as an Arrow UDF that gets the public keys of p2pk rows
and null for all others, in the rows' own partitions. ``pubkey_digest="sha256"`` swaps hash160 for upper-hex
SHA-256 of the pubkey, a pure-SQL digest used where a SQL engine must reproduce the column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgergraph.functions.hashing import hash160_hex, sha256_hex

# fixed values: address labels and kinds of the classifier
ANYONE = "anyone"
UNSPENDABLE = "unspendable"
UNKNOWN = "unknown"
PUZZLE_PREFIX = "puzzle_"
KINDS = ("p2pkh", "p2pk", "puzzle", "unspendable", "anyone", "unknown")
LEGACY_ADDRESS_PREFIX = "bitcoinaddress_"


def script_kind(script: Column) -> Column:
    n = F.length(script)
    first = F.hex(F.substring(script, 1, 1))
    last = F.hex(F.substring(script, -1, 1))
    return (
        F.when(script.isNull(), F.lit("unknown"))
        .when(n == 0, F.lit("anyone"))
        .when((n == 25) & (F.hex(F.substring(script, 1, 3)) == "76A914")
              & (F.hex(F.substring(script, 24, 2)) == "88AC"), F.lit("p2pkh"))
        .when((n >= 2) & (last == "AC"), F.lit("p2pk"))
        .when((n >= 3) & (first == "AA") & (last == "87"), F.lit("puzzle"))
        .when(first == "6A", F.lit("unspendable"))
        .otherwise(F.lit("unknown"))
    )


def pubkey_bytes(script: Column) -> Column:
    """Bytes [1, len-1) of a script (the pushed public key of a p2pk script)."""
    return _slice(script, 2, F.length(script) - 2)


def _slice(script: Column, pos: int, length: Column) -> Column:
    # substring(binary, pos, len) with a column length
    return F.substring(script, F.lit(pos), length)


def _pubkey_digest(pubkey: Column, pubkey_digest: str) -> Column:
    if pubkey_digest == "hash160":
        return hash160_hex(pubkey)
    if pubkey_digest == "sha256":
        return sha256_hex(pubkey)
    raise ValueError(f"unknown pubkey_digest {pubkey_digest!r}")


def _address_from_kind(script: Column, kind: Column, pubkey_digest: str) -> Column:
    n = F.length(script)
    digest = _pubkey_digest(F.when(kind == "p2pk", pubkey_bytes(script)), pubkey_digest)
    return (
        F.when(kind == "p2pkh", F.hex(F.substring(script, 4, 20)))
        .when(kind == "p2pk", digest)
        .when(kind == "puzzle", F.concat(F.lit(PUZZLE_PREFIX), F.hex(_slice(script, 2, n - 3))))
        .when(kind == "anyone", F.lit(ANYONE))
        .when(kind == "unspendable", F.lit(UNSPENDABLE))
        .otherwise(F.lit(UNKNOWN))
    )


def classify_script(script: Column, pubkey_digest: str = "hash160") -> Column:
    """Struct ``(address STRING, kind STRING)`` for an output script (BINARY), as one expression.

    For whole tables prefer ``with_address``, which computes ``kind`` once and refers to it.
    """
    kind = script_kind(script)
    return F.struct(_address_from_kind(script, kind, pubkey_digest).alias("address"),
                    kind.alias("kind"))


def with_address(outputs, pubkey_digest: str = "hash160", script_col: str = "script"):
    """Add ``kind`` and ``address`` to an outputs frame, whose rows stay in their partitions: nothing is
    shuffled, and a key that very many outputs pay to is no hot spot. A batch hashes each of its keys once."""
    s = F.col(script_col)
    kinds = outputs.withColumn("kind", script_kind(s))
    return (kinds.withColumn("address", _address_from_kind(s, F.col("kind"), pubkey_digest))
            .select(*outputs.columns, "kind", "address"))


def strip_legacy_prefix(address: Column) -> Column:
    """drop the legacy ``bitcoinaddress_`` prefix (idempotent)."""
    return F.regexp_replace(address, "^" + LEGACY_ADDRESS_PREFIX, "")
