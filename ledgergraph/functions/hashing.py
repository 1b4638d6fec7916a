"""Hashes, hex and endianness as column functions.

SHA-256 and hex are Catalyst built-ins (``sha2``/``hex``/``unhex``) and stay inside whole-stage
codegen. RIPEMD-160 and Base58 have no built-in, so they are Arrow-batched pandas UDFs; callers
pass them only the rows that need them (null elsewhere), never the whole table.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256_hex(c: Column) -> Column:
    """Upper-case hex SHA-256 of a string or binary column (F1)."""
    return F.upper(F.sha2(c, 256))


def sha256_bytes(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def tagged_hash(tag: str, c: Column) -> Column:
    """``H(tag || text)``: upper hex SHA-256 of a tag followed by the value's text."""
    return sha256_hex(F.concat(F.lit(tag), c.cast("string")))


def packed(c: Column) -> Column:
    """A text as bytes, upper-case hex in half its length: 00 and its bytes, any other text 01 and its UTF-8. No
    two texts have the same bytes, so they are equal keys, and hashes take half the room in a shuffle."""
    raw = F.unhex(c)
    return F.when(F.hex(raw) == c, F.concat(F.lit(bytearray(b"\0")), raw)).otherwise(
        F.concat(F.lit(bytearray(b"\1")), F.encode(c, "UTF-8")))


def unpacked(c: Column) -> Column:
    """The text that ``packed`` has made into bytes."""
    rest = F.substring(c, F.lit(2), F.length(c) - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(bytearray(b"\0")), F.hex(rest)).otherwise(F.decode(rest, "UTF-8"))


def placed_as_bytes(df: DataFrame, buckets: int, keys: list[str], texts: list[str]) -> DataFrame:
    """``df`` in the buckets of ``keys``, its columns ``texts`` shuffled as bytes."""
    rows = df.select(*[packed(F.col(c)).alias(c) if c in texts else c for c in df.columns])
    rows = rows.repartition(buckets, *[unpacked(F.col(k)) if k in texts else F.col(k) for k in keys])
    return rows.select(*[unpacked(F.col(c)).alias(c) if c in texts else c for c in df.columns])


def double_sha256(c: Column) -> Column:
    """Transaction / block hash: SHA-256 applied twice to the serialised bytes, as bytes."""
    return sha256_bytes(sha256_bytes(c))


def reverse_bytes(raw: Column) -> Column:
    """The bytes in reverse order: as Latin-1 text a byte is a character, and texts can be reversed."""
    return F.encode(F.reverse(F.decode(raw, "ISO-8859-1")), "ISO-8859-1")


def reverse_hex(hex_col: Column) -> Column:
    """Byte-reverse a hex string."""
    return F.hex(reverse_bytes(F.unhex(hex_col)))


def display_hash(raw: Column) -> Column:
    """Internal (little-endian) hash bytes → the customary byte-reversed upper hex."""
    return F.hex(reverse_bytes(raw))


# --- RIPEMD-160 (hash160) -------------------------------------------------------------------

def _ripemd160_factory():
    try:
        hashlib.new("ripemd160", b"")
        return lambda b: hashlib.new("ripemd160", b).digest()
    except (ValueError, TypeError):  # OpenSSL without the legacy provider
        return _ripemd160_pure


# fixed values of the RIPEMD-160 specification (Dobbertin, Bosselaers, Preneel, 1996)
RMD_R1 = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15,
          7, 4, 13, 1, 10, 6, 15, 3, 12, 0, 9, 5, 2, 14, 11, 8,
          3, 10, 14, 4, 9, 15, 8, 1, 2, 7, 0, 6, 13, 11, 5, 12,
          1, 9, 11, 10, 0, 8, 12, 4, 13, 3, 7, 15, 14, 5, 6, 2,
          4, 0, 5, 9, 7, 12, 2, 10, 14, 1, 3, 8, 11, 6, 15, 13]
RMD_R2 = [5, 14, 7, 0, 9, 2, 11, 4, 13, 6, 15, 8, 1, 10, 3, 12,
          6, 11, 3, 7, 0, 13, 5, 10, 14, 15, 8, 12, 4, 9, 1, 2,
          15, 5, 1, 3, 7, 14, 6, 9, 11, 8, 12, 2, 10, 0, 4, 13,
          8, 6, 4, 1, 3, 11, 15, 0, 5, 12, 2, 13, 9, 7, 10, 14,
          12, 15, 10, 4, 1, 5, 8, 7, 6, 2, 13, 14, 0, 3, 9, 11]
RMD_S1 = [11, 14, 15, 12, 5, 8, 7, 9, 11, 13, 14, 15, 6, 7, 9, 8,
          7, 6, 8, 13, 11, 9, 7, 15, 7, 12, 15, 9, 11, 7, 13, 12,
          11, 13, 6, 7, 14, 9, 13, 15, 14, 8, 13, 6, 5, 12, 7, 5,
          11, 12, 14, 15, 14, 15, 9, 8, 9, 14, 5, 6, 8, 6, 5, 12,
          9, 15, 5, 11, 6, 8, 13, 12, 5, 12, 13, 14, 11, 8, 5, 6]
RMD_S2 = [8, 9, 9, 11, 13, 15, 15, 5, 7, 7, 8, 11, 14, 14, 12, 6,
          9, 13, 15, 7, 12, 8, 9, 11, 7, 7, 12, 7, 6, 15, 13, 11,
          9, 7, 15, 11, 8, 6, 6, 14, 12, 13, 5, 14, 13, 13, 7, 5,
          15, 5, 8, 11, 14, 14, 6, 14, 6, 9, 12, 9, 12, 5, 15, 8,
          8, 5, 12, 9, 12, 5, 14, 6, 8, 13, 6, 5, 15, 13, 11, 11]
RMD_K1 = [0x00000000, 0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xA953FD4E]
RMD_K2 = [0x50A28BE6, 0x5C4DD124, 0x6D703EF3, 0x7A6D76E9, 0x00000000]
RMD_H0 = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0]


def _ripemd160_pure(msg: bytes) -> bytes:
    """Plain-Python RIPEMD-160 (fallback when hashlib lacks it)."""
    mask = 0xFFFFFFFF

    def rol(x, n):
        return ((x << n) | (x >> (32 - n))) & mask

    def f(j, x, y, z):
        if j < 16:
            return x ^ y ^ z
        if j < 32:
            return (x & y) | (~x & z)
        if j < 48:
            return (x | ~y) ^ z
        if j < 64:
            return (x & z) | (y & ~z)
        return x ^ (y | ~z)

    r1, r2, s1, s2, k1, k2 = RMD_R1, RMD_R2, RMD_S1, RMD_S2, RMD_K1, RMD_K2
    h = list(RMD_H0)
    ml = len(msg) * 8
    msg = msg + b"\x80" + b"\x00" * ((55 - len(msg)) % 64) + ml.to_bytes(8, "little")
    for off in range(0, len(msg), 64):
        x = [int.from_bytes(msg[off + 4 * i: off + 4 * i + 4], "little") for i in range(16)]
        al, bl, cl, dl, el = h
        ar, br, cr, dr, er = h
        for j in range(80):
            t = (rol((al + (f(j, bl, cl, dl) & mask) + x[r1[j]] + k1[j // 16]) & mask, s1[j]) + el) & mask
            al, el, dl, cl, bl = el, dl, rol(cl, 10), bl, t
            t = (rol((ar + (f(79 - j, br, cr, dr) & mask) + x[r2[j]] + k2[j // 16]) & mask, s2[j]) + er) & mask
            ar, er, dr, cr, br = er, dr, rol(cr, 10), br, t
        t = (h[1] + cl + dr) & mask
        h[1] = (h[2] + dl + er) & mask
        h[2] = (h[3] + el + ar) & mask
        h[3] = (h[4] + al + br) & mask
        h[4] = (h[0] + bl + cr) & mask
        h[0] = t
    return b"".join(v.to_bytes(4, "little") for v in h)


_ripemd160 = _ripemd160_factory()


def hash160_bytes(data: bytes) -> bytes:
    """RIPEMD-160 of SHA-256 (F2)."""
    return _ripemd160(hashlib.sha256(data).digest())


@F.pandas_udf(T.StringType())
def hash160_hex(data: pd.Series) -> pd.Series:
    """Vectorised hash160 → upper hex, once per distinct value of a batch; null in, null out."""
    digests = {b: hash160_bytes(b).hex().upper() for b in {bytes(b) for b in data if b is not None}}
    return pd.Series([None if b is None else digests[bytes(b)] for b in data], dtype=object)


# --- Base58Check (F20) ----------------------------------------------------------------------

# fixed values: the Base58 alphabet and the main-network P2PKH version byte
B58_ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
P2PKH_VERSION = 0x00


def base58check(payload: bytes, version: int = P2PKH_VERSION) -> str:
    data = bytes([version]) + payload
    data += hashlib.sha256(hashlib.sha256(data).digest()).digest()[:4]
    num = int.from_bytes(data, "big")
    out = []
    while num:
        num, rem = divmod(num, 58)
        out.append(B58_ALPHABET[rem])
    pad = len(data) - len(data.lstrip(b"\x00"))
    return "1" * pad + "".join(reversed(out))


@F.pandas_udf(T.StringType())
def hash160_to_address(hex_hash: pd.Series) -> pd.Series:
    """40-hex-char hash160 → checksummed Base58 address; anything else → null."""
    def conv(h):
        if h is None or len(h) != 40:
            return None
        try:
            return base58check(bytes.fromhex(h))
        except ValueError:
            return None
    return hex_hash.map(conv)
