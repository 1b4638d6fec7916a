"""Test-side encoder of block files (legacy and segwit transactions), the inverse of ingest."""

from __future__ import annotations

import hashlib
import struct

MAGIC = bytes.fromhex("F9BEB4D9")


def varint(n: int) -> bytes:
    if n < 0xFD:
        return bytes([n])
    if n <= 0xFFFF:
        return b"\xfd" + struct.pack("<H", n)
    if n <= 0xFFFFFFFF:
        return b"\xfe" + struct.pack("<I", n)
    return b"\xff" + struct.pack("<Q", n)


def dsha(b: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(b).digest()).digest()


def display(h: bytes) -> str:
    return h[::-1].hex().upper()


def encode_tx(inputs, outputs, witness=None) -> tuple[bytes, str]:
    """inputs: [(prev_display_hex, index, script_sig)], outputs: [(value, script)]."""
    body = varint(len(inputs))
    for prev, idx, sig in inputs:
        body += bytes.fromhex(prev)[::-1] + struct.pack("<I", idx) + varint(len(sig)) + sig + b"\xff" * 4
    body += varint(len(outputs))
    for value, script in outputs:
        body += struct.pack("<q", value) + varint(len(script)) + script
    version, locktime = struct.pack("<i", 1), b"\x00" * 4
    stripped = version + body + locktime
    if witness is None:
        return stripped, display(dsha(stripped))
    wit = b"".join(varint(len(items)) + b"".join(varint(len(x)) + x for x in items) for items in witness)
    return version + b"\x00\x01" + body + wit + locktime, display(dsha(stripped))


def encode_block(prev_display: str, time: int, txs: list[bytes]) -> tuple[bytes, str]:
    header = (struct.pack("<i", 1) + bytes.fromhex(prev_display)[::-1] + b"\x11" * 32
              + struct.pack("<I", time) + b"\xff\xff\x00\x1d" + struct.pack("<I", 7))
    return header + varint(len(txs)) + b"".join(txs), display(dsha(header))


def frame(block: bytes) -> bytes:
    return MAGIC + struct.pack("<I", len(block)) + block
