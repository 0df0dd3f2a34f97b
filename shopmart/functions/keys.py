"""Pseudonyms and surrogate keys as SQL expressions of built-in functions."""

from __future__ import annotations

import hashlib

MIN_KEY_LENGTH = 32
_BLOCK = 64  # SHA-256 block size in bytes


def _pads(key: str) -> tuple[str, str]:
    if len(key) < MIN_KEY_LENGTH:
        raise ValueError(f"the hash key needs at least {MIN_KEY_LENGTH} characters")
    raw = key.encode()
    if len(raw) > _BLOCK:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


def pseudonym(value: str, key: str) -> str:
    """HMAC-SHA256 of the value's text (RFC 2104) as 64 lower-case hex digits.

    Null hashes like the empty text, so it too has one fixed pseudonym. The padded key
    becomes a literal of the plan, which the session masks where plans are shown; treat event
    logs written by other sessions as secret.
    """
    inner_pad, outer_pad = _pads(key)
    message = f"CAST(coalesce(CAST({value} AS STRING), '') AS BINARY)"
    return f"sha2(concat(X'{outer_pad}', unhex(sha2(concat(X'{inner_pad}', {message}), 256))), 256)"


def crc32_key(value: str) -> str:
    """Surrogate key: unsigned CRC-32 of the value's text; 0 stays free for "unknown"."""
    crc = f"crc32(CAST(CAST({value} AS STRING) AS BINARY))"
    return f"if({crc} = 0, 1L, {crc})"


def wide_key(value: str) -> str:
    """Surrogate key of 63 bits for dimensions too large for CRC-32 (see gold.key_collisions)."""
    hashed = f"(xxhash64(CAST({value} AS STRING)) & {(1 << 63) - 1}L)"
    return f"if({value} IS NULL, NULL, if({hashed} = 0, 1L, {hashed}))"
