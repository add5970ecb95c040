"""Elias-Fano coding of non-decreasing integers, with select structures.

n values below `top` take n * (2 + log2(top / n)) bits about: the low bits of each are stored as
they are, the high bits in unary as gaps between ones.  The position of every SAMPLE-th one is kept
too, so `select` reads a few bytes only.

Layout: five little-endian 64-bit integers (n, low width, least value, bytes of low bits, bytes of
high bits), the low bits, the high bits, the sampled positions as unsigned 64-bit integers.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<qqqqq")


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.int64)
    n = len(values)
    least = int(values[0]) if n else 0
    shifted = (values - least).astype(np.uint64)  # wraps around, so any 64-bit range fits
    top = int(shifted[-1]) + 1 if n else 1
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    bits = (shifted[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (shifted >> np.uint64(width)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    high = np.packbits(unary, bitorder="little").tobytes()
    return HEAD.pack(n, width, least, len(low), len(high)) + low + high + ones[::SAMPLE].astype("<u8").tobytes()


def _parts(blob: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]:
    n, width, least, low, high = HEAD.unpack_from(blob)
    at = HEAD.size
    return (
        n,
        width,
        least,
        np.frombuffer(blob, np.uint8, low, at),
        np.frombuffer(blob, np.uint8, high, at + low),
        np.frombuffer(blob, "<u8", -(-n // SAMPLE), at + low + high),
    )


def decode(blob: bytes) -> np.ndarray:
    """All values."""
    n, width, least, low, high, _ = _parts(blob)
    ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n]
    value = (ones - np.arange(n)).astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(low, bitorder="little")[: n * width].reshape(n, width).astype(np.uint64)
        value += (bits << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return value.astype(np.int64) + least


def select(blob: bytes, i: int) -> int:
    """The i-th value, from the bytes after the nearest sample before it."""
    n, width, least, low, high, samples = _parts(blob)
    if not 0 <= i < n:
        raise IndexError(i)
    start, left = int(samples[i // SAMPLE]), i % SAMPLE
    byte = start // 8
    skipped = int(np.bitwise_count(high[byte] & np.uint8((1 << (start % 8)) - 1)))
    left += skipped
    counts = 0
    while True:
        chunk = high[byte : byte + 64]
        found = np.cumsum(np.bitwise_count(chunk), dtype=np.int64)
        if counts + int(found[-1]) > left:
            break
        counts += int(found[-1])
        byte += 64
    place = int(np.searchsorted(found, left - counts, side="right"))
    before = counts + (int(found[place - 1]) if place else 0)
    one = (byte + place) * 8 + int(np.flatnonzero(np.unpackbits(chunk[place : place + 1], bitorder="little"))[left - before])
    value = (one - i) << width
    if width:
        first = i * width
        raw = int.from_bytes(low[first // 8 : (first + width + 7) // 8].tobytes(), "little")
        value |= (raw >> (first % 8)) & ((1 << width) - 1)
    value += least
    return value if value < 1 << 63 else value - (1 << 64)
