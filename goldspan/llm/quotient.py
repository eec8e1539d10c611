"""Counting quotient filters: exact counters of integer keys, small enough to be moved between shards.

A key of ``bits`` bits is permuted by an invertible map of that many bits, which spreads it evenly. The upper bits of the
result are its quotient, all others its remainder, so nothing of the key is lost and no two keys share a counter. A filter
holds, in the order of the permuted keys, how many of them each quotient has (in unary), their remainders (whole bytes)
and their counts (one byte, greater ones beside). Two filters of one range are merged as two sorted lists are.
"""

from __future__ import annotations

import numpy as np

MOST_BITS = 62
_ODD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_BIG = 255  # a count byte of this value says that the count is among the greater ones


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys of ``bits`` bits, spread over the same range without collisions; ``restored`` is the way back."""
    mask, half = _mask(bits), np.uint64(-(-bits // 2))
    out = keys.astype(np.uint64)
    for odd in _ODD:
        out = out * np.uint64(odd) & mask
        out ^= out >> half
    return out


def restored(keys: np.ndarray, bits: int) -> np.ndarray:
    mask, half = _mask(bits), np.uint64(-(-bits // 2))
    out = keys.astype(np.uint64)
    for odd in reversed(_ODD):
        out = out ^ out >> half  # twice the shift is no less than the bits, so it undoes itself
        out = out * np.uint64(pow(odd, -1, 1 << 64)) & mask
    return out


def packed(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of rising, distinct permuted keys below 2^bits and their counts (from 1)."""
    many = len(keys)
    quotient_bits = min(bits, max(0, many.bit_length() - 1))
    rest = bits - quotient_bits
    runs = np.zeros((1 << quotient_bits) + many, np.uint8)  # a one for each key, a zero behind each quotient
    runs[(keys >> np.uint64(rest)).astype(np.int64) + np.arange(many)] = 1
    width = -(-rest // 8)
    remainders = (keys & _mask(rest)).astype("<u8").view(np.uint8).reshape(many, 8)[:, :width]
    great = counts >= _BIG
    head = np.array([many, bits, quotient_bits, great.sum()], "<i8")
    return b"".join((head.tobytes(), np.packbits(runs).tobytes(), remainders.tobytes(),
                     np.where(great, _BIG, counts).astype(np.uint8).tobytes(), counts[great].astype("<i8").tobytes()))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys, rising, and their counts."""
    many, bits, quotient_bits, great = np.frombuffer(blob, "<i8", 4).tolist()
    rest, at = bits - quotient_bits, 32
    length = (1 << quotient_bits) + many
    runs = np.unpackbits(np.frombuffer(blob, np.uint8, -(-length // 8), at), count=length)
    at += -(-length // 8)
    keys = (np.flatnonzero(runs) - np.arange(many)).astype(np.uint64) << np.uint64(rest)
    width = -(-rest // 8)
    remainders = np.zeros((many, 8), np.uint8)
    remainders[:, :width] = np.frombuffer(blob, np.uint8, many * width, at).reshape(many, width)
    keys |= remainders.view("<u8").ravel()
    counts = np.frombuffer(blob, np.uint8, many, at + many * width).astype(np.int64)
    counts[counts == _BIG] = np.frombuffer(blob, "<i8", great, at + many * (width + 1))
    return keys, counts


def counted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct permuted keys, rising, and how often each of the plain ``keys`` occurs."""
    return np.unique(permuted(keys, bits), return_counts=True)


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted filter out of several; the counts of a key are added up."""
    keys = np.concatenate([k for k, _ in filters])
    counts = np.concatenate([c for _, c in filters])
    order = np.argsort(keys, kind="stable")  # merges the rising runs
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.add.reduceat(counts, start) if len(start) else counts


def cut(keys: np.ndarray, counts: np.ndarray, bits: int, cut_bits: int) -> list[tuple[int, bytes]]:
    """The filters of the 2^cut_bits equal ranges of quotients that hold keys: range and filter, keys counted from the
    start of their range."""
    rest = bits - cut_bits
    ends = np.searchsorted(keys, np.arange(1, (1 << cut_bits) + 1, dtype=np.uint64) << np.uint64(rest))
    out, at = [], 0
    for part, end in enumerate(ends.tolist()):
        if end > at:
            out.append((part, packed(keys[at:end] & _mask(rest), counts[at:end], rest)))
        at = end
    return out
