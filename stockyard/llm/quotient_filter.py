"""Counting quotient filters of packed n-grams: compact, lossless, mergeable.

An n-gram is packed as n word ids of ``bits`` bits. A bijection of the packed value
replaces its first id by permute(first ^ mix(others)); the others stay, so it can be undone. The
leading bits of that are the quotient, the rest of it and the other ids the full remainder:
nothing is lost, so counts are exact.

A filter is kept sorted by permuted value. Cut into ranges of the quotient's leading bits
(buckets), each range is stored as: the number of entries; one bit per entry and one per quotient
(ones, ended by a zero, say how many entries a quotient has); remainders in whole bytes; counts
in one byte each, 255 standing for a count kept behind them in eight. Two filters of one
bucket merge like sorted lists: equal entries add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from stockyard.llm.common import mix64

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Packing:
    """``n`` ids of ``bits`` bits (48 or 64) each, and 2 ** ``bucket_bits`` buckets."""

    def __init__(self, n: int, bits: int, bucket_bits: int):
        self.n, self.bits, self.bucket_bits = n, bits, bucket_bits
        self.run_bits = (bits - bucket_bits) % 8 or 8  # the quotient has bucket_bits + run_bits
        self.low_bytes = (bits - bucket_bits - self.run_bits) // 8
        self.mask = np.uint64((1 << bits) - 1)
        self.half = np.uint64(bits // 2)

    def _others(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), self.n, np.uint64)
        for j in range(1, self.n):
            out = mix64(out ^ ids[:, j])
        return (out if self.n > 1 else np.zeros(len(ids), np.uint64)) & self.mask

    def pack(self, ids: np.ndarray) -> np.ndarray:
        """The permuted values of n-grams (rows of ids)."""
        out = ids.astype(np.uint64, copy=True)
        x = out[:, 0] ^ self._others(out)
        with np.errstate(over="ignore"):
            for odd in _ODD:
                x ^= x >> self.half
                x = (x * np.uint64(odd)) & self.mask
        out[:, 0] = x ^ (x >> self.half)
        return out

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        """The n-grams of permuted values."""
        out = packed.copy()
        x = out[:, 0] ^ (out[:, 0] >> self.half)
        with np.errstate(over="ignore"):
            for odd in reversed(_ODD):
                x = (x * np.uint64(pow(odd, -1, 1 << self.bits) & ((1 << 64) - 1))) & self.mask
                x ^= x >> self.half
        out[:, 0] = x ^ self._others(out)
        return out


class QuotientFilter:
    """Distinct permuted values in ascending order, with their counts."""

    def __init__(self, packing: Packing, values: np.ndarray, counts: np.ndarray):
        self.packing, self.values, self.counts = packing, values, counts

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def of(cls, packing: Packing, ids: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        return cls._summed(packing, packing.pack(ids), counts)

    @classmethod
    def _summed(cls, packing: Packing, values: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        order = np.argsort(values[:, 0], kind="stable")
        first = values[order, 0]
        if packing.n > 1 and (first[1:] == first[:-1]).any():
            order = np.lexsort(values.T[::-1])
        values, counts = values[order], counts[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]).any(axis=1)
        at = np.flatnonzero(new)
        return cls(packing, values[at], np.add.reduceat(counts, at) if len(at) else counts)

    @classmethod
    def merged(cls, parts: list[QuotientFilter]) -> QuotientFilter:
        if len(parts) == 1:
            return parts[0]
        return cls._summed(parts[0].packing, np.concatenate([p.values for p in parts]), np.concatenate([p.counts for p in parts]))

    def ids(self) -> np.ndarray:
        return self.packing.unpack(self.values)

    def segments(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, stored form) of every bucket with entries."""
        p = self.packing
        bucket = (self.values[:, 0] >> np.uint64(p.bits - p.bucket_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        ends = [0, *cuts.tolist(), len(bucket)]
        for a, b in zip(ends, ends[1:]):
            if b > a:
                yield int(bucket[a]), self._stored(a, b)

    def _stored(self, a: int, b: int) -> bytes:
        p, values, counts = self.packing, self.values[a:b], self.counts[a:b]
        low_bits = 8 * p.low_bytes
        quotient = ((values[:, 0] >> np.uint64(low_bits)) & np.uint64((1 << p.run_bits) - 1)).astype(np.int64)
        ones = np.zeros(b - a + (1 << p.run_bits), np.uint8)
        ones[np.arange(b - a) + quotient] = 1  # a zero ends each quotient
        large = counts >= 255
        parts = [
            np.int64(b - a).tobytes(),
            np.packbits(ones).tobytes(),
            _bytes(values[:, 0], p.low_bytes),
            *(_bytes(values[:, j], p.bits // 8) for j in range(1, p.n)),
            np.where(large, 255, counts).astype(np.uint8).tobytes(),
            counts[large].astype(np.int64).tobytes(),
        ]
        return b"".join(parts)

    @classmethod
    def read(cls, packing: Packing, bucket: int, data: bytes) -> QuotientFilter:
        p, at = packing, 8
        n = int(np.frombuffer(data, np.int64, 1)[0])
        size = (n + (1 << p.run_bits) + 7) // 8
        ones = np.unpackbits(np.frombuffer(data, np.uint8, size, at))[: n + (1 << p.run_bits)]
        place = np.flatnonzero(ones)
        quotient = (place - np.arange(n)).astype(np.uint64)
        at += size
        values = np.empty((n, p.n), np.uint64)
        low = _numbers(data, at, n, p.low_bytes)
        at += n * p.low_bytes
        high = (np.uint64(bucket) << np.uint64(p.run_bits)) | quotient
        values[:, 0] = (high << np.uint64(8 * p.low_bytes)) | low
        for j in range(1, p.n):
            values[:, j] = _numbers(data, at, n, p.bits // 8)
            at += n * (p.bits // 8)
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        at += n
        counts[counts == 255] = np.frombuffer(data, np.int64, offset=at)
        return cls(packing, values, counts)


def _bytes(x: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _numbers(data: bytes, at: int, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return out.view(np.uint64).reshape(n)
