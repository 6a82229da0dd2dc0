"""Counting quotient filters over packed word-id n-grams that lose nothing.

A phrase of up to six word ids of 32 bits is packed into lanes of two ids. The first lane is mixed by a permutation of 64-bit
numbers, keyed by the other lanes, which can be undone; its high bits are the quotient, and its low bits with the other lanes
are the remainder, kept whole. So equal entries are equal phrases, never only likely so, and a phrase is read back from its
entry. Entries are sorted, which makes filters of different shards mergeable like sorted lists.

In bytes a filter of one range of quotients is the number of entries under each quotient (one byte, more where needed), the
low bytes of the remainders, the other lanes as far as the phrase length needs them, and a counter of one byte an entry with
larger ones apart.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_UNDO_A, _UNDO_B = (np.uint64(pow(int(x), -1, 1 << 64)) for x in (_A, _B))
# Words, bits of the range, bits of the quotient, bytes of a run length, range, entries, large counters.
_HEADER = "<BBBBQQQ"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _unshift(x: np.ndarray, by: int) -> np.ndarray:
    out, shift = x.copy(), by
    while shift < 64:
        out = x ^ (out >> np.uint64(by))
        shift += by
    return out


def _unmixed(x: np.ndarray) -> np.ndarray:
    x = _unshift(x, 31) * _UNDO_B
    x = _unshift(x, 27) * _UNDO_A
    return _unshift(x, 30)


def _key(lanes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(lanes[0]), np.uint64)
    for lane in lanes[1:]:
        out = _mixed(out + lane + _A)
    return out


def packed(ids: np.ndarray) -> list[np.ndarray]:
    """Lanes of phrases given as rows of word ids, the first one permuted."""
    ids = ids.astype(np.uint64)
    lanes = [
        ids[:, i] << np.uint64(32) | (ids[:, i + 1] if i + 1 < ids.shape[1] else np.uint64(0)) for i in range(0, ids.shape[1], 2)
    ]
    return [_mixed(lanes[0] ^ _key(lanes)), *lanes[1:]]


def unpacked(lanes: list[np.ndarray], n_words: int) -> np.ndarray:
    """The word ids of phrases, the permutation undone."""
    plain = [_unmixed(lanes[0]) ^ _key(lanes), *lanes[1:]]
    low = np.uint64(0xFFFFFFFF)
    columns = [x for lane in plain for x in (lane >> np.uint64(32), lane & low)]
    return np.stack(columns[:n_words], axis=1).astype(np.int64)


def in_order(lanes: list[np.ndarray]) -> np.ndarray:
    """The order of entries. Equal first lanes of different phrases are next to impossible, so one sort nearly always does."""
    order = np.argsort(lanes[0], kind="stable")
    first = lanes[0][order]
    same = first[1:] == first[:-1]
    if any((lane[order][1:] != lane[order][:-1])[same].any() for lane in lanes[1:]):
        return np.lexsort(lanes[::-1])
    return order


@dataclass
class Filter:
    """Sorted entries with their counters."""

    n_words: int
    lanes: list[np.ndarray]
    counts: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, counts: np.ndarray) -> tuple[Filter, np.ndarray]:
        """The filter of distinct phrases, and which phrase each entry is."""
        lanes = packed(ids)
        order = in_order(lanes)
        return cls(ids.shape[1], [lane[order] for lane in lanes], counts[order]), order

    def ids(self) -> np.ndarray:
        return unpacked(self.lanes, self.n_words)

    def __len__(self) -> int:
        return len(self.counts)

    def part(self, chosen) -> Filter:
        return Filter(self.n_words, [lane[chosen] for lane in self.lanes], self.counts[chosen])

    def ranges(self, bits: int) -> list[tuple[int, Filter]]:
        """The filter cut by the high bits of the quotients; only ranges that have entries."""
        if not len(self):
            return []
        if bits == 0:
            return [(0, self)]
        which = (self.lanes[0] >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.diff(which, prepend=-1))
        stops = [*starts[1:].tolist(), len(which)]
        return [(int(which[a]), self.part(slice(a, b))) for a, b in zip(starts.tolist(), stops, strict=True)]

    def to_bytes(self, number: int = 0, bits: int = 0) -> bytes:
        """Entries of one range in compact form."""
        n = len(self)
        q = min(max(n.bit_length() - 1, 0), 24, 63 - bits)
        rest = 64 - bits - q
        below = self.lanes[0] & np.uint64((1 << (64 - bits)) - 1)
        runs = np.bincount((below >> np.uint64(rest)).astype(np.int64), minlength=1 << q)
        size = 1 if runs.max(initial=0) < 256 else 8
        width = -(-rest // 8)
        remainder = (below & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        others = [
            np.ascontiguousarray((lane >> np.uint64(32)).astype("<u4") if 2 * i + 2 == self.n_words + 1 else lane.astype("<u8")).tobytes()
            for i, lane in enumerate(self.lanes)
            if i
        ]
        large = np.flatnonzero(self.counts >= 255)
        small = np.where(self.counts >= 255, 255, self.counts).astype(np.uint8)
        return b"".join(
            [
                struct.pack(_HEADER, self.n_words, bits, q, size, number, n, len(large)),
                runs.astype(f"<u{size}").tobytes(),
                np.ascontiguousarray(remainder).tobytes(),
                *others,
                small.tobytes(),
                self.counts[large].astype("<i8").tobytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> Filter:
        n_words, bits, q, size, number, n, n_large = struct.unpack_from(_HEADER, raw)
        at = struct.calcsize(_HEADER)

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        rest = 64 - bits - q
        width = -(-rest // 8)
        runs = take(1 << q, f"<u{size}")
        remainder = np.zeros((n, 8), np.uint8)
        remainder[:, :width] = take(n * width, "u1").reshape(n, width)
        high = np.repeat(np.arange(1 << q, dtype=np.uint64), runs.astype(np.int64))
        first = remainder.reshape(-1).view("<u8").astype(np.uint64) | high << np.uint64(rest)
        if bits:
            first |= np.uint64(number << (64 - bits))
        lanes = [first]
        for i in range(1, -(-n_words // 2)):
            half = 2 * i + 2 == n_words + 1
            lanes.append(take(n, "<u4").astype(np.uint64) << np.uint64(32) if half else take(n, "<u8").astype(np.uint64))
        counts = take(n, "u1").astype(np.int64)
        counts[counts == 255] = take(n_large, "<i8")
        return cls(n_words, lanes, counts)


def merged(filters: list[Filter]) -> tuple[Filter, list[np.ndarray]]:
    """One filter with the counters of equal entries added up, and for each given filter the place of its entries in it."""
    lanes = [np.concatenate(parts) for parts in zip(*(f.lanes for f in filters), strict=True)]
    counts = np.concatenate([f.counts for f in filters])
    order = in_order(lanes)
    lanes = [lane[order] for lane in lanes]
    new = np.ones(len(order), bool)
    new[1:] = np.any([lane[1:] != lane[:-1] for lane in lanes], axis=0)
    starts = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    out = Filter(filters[0].n_words, [lane[starts] for lane in lanes], np.add.reduceat(counts[order], starts))
    return out, np.split(place, np.cumsum([len(f) for f in filters])[:-1])
