"""Pair merging over a batch of sequences held as ragged numpy arrays.

In every round each sequence merges its pair of the lowest rank, the leftmost of equals, and all sequences do so at the same
time. That is the order in which a priority queue per sequence would merge, so results are exact.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

NO_RANK = np.int64(1 << 30)
# A sequence this long is merged with a queue of its own: rounds would pass over it once for each of its merges.
LONG = 512


@dataclass
class PairTable:
    """Ranks and results of pairs of symbols, as an open hash table in arrays."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray

    @classmethod
    def of(cls, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> PairTable:
        """The pairs are distinct. The table keeps a quarter filled, so chains of probes are short."""
        keys = _key(np.asarray(left), np.asarray(right))
        size = 1 << max(4, int(4 * len(keys)).bit_length())
        at = _slot(keys, size)
        slots = np.full(size, -1, dtype=np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[slots[at[todo]] < 0]
            slots[at[free]] = free
            todo = todo[slots[at[todo]] != todo]
            at[todo] = (at[todo] + 1) & (size - 1)
        used = slots >= 0
        # The last entry stands for "no pair"; negative slots read it.
        table, ranks, results = np.full(size, -1, np.int64), np.full(size + 1, NO_RANK, np.int64), np.zeros(size + 1, np.int32)
        table[used] = keys[slots[used]]
        ranks[:-1][used] = np.asarray(rank)[slots[used]]
        results[:-1][used] = np.asarray(merged)[slots[used]]
        return cls(table, ranks, results)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 where there is none."""
        keys = _key(left, right)
        at, out = _slot(keys, len(self.keys)), np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            seen = self.keys[at[todo]]
            same = seen == keys[todo]
            out[todo[same]] = at[todo[same]]
            todo = todo[~same & (seen >= 0)]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        return out


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << 31) | right.astype(np.int64)


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def merge(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols and the new lengths, sequence by sequence. Lengths are at least one."""
    lengths = np.asarray(lengths, dtype=np.int64)
    done: dict[int, np.ndarray] = {}
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    long = np.flatnonzero(lengths > LONG)
    for i in long:
        done[int(i)] = _merge_long(symbols[bounds[i] : bounds[i + 1]], table)
    short = np.flatnonzero(lengths <= LONG)
    if len(long):
        symbols = np.concatenate([symbols[bounds[i] : bounds[i + 1]] for i in short]) if len(short) else symbols[:0]
    out_symbols, out_lengths = _merge_rounds(symbols, lengths[short], table)
    if not len(long):
        return out_symbols, out_lengths
    new = np.zeros(len(lengths), dtype=np.int64)
    new[short] = out_lengths
    parts = np.split(out_symbols, np.cumsum(out_lengths)[:-1]) if len(short) else []
    for i, part in zip(short, parts, strict=True):
        done[int(i)] = part
    for i in long:
        new[i] = len(done[int(i)])
    return np.concatenate([done[i] for i in range(len(lengths))]), new


def _merge_rounds(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    if not len(lengths):
        return symbols[:0], lengths
    sym, owner = symbols.astype(np.int32), np.arange(len(lengths))
    ends = np.cumsum(lengths)
    slot = np.full(len(sym), -1, dtype=np.int64)
    slot[:-1] = table.slots(sym[:-1], sym[1:])
    slot[ends - 1] = -1
    starts = ends - lengths
    finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(owner):
        best = np.minimum.reduceat((table.ranks[slot] << 32) | np.arange(len(sym)), starts)
        stop = best >> 32 >= NO_RANK
        if stop.any():
            sizes = np.diff(np.append(starts, len(sym)))
            gone = np.repeat(stop, sizes)
            finished.append((owner[stop], sizes[stop], sym[gone]))
            # What stays moves up by the symbols that went before it.
            moved = np.cumsum(np.where(stop, sizes, 0))[~stop]
            sym, slot, owner = sym[~gone], slot[~gone], owner[~stop]
            starts, best = starts[~stop] - moved, (best & 0xFFFFFFFF)[~stop] - moved
        else:
            best = best & 0xFFFFFFFF
        if not len(owner):
            break
        sym[best] = table.merged[slot[best]]
        keep = np.ones(len(sym), dtype=bool)
        keep[best + 1] = False
        sym, slot = sym[keep], slot[keep]
        order = np.arange(len(owner))
        at, starts = best - order, starts - order
        ends = np.append(starts[1:], len(sym))
        inner = at + 1 < ends
        slot[at] = -1
        slot[at[inner]] = table.slots(sym[at[inner]], sym[at[inner] + 1])
        before = at[at > starts] - 1
        slot[before] = table.slots(sym[before], sym[before + 1])
    order = np.concatenate([o for o, _, _ in finished])
    sizes = np.concatenate([s for _, s, _ in finished])
    flat = np.concatenate([x for _, _, x in finished])
    # Back into the order of the sequences.
    by_owner = np.argsort(order, kind="stable")
    first = np.cumsum(sizes) - sizes
    new = sizes[by_owner]
    places = np.repeat(first[by_owner] - (np.cumsum(new) - new), new) + np.arange(len(flat))
    return flat[places], new


def _merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """One long sequence with a queue of its pairs."""
    sym, n = symbols.astype(np.int64).tolist(), len(symbols)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]

    first = table.slots(symbols[:-1], symbols[1:])
    queue = [(int(table.ranks[s]), i, int(s), sym[i], sym[i + 1]) for i, s in enumerate(first.tolist()) if s >= 0]
    heapq.heapify(queue)

    def push(i: int) -> None:
        s = int(table.slots(np.array([sym[i]]), np.array([sym[after[i]]]))[0])
        if s >= 0:
            heapq.heappush(queue, (int(table.ranks[s]), i, s, sym[i], sym[after[i]]))

    while queue:
        _, i, s, left, right = heapq.heappop(queue)
        j = after[i]
        if sym[i] != left or j < 0 or sym[j] != right:
            continue
        sym[i], sym[j] = int(table.merged[s]), -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([x for x in sym if x >= 0], dtype=np.int32)
