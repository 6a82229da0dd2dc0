"""A minimal acyclic transducer from words to token ids.

Words are added in byte order and equal suffix states are shared as soon as they are closed, so the automaton is minimal.
Every edge carries how many words sort before it inside its state; the sum along a path is the word's number, and the ids of
a word are read by that number. All parts are flat arrays in one file, which a task maps into memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PARTS = ("edge_keys", "edge_targets", "edge_skips", "final", "id_ends", "ids")
KINDS = (np.int64, np.int32, np.int32, np.int8, np.int64, np.int32)


class _State:
    __slots__ = ("edges", "final", "number", "words")

    def __init__(self) -> None:
        self.edges: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.words = 0


@dataclass
class Lexicon:
    edge_keys: np.ndarray
    edge_targets: np.ndarray
    edge_skips: np.ndarray
    final: np.ndarray
    id_ends: np.ndarray
    ids: np.ndarray

    @classmethod
    def build(cls, entries: dict[bytes, list[int]]) -> Lexicon:
        root, states, register = _State(), [], {}
        path: list[tuple[_State, int, _State]] = []

        def close(depth: int) -> None:
            """States below ``depth`` get no more edges: equal ones become one."""
            while len(path) > depth:
                parent, label, child = path.pop()
                known = register.setdefault((child.final, tuple((b, s.number) for b, s in child.edges.items())), child)
                if known is child:
                    child.number = len(states)
                    child.words = child.final + sum(s.words for s in child.edges.values())
                    states.append(child)
                parent.edges[label] = known

        last, words = b"", sorted(w for w in entries if w)
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            at = path[-1][2] if path else root
            for label in word[same:]:
                path.append((at, label, _State()))
                at = path[-1][2]
            at.final, last = True, word
        close(0)
        root.number = len(states)
        states.append(root)
        keys, targets, skips = [], [], []
        # The root is state 0 outside.
        outer = lambda s: 0 if s is root else s.number + 1
        for state in sorted(states, key=outer):
            before = int(state.final)
            for label, target in state.edges.items():
                keys.append(outer(state) << 8 | label)
                targets.append(outer(target))
                skips.append(before)
                before += target.words
        final = np.zeros(len(states), np.int8)
        for state in states:
            final[outer(state)] = state.final
        flat = [entries[w] for w in words]
        return cls(
            np.array(keys, np.int64),
            np.array(targets, np.int32),
            np.array(skips, np.int32),
            final,
            np.concatenate(([0], np.cumsum([len(x) for x in flat]))).astype(np.int64),
            np.array([i for x in flat for i in x], np.int32),
        )

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, p), k) for p, k in zip(PARTS, KINDS, strict=True)]
        padded = [p.tobytes() + bytes(-p.nbytes % 8) for p in parts]
        return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(padded)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """The file as read-only memory; its pages are shared by all tasks of a machine."""
        raw = np.memmap(path, np.uint8, "r")
        sizes, at, out = raw[: 8 * len(PARTS)].view(np.int64), 8 * len(PARTS), []
        for size, kind in zip(sizes, KINDS, strict=True):
            nbytes = int(size) * np.dtype(kind).itemsize
            out.append(raw[at : at + nbytes].view(kind))
            at += nbytes + -nbytes % 8
        return cls(*out)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon. All words walk at the same time, byte by byte."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return self.find_in(np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def find_in(self, flat: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The same for words that are parts of one array of bytes."""
        n = len(lengths)
        if not n or not len(self.edge_keys):
            return np.full(n, -1)
        state, number = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive, depth = np.flatnonzero(lengths > 0), 0
        number[lengths == 0] = -1
        while len(alive):
            keys = state[alive] << 8 | flat[first[alive] + depth]
            at = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            there = self.edge_keys[at] == keys
            number[alive[~there]] = -1
            alive, at = alive[there], at[there]
            state[alive] = self.edge_targets[at]
            number[alive] += self.edge_skips[at]
            depth += 1
            over = lengths[alive] == depth
            ended = alive[over]
            number[ended[self.final[state[ended]] == 0]] = -1
            alive = alive[~over]
        return number

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.id_ends[number] : self.id_ends[number + 1]].tolist()
