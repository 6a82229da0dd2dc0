"""Token counts of a byte-fallback piece vocabulary, by rank-synchronous merging of ragged arrays.

A text gets a leading blank and blanks become the visible blank mark. Pieces hold that mark at their start only, so texts
are cut before each run of marks, and at line ends, which are in no piece. The distinct pre-tokens of a slice of texts are
merged together (``ragged.merge``); the symbols that survive are counted, a character outside the vocabulary as its bytes.

Defined cases: a null or empty text has no tokens; strings that look like special pieces are ordinary text; very long texts
are cut into the same pre-tokens, and a long pre-token is merged with a queue of its own. Repeated rows stay repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import ragged

MARK = "▁"
# Texts are counted in slices of about this many characters, and a task remembers this many counts between them.
SLICE_CHARS = 1_000_000
REMEMBERED = 300_000


@dataclass
class Pieces:
    """A piece vocabulary, bounded by its own size: what is broadcast is a few MB whatever the corpus."""

    of_char: np.ndarray
    weight: np.ndarray
    table: ragged.PairTable
    cut: str

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        chars = {c for piece in score for c in piece}
        number = {piece: i for i, piece in enumerate(sorted(chars | score.keys()))}
        # Equal scores share a rank, so that the leftmost of them merges first.
        rank = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = [
            (number[piece[:k]], number[piece[k:]], rank[score[piece]], number[piece])
            for piece in score
            for k in range(1, len(piece))
            if piece[:k] in number and piece[k:] in number
        ]
        # Symbols after the known ones stand for unknown characters of 1 to 4 bytes.
        weight = np.ones(len(number) + 5, dtype=np.int64)
        weight[-5:] = range(5)
        for c in chars - score.keys():
            weight[number[c]] = len(c.encode())
        of_char = np.empty(0x110000, dtype=np.int32)
        for size, limit in ((4, 0x110000), (3, 0x10000), (2, 0x800), (1, 0x80)):
            of_char[:limit] = len(number) + size
        for c in chars:
            of_char[ord(c)] = number[c]
        assert all(MARK not in piece.lstrip(MARK) for piece in score)
        return cls(of_char, weight, ragged.PairTable.of(*map(np.array, zip(*pairs, strict=True))), "" if "\n" in chars else "\n")

    def plain(self) -> tuple:
        """The same as arrays: a broadcast names no class of this package, which executors may lack."""
        return self.of_char, self.weight, (self.table.keys, self.table.ranks, self.table.merged), self.cut

    @classmethod
    def of(cls, plain: tuple) -> Pieces:
        of_char, weight, table, cut = plain
        return cls(of_char, weight, ragged.PairTable(*table), cut)

    def pre_tokens(self):
        if self.cut:
            return re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall
        return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall

    def counts(self, tokens: list[str]) -> list[int]:
        """Surviving symbols of each pre-token."""
        codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        symbols, sizes = ragged.merge(self.of_char[codes], lengths, self.table)
        return np.add.reduceat(self.weight[symbols], np.cumsum(sizes) - sizes).tolist()


def slices(texts: list[str | None], size: int = SLICE_CHARS) -> Iterator[list[str]]:
    held, n = [], 0
    for text in texts:
        held.append(text or "")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def token_counts(df: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """The columns of df but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``; own columns of these names go."""
    shared = df.sparkSession.sparkContext.broadcast(Pieces.load(model_path).plain())
    kept = [c for c in df.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(shared.value)
        find, known = pieces.pre_tokens(), {}
        for batch in batches:
            n_bytes, n_tokens = [], []
            for texts in slices(batch.column(text).to_pylist()):
                tokens, ends = [], []
                for body in texts:
                    if body:
                        tokens += find(MARK + body.replace(" ", MARK))
                    ends.append(len(tokens))
                if len(known) > REMEMBERED:
                    known = {}
                new = list(set(tokens).difference(known))
                if new:
                    known.update(zip(new, pieces.counts(new), strict=True))
                total = np.cumsum([0, *map(known.__getitem__, tokens)])[np.array([0, *ends])]
                n_tokens += np.diff(total).tolist()
                n_bytes += [len(body.encode("utf-8", "surrogatepass")) for body in texts]
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in kept}
                | {"n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64())}
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept]
    out = df.mapInArrow(count, ", ".join([*fields, "n_bytes long", "n_tokens long"]))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
