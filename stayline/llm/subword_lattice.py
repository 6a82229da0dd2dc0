"""Log-probabilities of texts under a unigram model of subword pieces, summed over all segmentations.

The pieces and their scores are those of an existing vocabulary; none is added or taken away. A text is its words, A-Z lower-cased,
each spelled with the vocabulary's word mark before it, then one end. Every way to spell it with pieces is a path through a
lattice, and a character may always be spelled by its bytes; the forward recursion adds the paths up in log space, so that the
result is the probability of the text and not that of its best segmentation. No piece holds the mark behind its start, so the
lattice of a text falls apart at its words and every distinct word is run once.

The weight of a piece comes from its score first and from what the training texts say second: the expected counts of the pieces
over all segmentations of the training words (forward and backward recursion), with the vocabulary's own distribution as
``PRIOR`` further occurrences. The model is a distribution over texts: weights of pieces and end add up to one.

Shuffled: one row per task and distinct word, and one per row and distinct rare word. A word that has at least one in
``FREQUENT`` of all training tokens travels in a broadcast; there are at most ``FREQUENT`` of them, whatever the corpus. All others are rare
by that rule, so that none can be a hot key of the join that looks up its count and probability.

Defined cases: a null or empty text is its end alone; a null id hashes like the empty string; without training rows the
weights are those of the vocabulary, and base counts are zero; very long texts and words are run in blocks; repeated rows stay
repeated and count each; columns of the input are kept unless they bear the name of a measure. A word mark inside a text is
spelled by its bytes, bytes that are no UTF-8 as replacement characters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayline.session import cut_lineage

MARK, LITERAL = 0x2581, 0x110000
END = b""
# Weight of the vocabulary's own distribution against the training texts, in pieces.
PRIOR = 32_000.0
ROUNDS = 2
FREQUENT = 200_000
# Expected counts are added up as whole numbers of this fraction, in any order with the same result.
FIXED = 65_536
# Sizes of the work inside a task: distinct words held, bytes of text at a time, characters of a lattice at a time.
HELD_WORDS, BLOCK_BYTES, BAND = 200_000, 4_000_000, 65_536
MEASURES = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def vocabulary(path: str) -> tuple[list[str], list[float]]:
    """Pieces and scores of a vocabulary file, without control pieces and those that hold the mark behind their start; the
    256 bytes come last, with the lowest score of all."""
    from sentencepiece import SentencePieceProcessor

    model, mark = SentencePieceProcessor(model_file=path), chr(MARK)
    own = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    own = [(piece, score) for piece, score in own if mark not in piece[1:]]
    lowest = min(score for _, score in own)
    return [piece for piece, _ in own], [score for _, score in own] + [lowest] * 256


def weights_of(scores: list[float], kind: str) -> np.ndarray:
    """Probabilities of pieces, bytes and end by the vocabulary's scores alone.

    ``kind`` is 'log' where the scores are logarithms of probabilities, and 'rank' where they are the negative rank by falling
    frequency, as in a vocabulary made by merging: a rank weighs 1 / (1 + rank), as Zipf has it. The end weighs one piece in all.
    """
    values = np.array(scores)
    weight = np.exp(values - values.max()) if kind == "log" else 1.0 / (1.0 + np.maximum(-values, 0.0))
    weight = np.append(weight, weight.mean())
    return weight / weight.sum()


def trie(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (state and character in one key, sorted), the states they lead to, and the piece that ends in each state or -1."""
    steps: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, piece in enumerate(pieces):
        at = 0
        for c in map(ord, piece):
            if c not in steps[at]:
                steps[at][c] = len(steps)
                steps.append({})
                ends.append(-1)
            at = steps[at][c]
        ends[at] = i
    edges = sorted((state << 21 | c, to) for state, own in enumerate(steps) for c, to in own.items())
    keys, to = zip(*edges, strict=True)
    return np.array(keys, np.int64), np.array(to, np.int64), np.array(ends, np.int64)


class Lattice:
    """Runs words under one set of weights; made of arrays, bounded by the vocabulary."""

    def __init__(self, keys, to, ends, longest: int, logp: np.ndarray) -> None:
        self.keys, self.to, self.ends, self.longest = keys, to, ends, longest
        self.logp, self.n_pieces = logp, len(logp) - 257
        self._bytes: dict[int, tuple[float, list[int]]] = {}

    def spelled(self, code: int) -> tuple[float, list[int]]:
        """Weight and ids of the bytes of a character."""
        if code not in self._bytes:
            raw = chr(MARK if code == LITERAL else code).encode("utf-8", "surrogatepass")
            ids = [self.n_pieces + b for b in raw]
            self._bytes[code] = float(self.logp[ids].sum()), ids
        return self._bytes[code]

    def edges(self, codes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per start and length the weight of the piece there and its id, and the weight of the bytes; no edge passes a limit."""
        n = len(codes)
        weight, piece = np.full((n, self.longest), -np.inf), np.full((n, self.longest), -1, np.int32)
        alive, state = np.arange(n), np.zeros(n, np.int64)
        for length in range(self.longest):
            inside = alive + length < limits[alive]
            alive, state = alive[inside], state[inside]
            key = state << 21 | codes[alive + length]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, state = alive[hit], self.to[at[hit]]
            if not len(alive):
                break
            found = self.ends[state]
            ended = found >= 0
            piece[alive[ended], length] = found[ended]
            weight[alive[ended], length] = self.logp[found[ended]]
        kinds, which = np.unique(codes, return_inverse=True)
        fallback = np.array([self.spelled(int(c))[0] for c in kinds])[which]
        return weight, piece, fallback

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words, longest first, a band of characters at a time: their places in the list, their codes and their lengths."""
        if not words:
            return
        # A word holds no line end: these stand before the words.
        text = (b"\n" + b"\n".join(words)).decode("utf-8", "replace")
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts = np.flatnonzero(codes == 10)
        codes[codes == MARK] = LITERAL
        codes[starts] = MARK
        sizes = np.diff(np.append(starts, len(codes)))
        order = np.argsort(-sizes, kind="stable")
        ends, at = np.cumsum(sizes[order]), 0
        while at < len(order):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + BAND, side="right")))
            own = order[at:stop]
            places = np.repeat(starts[own] - (ends[at:stop] - sizes[own] - before), sizes[own]) + np.arange(ends[stop - 1] - before)
            yield own, codes[places], sizes[own]
            at = stop

    def forward(self, weight: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-sums over all paths to every place of every word, and where each word's places begin."""
        starts = np.cumsum(sizes) - sizes
        first = starts + np.arange(len(sizes))
        alpha = np.zeros(sizes.sum() + len(sizes))
        for t in range(1, int(sizes[0]) + 1):
            k = int(np.searchsorted(-sizes, -t, side="right"))  # the words that reach t: the longest come first
            lengths = np.arange(1, min(t, self.longest) + 1)
            terms = alpha[first[:k, None] + t - lengths] + weight[starts[:k, None] + t - lengths, lengths - 1]
            top = terms.max(axis=1)
            alpha[first[:k] + t] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
        return alpha, first

    def backward(self, weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log-sums over all paths from every place of every word to its end."""
        starts = np.cumsum(sizes) - sizes
        first = starts + np.arange(len(sizes))
        beta = np.zeros(sizes.sum() + len(sizes))
        for left in range(1, int(sizes[0]) + 1):
            k = int(np.searchsorted(-sizes, -left, side="right"))
            lengths = np.arange(1, min(left, self.longest) + 1)
            at = sizes[:k] - left
            terms = beta[(first[:k] + at)[:, None] + lengths] + weight[(starts[:k] + at)[:, None], lengths - 1]
            top = terms.max(axis=1)
            beta[first[:k] + at] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
        return beta

    def long_forward(self, codes: np.ndarray) -> np.ndarray:
        """The forward recursion over one long word, whose edges are looked up band by band."""
        n, alpha = len(codes), np.full(len(codes) + 1, -np.inf)
        alpha[0] = 0.0
        for band in range(0, n, BAND):
            own = codes[band : band + BAND + self.longest]
            weight, _, fallback = self.edges(own, np.full(len(own), len(own)))
            weight[:, 0] = np.logaddexp(weight[:, 0], fallback)
            for i in range(min(BAND, n - band)):
                at = band + i
                reach = alpha[at + 1 : at + 1 + self.longest]
                np.logaddexp(reach, alpha[at] + weight[i, : len(reach)], out=reach)
        return alpha

    def scores(self, words: list[bytes]) -> np.ndarray:
        """The natural logarithm of the marginal probability of each word."""
        out = np.zeros(len(words))
        for own, codes, sizes in self.batches(words):
            if len(codes) > BAND:
                out[own[0]] = self.long_forward(codes)[-1]
                continue
            weight, _, fallback = self.edges(codes, np.repeat(np.cumsum(sizes), sizes))
            weight[:, 0] = np.logaddexp(weight[:, 0], fallback)
            alpha, first = self.forward(weight, sizes)
            out[own] = alpha[first + sizes]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece and byte over all segmentations, in units of 1 / FIXED."""
        total = np.zeros(self.n_pieces + 256, np.int64)
        for own, codes, sizes in self.batches(words):
            n = counts[own]
            if len(codes) > BAND:
                total += self._long_expected(codes, int(n[0]))
                continue
            weight, piece, fallback = self.edges(codes, np.repeat(np.cumsum(sizes), sizes))
            apart = weight.copy()
            weight[:, 0] = np.logaddexp(weight[:, 0], fallback)
            alpha, first = self.forward(weight, sizes)
            beta = self.backward(weight, sizes)
            word = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(codes)) + word
            base = alpha[place] - alpha[first + sizes][word]
            at, length = np.nonzero(piece >= 0)
            mass = np.exp(base[at] + apart[at, length] + beta[place[at] + length + 1]) * n[word[at]] * FIXED
            total += np.bincount(piece[at, length], np.rint(mass), len(total)).astype(np.int64)
            mass = np.rint(np.exp(base + fallback + beta[place + 1]) * n[word] * FIXED)
            self._add_bytes(total, codes, mass)
        return total

    def _add_bytes(self, total: np.ndarray, codes: np.ndarray, mass: np.ndarray) -> None:
        kinds, which = np.unique(codes, return_inverse=True)
        for code, m in zip(kinds.tolist(), np.bincount(which, mass).astype(np.int64).tolist(), strict=True):
            for i in self.spelled(code)[1]:
                total[i] += m

    def _long_expected(self, codes: np.ndarray, count: int) -> np.ndarray:
        total, n = np.zeros(self.n_pieces + 256, np.int64), len(codes)
        alpha, beta = self.long_forward(codes), np.full(n + 1, -np.inf)
        beta[n] = 0.0
        for band in reversed(range(0, n, BAND)):
            own = codes[band : band + BAND + self.longest]
            weight, piece, fallback = self.edges(own, np.full(len(own), len(own)))
            apart = weight.copy()
            weight[:, 0] = np.logaddexp(weight[:, 0], fallback)
            size = min(BAND, n - band)
            for i in reversed(range(size)):
                reach = beta[band + i + 1 : band + i + 1 + self.longest]
                terms = reach + weight[i, : len(reach)]
                top = terms.max()
                beta[band + i] = top + np.log(np.exp(terms - top).sum())
            at, length = np.nonzero(piece[:size] >= 0)
            mass = np.exp(alpha[band + at] + apart[at, length] + beta[band + at + length + 1] - alpha[n]) * count * FIXED
            total += np.bincount(piece[at, length], np.rint(mass), len(total)).astype(np.int64)
            places = band + np.arange(size)
            mass = np.rint(np.exp(alpha[places] + fallback[:size] + beta[places + 1] - alpha[n]) * count * FIXED)
            self._add_bytes(total, codes[places], mass)
        return total


def blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, a block of bytes at a time; a word is never cut."""
    at = 0
    while len(raw) - at > BLOCK_BYTES:
        stop = at + BLOCK_BYTES
        while stop < len(raw) and raw[stop] not in b" \t\n\x0b\f\r":
            stop += 1
        yield raw[at:stop].lower().split()
        at = stop
    yield (raw[at:] if at else raw).lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """Of (text, held_out) rows all words, with how often each is in texts that are not held out, as (word binary, c); the end
    counts once per row, as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, others = Counter({END: 0}), set()

        def flush() -> pa.RecordBatch:
            others.difference_update(seen)
            words = pa.array([*seen.keys(), *others], pa.binary())
            counts = np.zeros(len(words), np.int64)
            counts[: len(seen)] = np.fromiter(seen.values(), np.int64, len(seen))
            seen.clear()
            others.clear()
            return pa.RecordBatch.from_pydict({"word": words, "c": pa.array(counts)})

        for batch in batches:
            for raw, held in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                add = others.update if held else seen.update
                add((END,))
                for words in blocks(raw.as_py() or b""):
                    add(words)
                if len(seen) + len(others) > HELD_WORDS:
                    yield flush()
        yield flush()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def scored_words(counts: DataFrame, automaton: tuple, logp: np.ndarray) -> DataFrame:
    """Adds ``logp``, the natural logarithm of the marginal probability of each word."""
    shared = counts.sparkSession.sparkContext.broadcast((*automaton, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            words = batch.column(0).to_pylist()
            scores = lattice.scores([w for w in words if w != END])
            out = np.full(len(words), lattice.logp[-1])
            out[np.fromiter((w != END for w in words), bool, len(words))] = scores
            yield pa.RecordBatch.from_pydict({"word": batch.column(0), "c": batch.column(1), "logp": pa.array(out)})

    return counts.select("word", "c").mapInArrow(run, "word binary, c long, logp double")


def fitted(counts: DataFrame, scores: list[float], automaton: tuple, kind: str, rounds: int, prior: float) -> np.ndarray:
    """Log-weights of pieces, bytes and end; one number for each of them reaches the driver in every round."""
    own = weights_of(scores, kind)
    weight, context = own, counts.sparkSession.sparkContext
    row = counts.where(F.col("word") == END).select("c").first()
    n_end = row["c"] if row else 0
    for _ in range(rounds):
        shared = context.broadcast((*automaton, np.log(weight)))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shared.value)
            total = np.zeros(lattice.n_pieces + 256, np.int64)
            for batch in batches:
                total += lattice.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy())
                if total.max() > 1 << 60:
                    yield nonzero(total)
                    total[:] = 0
            yield nonzero(total)

        def nonzero(total: np.ndarray) -> pa.RecordBatch:
            at = np.nonzero(total)[0]
            return pa.RecordBatch.from_pydict({"piece": pa.array(at, pa.int64()), "mass": pa.array(total[at])})

        learned = (
            counts.where((F.col("word") != END) & (F.col("c") > 0))
            .mapInArrow(expect, "piece long, mass long")
            .groupBy("piece")
            .agg(F.sum(F.col("mass").cast("decimal(38,0)")).alias("mass"))
        )
        mass = np.zeros(len(own))
        for row in learned.collect():
            mass[row["piece"]] = float(row["mass"]) / FIXED
        mass[-1] = n_end
        weight = (mass + prior * own) / (mass.sum() + prior)
    return np.log(weight)


def scored(
    docs: DataFrame,
    model_path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    kind: str = "rank",
    rounds: int = ROUNDS,
    prior: float = PRIOR,
    frequent: int = FREQUENT,
) -> DataFrame:
    """The columns of docs but the text, with ``held_out`` (left out of training: crc32 of the id is 1 modulo 5), ``n_tokens``,
    ``n_known`` (tokens of the training rows), ``train_tokens``, ``base_score`` (log10 by smoothed word counts) and ``score``
    (log10 of the marginal probability)."""
    spark = docs.sparkSession
    pieces, scores = vocabulary(model_path)
    automaton = (*trie(pieces), max(map(len, pieces)))
    held_out = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 1
    counts = cut_lineage(word_counts(docs.select(F.col(text), held_out)))
    total = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_train, n_words = total["n"] or 0, total["v"]
    logp = fitted(counts, scores, automaton, kind, rounds, prior)
    words = cut_lineage(scored_words(counts, automaton, logp))
    # At most ``frequent`` words and the end: together they cannot have more than all tokens.
    is_often = ((F.col("c").cast("decimal(20,0)") * frequent >= n_train) & (F.col("c") > 0)) | (F.col("word") == END)
    often = words.where(is_often).collect()
    shared = spark.sparkContext.broadcast(
        (
            {bytes(r["word"]): i for i, r in enumerate(often)},
            np.array([[r["c"], r["logp"]] for r in often] or np.empty((0, 2)), float).T,
            float(logp[-1]),
        )
    )

    kept = [c for c in docs.columns if c not in (text, *MEASURES)]
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept), held_out.alias("held_out")).alias("_row"),
        F.monotonically_increasing_id().alias("_key"),
        F.col(text).alias("_text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of, (count_of, logp_of), end_logp = shared.value
        log_count, is_known = np.log10(count_of + 0.5), count_of > 0
        end = place_of.get(END, -1)
        # Words that are looked up by a join: numbered as they come, and per row which of them and how often.
        numbers: dict[bytes, int] = {}
        nothing = np.empty(0, np.int64)
        seldom = [(nothing, nothing, nothing)]

        def finish(batch: pa.RecordBatch, at: int, rows: list[list]) -> pa.RecordBatch:
            n, score, found, base = zip(*rows, strict=True)
            owner, codes, many = (np.concatenate(parts) for parts in zip(*seldom, strict=True))
            names = pa.array(numbers.keys(), pa.binary())
            seldom[1:] = []
            numbers.clear()
            pairs = pa.StructArray.from_arrays([names.take(pa.array(codes)), pa.array(many)], ["word", "n"])
            ends = np.searchsorted(owner, np.arange(len(rows) + 1))
            return pa.RecordBatch.from_pydict(
                {
                    "_row": batch.column("_row").slice(at, len(rows)),
                    "_key": batch.column("_key").slice(at, len(rows)),
                    "n_tokens": pa.array(n, pa.int64()),
                    "_score": pa.array(score, pa.float64()),
                    "_known": pa.array(found, pa.int64()),
                    "_base": pa.array(base, pa.float64()),
                    "_rare": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                }
            )

        def flush(rows: list[list], tokens: list[bytes], ends: list[int]) -> None:
            """Adds a slice of texts to their rows: the last ones of ``rows``, whose tokens end at ``ends``."""
            if not tokens:
                return
            codes = np.fromiter(map(place_of.get, tokens, repeat(-1)), np.int64, len(tokens))
            sizes = np.diff([0, *ends])
            owner = np.repeat(np.arange(len(ends)), sizes)
            common = codes >= 0
            mine, own = owner[common], codes[common]
            sums = [np.bincount(mine, x[own], len(ends)) for x in (logp_of, is_known, log_count)]
            rest = np.flatnonzero(~common)
            rare = np.fromiter((numbers.setdefault(tokens[i], len(numbers)) for i in rest.tolist()), np.int64, len(rest))
            width = len(numbers) + 1
            pairs, n = np.unique(owner[rest] * width + rare, return_counts=True)
            first = len(rows) - len(ends)
            seldom.append((pairs // width + first, pairs % width, n))
            for row, size, s, k, b in zip(rows[first:], sizes, *sums, strict=True):
                row[0] += int(size)
                row[1] += float(s)
                row[2] += int(k)
                row[3] += float(b)

        for batch in batches:
            rows, begin, held, tokens, ends = [], 0, 0, [], []
            for i, raw in enumerate(batch.column("_text").cast(pa.binary())):
                if end < 0:
                    rows.append([1, end_logp, 0, float(np.log10(0.5))])
                else:
                    rows.append([1, end_logp, int(is_known[end]), float(log_count[end])])
                body = raw.as_py() or b""
                for part in blocks(body):
                    tokens += part
                    held += len(part)
                    ends.append(len(tokens))
                    if len(body) > BLOCK_BYTES:  # a long text: a slice of its own per block, all for the last row
                        flush(rows, tokens, ends)
                        tokens, ends = [], []
                if held > 500_000:
                    flush(rows, tokens, ends)
                    yield finish(batch, begin, rows)
                    rows, begin, held, tokens, ends = [], i + 1, 0, [], []
            if rows:
                flush(rows, tokens, ends)
                yield finish(batch, begin, rows)

    added = "n_tokens long, _score double, _known long, _base double, _rare array<struct<word:binary,n:bigint>>"
    shape = StructType([whole.schema["_row"], whole.schema["_key"], *StructType.fromDDL(added)])
    found = cut_lineage(whole.mapInArrow(run, shape))
    # Every word of the corpus is in the table of words.
    per_row = (
        found.select("_key", F.inline("_rare"))
        .join(words.where(~is_often), "word")
        .groupBy("_key")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_more"),
            F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("_rest"),
            F.sum(F.col("n") * F.col("logp")).alias("_spelled"),
        )
    )
    below = float(np.log10(n_train + 0.5 * (n_words + 1)))
    return found.drop("_rare").join(per_row, "_key", "left").select(
        "_row.*",
        "n_tokens",
        (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_rest", F.lit(0.0)) - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        ((F.col("_score") + F.coalesce("_spelled", F.lit(0.0))) / F.lit(float(np.log(10)))).alias("score"),
    )
