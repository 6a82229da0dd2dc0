"""Encoding and decoding with a byte-level pair vocabulary, over a minimal acyclic transducer of frequent words.

Texts are cut into pre-tokens by the vocabulary's own pattern, each distinct piece between blanks once in a task. A count over the whole corpus gives the frequent pre-tokens;
their ids are compiled into an automaton (``lexicon``) of a stated size, kept in the shared folder, fetched once by each
executor and mapped into memory. Words outside the automaton are merged exactly (``ragged``), so its size changes the speed
and never a result.

Defined cases: a null or empty text has no ids and decodes to the empty text; the special string inside a text is its one
special id, as the tokenizer's default has it; very long texts are whole; repeated rows stay repeated.
"""

from __future__ import annotations

import itertools
import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import ragged
from stayline.llm.lexicon import Lexicon
from stayline.session import cut_lineage, scratch_path

# Words of the lexicon; the rest of the corpus is merged.
LEXICON_WORDS = 40_000
# Distinct words a task holds while it counts, or remembers while it encodes.
HELD_WORDS = 250_000
# Bytes of text cut and encoded at a time.
SLICE_BYTES = 1_000_000
# Fixed value: the cut of a byte-level vocabulary, with blanks as Unicode has them.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def pre_tokens(special: dict[str, int]):
    """A function from a text to its pre-tokens; special strings come out as pre-tokens of their own."""
    import regex

    find = regex.compile(PATTERN).findall
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
    marks = tuple(special)

    def of(text: str) -> list[str]:
        for mark in marks:
            if mark in text:
                break
        else:
            return find(text)
        return [t for part in cut.split(text) if part for t in ([part] if part in special else find(part))]

    return of


@dataclass
class Vocabulary:
    """The vocabulary as arrays; its size bounds what is broadcast."""

    of_byte: np.ndarray
    table: ragged.PairTable
    special: dict[str, int]
    spelled: list[bytes]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        # Printable bytes stand for themselves; the others follow from code point 256 on, in order.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = [b for b in range(256) if b not in printable]
        char_of = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        byte_of = {c: b for b, c in char_of.items()}
        vocab = data["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        table = ragged.PairTable.of(
            np.array([vocab[a] for a, _ in merges]),
            np.array([vocab[b] for _, b in merges]),
            np.arange(len(merges)),
            np.array([vocab[a + b] for a, b in merges]),
        )
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        spelled = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for word, i in vocab.items():
            spelled[i] = bytes(byte_of[c] for c in word)
        for word, i in special.items():
            spelled[i] = word.encode()
        return cls(np.array([vocab[char_of[b]] for b in range(256)], np.int32), table, special, spelled)

    def plain(self) -> tuple:
        """What encoding needs, as arrays and a dictionary: a broadcast names no class of this package, which executors may lack."""
        return self.of_byte, (self.table.keys, self.table.ranks, self.table.merged), self.special

    @classmethod
    def of(cls, plain: tuple) -> Vocabulary:
        of_byte, table, special = plain
        return cls(of_byte, ragged.PairTable(*table), special, [])

    def spelled_arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all ids in one array, with the first byte and the length of each."""
        sizes = np.fromiter(map(len, self.spelled), np.int64, len(self.spelled))
        return np.frombuffer(b"".join(self.spelled), np.uint8), np.cumsum(sizes) - sizes, sizes

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, none of them empty, one word after the other by merging, and how many each has."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return self.merged_in(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))

    def merged_in(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that follow each other in one array of bytes."""
        if not len(lengths):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return ragged.merge(self.of_byte[flat], lengths, self.table)


def gathered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts that the codes name, one after the other, and the end of each."""
    own = sizes[codes]
    ends = np.cumsum(own)
    places = np.repeat(first[codes] - (ends - own), own)
    places += np.arange(len(places))
    return flat[places], ends


# A mark that the quick cut below puts where texts are cut; texts that hold it are cut by the pattern.
CUT = "\1"
# Pieces of which the pre-tokens are plain to see: letters, or letters with one mark behind them. Only letters that every
# edition of the tables calls so; other pieces take the slow way.
WORD = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
MARKED = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?|]$"


def is_plain(piece: str) -> bool:
    """Whether no other white space stands next to the cuts of a piece."""
    core = piece[1:] if piece[:1] == " " else piece
    return piece == "\n" or core != "" and not core[0].isspace() and not core[-1].isspace()


class Numbers(dict):
    """Numbers pieces as they come, the empty one 0; ``fresh`` holds those that came since it was emptied."""

    def __init__(self) -> None:
        super().__init__({"": 0})
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number

    def of(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))


def cut_texts(texts: list[str | None], numbers: Numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts cut before blanks and around line ends: the numbers of all pieces, where each text's pieces end, and which texts
    must be cut by the pattern whatever their pieces are.

    Where ``is_plain`` holds for all pieces of a text, its pre-tokens are those of its pieces, one after the other: no pre-token
    reaches over such a place. The first and last piece of a text may be empty; an empty one elsewhere stands between two cuts,
    and the text is not plain.
    """
    pieces: list[str] = []
    stops, doubtful = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        if text:
            if CUT in text:
                doubtful[i] = True
            else:
                pieces += text.replace(" ", f"{CUT} ").replace("\n", f"{CUT}\n{CUT}").split(CUT)
        stops[i] = len(pieces)
    codes = numbers.of(pieces)
    empty = codes == 0
    own = np.flatnonzero(np.diff(stops, prepend=0))
    empty[stops[own] - 1] = False
    empty[np.append(0, stops)[own]] = False
    doubtful[np.searchsorted(stops, np.flatnonzero(empty), side="right")] = True
    return codes, stops, doubtful


def holding(marks: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which texts hold a marked piece."""
    out = np.zeros(len(stops), bool)
    out[np.searchsorted(stops, np.flatnonzero(marks), side="right")] = True
    return out


def arrow_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column of about ``size`` bytes, one text at least, with the place they begin at."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, column.slice(at, stop - at)
        at = stop


def frequent_words(df: DataFrame, vocabulary: Vocabulary, limit: int, text: str = "text") -> list[str]:
    """Pre-tokens of all rows from a count on: the lowest at which they are at most ``limit``.

    Counts are grouped on a logarithmic scale of eight steps an octave, so that a few hundred numbers find that count, and only
    words of the lexicon reach the driver."""
    special = vocabulary.special

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pre_tokens(special)
        numbers, times, odd = Numbers(), np.zeros(1, np.int64), np.zeros(1, bool)

        def flush() -> pa.RecordBatch:
            own, n = pa.array(list(numbers)[: len(times)], pa.string()), times
            is_word = pc.match_substring_regex(own, WORD).to_numpy(zero_copy_only=False)
            is_marked = pc.match_substring_regex(own, MARKED).to_numpy(zero_copy_only=False)
            marked, others = own.filter(pa.array(is_marked)), Counter()
            for mark, m in zip(pc.utf8_slice_codeunits(marked, -1).to_pylist(), n[is_marked].tolist(), strict=True):
                others[mark] += m
            rest = ~(is_word | is_marked)
            for piece, m in zip(own.filter(pa.array(rest)).to_pylist(), n[rest].tolist(), strict=True):
                for word in cut(piece):
                    others[word] += m
            words = [own.filter(pa.array(is_word)), pc.utf8_slice_codeunits(marked, 0, -1), pa.array(others.keys(), pa.string())]
            counts = np.concatenate([n[is_word], n[is_marked], np.fromiter(others.values(), np.int64, len(others))])
            table = pa.table({"word": pa.concat_arrays(words), "n": counts}).group_by("word", use_threads=False)
            summed = table.aggregate([("n", "sum")]).combine_chunks()
            return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in summed.columns], ["word", "n"])

        def grown() -> None:
            nonlocal odd, times
            fresh, numbers.fresh = numbers.fresh, []
            odd = np.concatenate((odd, np.fromiter((not is_plain(p) for p in fresh), bool, len(fresh))))
            times = np.concatenate((times, np.zeros(len(fresh), np.int64)))

        for batch in batches:
            for _, part in arrow_slices(batch.column(0)):
                texts = part.to_pylist()
                codes, stops, doubtful = cut_texts(texts, numbers)
                grown()
                whole = doubtful | holding(odd[codes], stops)
                if whole.any():
                    codes = codes[~np.repeat(whole, np.diff(stops, prepend=0))]
                    words = numbers.of([w for i in np.flatnonzero(whole).tolist() for w in cut(texts[i])])
                    grown()
                    times += np.bincount(words, minlength=len(times))
                times += np.bincount(codes, minlength=len(times))
                if len(numbers) > HELD_WORDS:
                    yield flush()
                    numbers, times, odd = Numbers(), np.zeros(1, np.int64), np.zeros(1, bool)
        yield flush()

    counts = df.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counts.withColumn("step", F.floor(F.log2(F.col("n").cast("double")) * 8)))
    taken, least = 0, None
    for row in sorted(counted.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        if taken + row["count"] > limit:
            break
        taken, least = taken + row["count"], row["step"]
    if least is None:
        return []
    return sorted(r["word"] for r in counted.where(F.col("step") >= least).select("word").collect())


def compiled(vocabulary: Vocabulary, words: list[str]) -> Lexicon:
    raw = [w.encode("utf-8", "surrogatepass") for w in words if w not in vocabulary.special]
    ids, sizes = vocabulary.merged(raw)
    ends = np.cumsum(sizes).tolist()
    return Lexicon.build({w: ids[a:b].tolist() for w, (a, b) in zip(raw, itertools.pairwise([0, *ends]), strict=True)})


def publish(spark: SparkSession, lexicon: Lexicon) -> str:
    """Writes the lexicon once to the shared folder; every executor fetches its own copy. Returns the file's name."""
    jvm, place = spark.sparkContext._jvm, scratch_path(spark, "lexicon")
    path = jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(lexicon.to_bytes()))
    out.close()
    spark.sparkContext.addFile(str(path))
    return path.getName()


class Encoder:
    """Encodes slices of texts in a task. Ids of the pieces seen so far are held in flat arrays, bounded by HELD_WORDS."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon, self.cut = vocabulary, lexicon, pre_tokens(vocabulary.special)
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.odd = Numbers(), np.zeros(1, bool)
        self.flat, self.sizes = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids end."""
        if len(self.numbers) > HELD_WORDS:
            self._forget()
        codes, stops, doubtful = cut_texts(texts, self.numbers)
        self._learn()
        whole = doubtful | holding(self.odd[codes], stops)
        if whole.any():
            parts = np.split(codes, stops[:-1])
            for i in np.flatnonzero(whole).tolist():
                parts[i] = self.numbers.of(self.cut(texts[i]))
            self._learn()
            codes, stops = np.concatenate(parts), np.cumsum([len(part) for part in parts])
        ids, ends = gathered(self.flat, np.cumsum(self.sizes) - self.sizes, self.sizes, codes)
        return ids, np.append(0, ends)[stops]

    def _learn(self) -> None:
        """Ids and kind of the pieces that came since the last time, in the order of their numbers."""
        new, self.numbers.fresh = self.numbers.fresh, []
        if not new:
            return
        column = pa.array(new, pa.string())
        is_word = pc.match_substring_regex(column, WORD).to_numpy(zero_copy_only=False)
        is_marked = pc.match_substring_regex(column, MARKED).to_numpy(zero_copy_only=False)
        simple = np.flatnonzero(is_word | is_marked)
        odd, sizes = np.zeros(len(new), bool), np.zeros(len(new), np.int64)
        # Letters, straight from the bytes of the column; the id of a mark is that of its byte.
        starts = np.frombuffer(column.buffers()[1], np.int32, len(new) + 1).astype(np.int64)
        raw = np.frombuffer(column.buffers()[2], np.uint8)
        lengths = np.diff(starts)[simple] - is_marked[simple]
        flat, first, own = self._ids_in(raw, starts[simple], lengths)
        marks = raw[starts[simple] + lengths * is_marked[simple]]
        ids, ends = gathered(flat, first, own, np.arange(len(simple)))
        behind = np.flatnonzero(is_marked[simple])
        ids = np.insert(ids, ends[behind], self.vocabulary.of_byte[marks[behind]])
        sizes[simple] = own + is_marked[simple]
        # The others by the pattern.
        rest = np.flatnonzero(~(is_word | is_marked))
        parts = [self.cut(new[i]) for i in rest.tolist()]
        number: dict[str, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for w in itertools.chain.from_iterable(parts)), np.int64)
        more, more_ends = gathered(*self._ids(list(number)), codes)
        bounds = np.append(0, more_ends)[np.cumsum([0, *map(len, parts)])]
        sizes[rest] = np.diff(bounds)
        odd[rest] = [not is_plain(new[i]) for i in rest.tolist()]
        # Flat ids stand in the order of the pieces.
        both, first = np.concatenate((ids, more)), np.empty(len(new), np.int64)
        first[simple] = np.cumsum(sizes[simple]) - sizes[simple]
        first[rest] = len(ids) + np.cumsum(sizes[rest]) - sizes[rest]
        self.flat = np.concatenate((self.flat, gathered(both, first, sizes, np.arange(len(new)))[0]))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.odd = np.concatenate((self.odd, odd))

    def _ids_in(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that are parts of an array of bytes, with the first place and the number of each word's: those that the
        automaton has, and the rest by merging."""
        found = self.lexicon.find_in(raw, starts, lengths)
        unseen, known = np.flatnonzero(found < 0), np.flatnonzero(found >= 0)
        unseen_bytes, _ = gathered(raw, starts, lengths, unseen)
        merged, merged_sizes = self.vocabulary.merged_in(unseen_bytes, lengths[unseen])
        ends = self.lexicon.id_ends
        flat = np.concatenate((self.lexicon.ids, merged))
        first, sizes = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        first[known], sizes[known] = ends[found[known]], ends[found[known] + 1] - ends[found[known]]
        first[unseen] = len(self.lexicon.ids) + np.cumsum(merged_sizes) - merged_sizes
        sizes[unseen] = merged_sizes
        return flat, first, sizes

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words in one array, with the first place and the number of each: special ones, those that the automaton
        has, and the rest by merging."""
        special = np.fromiter((self.vocabulary.special.get(w, -1) for w in words), np.int64, len(words))
        raw = [word.encode("utf-8", "surrogatepass") for word in words]
        found = np.where(special < 0, self.lexicon.find(raw), -1)
        known = np.flatnonzero(found >= 0)
        unseen = np.flatnonzero((found < 0) & (special < 0))
        merged, merged_sizes = self.vocabulary.merged([raw[i] for i in unseen.tolist()])
        ends = self.lexicon.id_ends
        flat = np.concatenate((self.lexicon.ids, merged, np.maximum(special, 0).astype(np.int32)))
        first, sizes = len(flat) - len(words) + np.arange(len(words)), np.ones(len(words), np.int64)
        first[known], sizes[known] = ends[found[known]], ends[found[known] + 1] - ends[found[known]]
        first[unseen] = len(self.lexicon.ids) + np.cumsum(merged_sizes) - merged_sizes
        sizes[unseen] = merged_sizes
        return flat, first, sizes


def encode(
    df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", lexicon_words: int = LEXICON_WORDS
) -> DataFrame:
    """The columns of df but the text, with an array column of token ids; an own column of that name is replaced."""
    spark = df.sparkSession
    vocabulary = Vocabulary.load(vocabulary_path)
    name = publish(spark, compiled(vocabulary, frequent_words(df, vocabulary, lexicon_words, text)))
    shared = spark.sparkContext.broadcast(vocabulary.plain())
    kept = [c for c in df.columns if c not in (text, ids)]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(Vocabulary.of(shared.value), Lexicon.mapped(SparkFiles.get(name)))
        for batch in batches:
            for at, texts in arrow_slices(batch.column(text)):
                own, stops = coder.encode(texts.to_pylist())
                column = pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()), pa.array(own, pa.int32()))
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in kept} | {ids: column})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept]
    return df.mapInArrow(encoded, ", ".join([*fields, f"`{ids}` array<int>"]))


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The columns of df with the text that the ids spell; bytes that are not UTF-8 become replacement characters."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path).spelled_arrays())
    kept = [c for c in df.columns if c != text]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, first, sizes = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = part.column(ids)
                raw, ends = gathered(flat, first, sizes, own.flatten().to_numpy())
                counts = np.cumsum(pc.fill_null(pc.list_value_length(own), 0).to_numpy())
                stops, text_bytes = np.append(0, ends)[counts].tolist(), raw.tobytes()
                out = [text_bytes[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise([0, *stops])]
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in kept} | {text: pa.array(out, pa.string())})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept]
    return df.mapInArrow(decoded, ", ".join([*fields, f"`{text}` string"]))


def digest(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of a frame with ``ids`` and ``decoded``: the number of tokens and digests of both."""
    return df.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
