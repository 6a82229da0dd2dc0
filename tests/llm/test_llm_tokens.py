import random
from hashlib import sha256

import numpy as np
import pytest
from llm_cases import documents

from stayline.llm import byte_bpe, ragged, token_counts
from stayline.llm.lexicon import Lexicon

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(11)
    parts = [*"ab  \n\t▁éüßñ日本語𝒳<>s/0x'll Aaaa...---　ﬁ​\xa0²½٣\x1c\x85", "<|endoftext|>", "</s>", "the ", "don't", " we'll"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    return [*out, "", " ", "\n", "a" * 3000, "ab" * 900 + "the" * 500, " " * 1500, "x\n\n y", "日" * 700, "é" * 20]


@pytest.fixture(scope="module")
def rows(spark):
    own = texts()
    kept = spark.createDataFrame(
        [*((i, t, "old") for i, t in enumerate(own)), (9000, None, "old"), (0, own[0], "old")], "doc_id long, text string, n_tokens string"
    )
    return own, kept


def test_counts_are_those_of_the_library(rows):
    from sentencepiece import SentencePieceProcessor

    model, (own, df) = SentencePieceProcessor(model_file=PIECES), rows
    got = token_counts.token_counts(df.repartition(3), PIECES).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(own) + 2
    for i, text in enumerate(own):
        assert by_id[i]["n_tokens"] == len(model.encode(text)), repr(text)
        assert by_id[i]["n_bytes"] == len(text.encode())
    assert (by_id[9000]["n_tokens"], by_id[9000]["n_bytes"], by_id[9000]["over_limit"]) == (0, 0, False)


def test_ids_and_texts_are_those_of_the_library_whatever_the_lexicon_holds(rows):
    from tokenizers import Tokenizer

    library, (own, df) = Tokenizer.from_file(BYTES), rows
    hashed = lambda text: sha256(text.encode()).hexdigest()
    for size in (0, 50):
        encoded = byte_bpe.encode(df.repartition(2).select("doc_id", "text"), BYTES, lexicon_words=size)
        got = byte_bpe.digest(byte_bpe.decode(encoded, BYTES)).collect()
        by_id = {r["doc_id"]: r for r in got}
        assert len(got) == len(own) + 2
        for i, text in enumerate(own):
            ids = library.encode(text, add_special_tokens=False).ids
            assert by_id[i]["n_tokens"] == len(ids), repr(text)
            assert by_id[i]["ids_sha256"] == hashed(",".join(map(str, ids))), repr(text)
            assert by_id[i]["decoded_sha256"] == hashed(library.decode(ids, skip_special_tokens=False)), repr(text)
        assert (by_id[9000]["n_tokens"], by_id[9000]["decoded_sha256"]) == (0, hashed(""))


def test_the_quick_cut_is_the_pattern_wherever_no_text_is_odd():
    cut = byte_bpe.pre_tokens({"<|endoftext|>": 0})
    rng = random.Random(13)
    own = ["".join(rng.choice([*"aé.!,7\t", "the ", " of", "\n", " ", "\x85"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    numbers = byte_bpe.Numbers()
    codes, stops, doubtful = byte_bpe.cut_texts([*own, None], numbers)
    names = list(numbers)
    odd = doubtful | byte_bpe.holding(np.array([p != "" and not byte_bpe.is_plain(p) for p in names])[codes], stops)
    assert 0 < odd.sum() < len(own)
    for text, skip, a, b in zip(own, odd, [0, *stops], stops, strict=False):
        if not skip:
            assert [w for c in codes[a:b] for w in cut(names[c])] == cut(text), repr(text)


def test_texts_that_hold_the_cut_mark_are_whole(spark):
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(BYTES), random.Random(12)
    own = ["".join(rng.choice([*"ab \n\t\1\2.é", "the ", "\1\1"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    own += ["\1", "a\1b", " \1", "\1 ", "\n\1\n", "a b", "\1<|endoftext|>\1"]
    doubtful = byte_bpe.cut_texts(own, byte_bpe.Numbers())[2]
    assert all(d for text, d in zip(own, doubtful, strict=True) if "\1" in text)
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    for size in (0, 50):
        got = byte_bpe.decode(byte_bpe.encode(df.withColumn("kept", df["text"]), BYTES, lexicon_words=size), BYTES).collect()
        assert len(got) == len(own)
        for r in got:
            assert r["decoded"] == r["kept"]
            assert r["ids"] == library.encode(r["kept"], add_special_tokens=False).ids, repr(r["kept"])
    # Counted as the words that they are.
    vocabulary = byte_bpe.Vocabulary.load(BYTES)
    few = spark.createDataFrame([(0, "a\1b"), (1, "\1")], "doc_id long, text string")
    assert byte_bpe.frequent_words(few, vocabulary, 10) == ["\1", "a", "b"]


def test_empty_table(spark):
    df = documents(spark, []).select("doc_id", "text")
    assert token_counts.token_counts(df, PIECES).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(df, BYTES), BYTES).count() == 0


def test_merging_all_sequences_at_once_equals_one_by_one():
    rng = np.random.default_rng(3)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 12, (60, 2))}
    left, right = map(np.array, zip(*sorted(pairs)))
    ranks, merged = rng.permutation(len(left)) // 2, rng.integers(0, 12, len(left))
    table = ragged.PairTable.of(left, right, ranks, merged)
    rule = {(a, b): (r, m) for a, b, r, m in zip(left, right, ranks, merged)}

    def slow(seq):
        while True:
            found = [(rule[p][0], i) for i, p in enumerate(zip(seq, seq[1:])) if p in rule]
            if not found:
                return seq
            _, i = min(found)
            seq = [*seq[:i], int(rule[seq[i], seq[i + 1]][1]), *seq[i + 2 :]]

    sequences = [rng.integers(0, 12, n).tolist() for n in [*rng.integers(1, 30, 200), ragged.LONG + 40, 1]]
    flat = np.array([x for s in sequences for x in s], np.int32)
    symbols, sizes = ragged.merge(flat, np.array([len(s) for s in sequences]), table)
    assert [p.tolist() for p in np.split(symbols, np.cumsum(sizes)[:-1])] == [slow(s) for s in sequences]


def test_lexicon_shares_suffixes_and_finds_only_its_words(tmp_path):
    words = [b"walking", b"talking", b"walk", b"talk", b"king", "ñandú".encode()]
    lexicon = Lexicon.build({w: [i, i + 1] for i, w in enumerate(words)})
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.to_bytes())
    mapped = Lexicon.mapped(str(path))
    assert len(mapped.final) < 1 + sum(map(len, words)) - 10
    asked = [*words, b"", b"wal", b"walkin", b"kings", b"x"]
    found = mapped.find(asked).tolist()
    assert found[6:] == [-1] * 5 and len(set(found[:6])) == 6
    assert [mapped.ids_of(n) for n in found[:6]] == [[i, i + 1] for i in range(6)]
    assert Lexicon.build({}).find([b"a"]).tolist() == [-1]
