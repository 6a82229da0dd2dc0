import itertools
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from llm_cases import documents, unharmed, with_clashes

from stayline.llm import subword_lattice as lattice

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_lattice(word, weight):
    """Sum over all segmentations and expected pieces of a short word, by writing every segmentation out."""
    text = "▁" + word.decode().replace("▁", "\0")

    def ways(at):
        if at == len(text):
            yield ()
        for stop in range(at + 1, len(text) + 1):
            if text[at:stop] in weight:
                yield from ((text[at:stop], *rest) for rest in ways(stop))
        if at < len(text):
            raw = text[at].replace("\0", "▁").encode()
            yield from ((*raw, *rest) for rest in ways(at + 1))

    total, expected = 0.0, Counter()
    for way in ways(0):
        p = math.prod(weight[x] for x in way)
        total += p
        for x in way:
            expected[x] += p
    return total, {x: m / total for x, m in expected.items()}


def plain_scores(rows, rounds=lattice.ROUNDS):
    """All columns but the id, row by row, in plain Python; dictionaries in place of arrays and tables."""
    pieces, scores = lattice.vocabulary(MODEL)
    names = [*pieces, *range(256), "end"]
    own = [1 / (1 + max(-s, 0)) for s in scores]
    own.append(sum(own) / len(own))
    own = dict(zip(names, (w / sum(own) for w in own), strict=True))
    words = {i: (t or "").encode().lower().split() for i, (_, t) in enumerate(rows)}
    held = {i: crc32(str("" if d is None else d).encode()) % 5 == 1 for i, (d, _) in enumerate(rows)}
    counts = Counter(w for i in words if not held[i] for w in [*words[i], b""])
    n, v = sum(counts.values()), len(counts)
    weight = own
    for _ in range(rounds):
        mass = Counter({"end": counts[b""]})
        for word, c in counts.items():
            if word:
                for x, m in plain_lattice(word, weight)[1].items():
                    mass[x] += m * c
        total = sum(mass.values())
        weight = {x: (mass[x] + lattice.PRIOR * own[x]) / (total + lattice.PRIOR) for x in names}
    out = []
    for i in words:
        tokens = [*words[i], b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        score = sum(math.log10(plain_lattice(w, weight)[0]) for w in words[i]) + math.log10(weight["end"])
        out.append((held[i], len(tokens), sum(w in counts for w in tokens), n, base, score))
    return out


def rows():
    rng = random.Random(3)
    parts = ["the", "Thin", "and", "é", "日本", "a▁b", "ing", "▁", "qzx", "\x01", "𝒳", "of", "ions"]
    out = [(i, " ".join("".join(rng.choices(parts, k=rng.choice((1, 1, 2)))) for _ in range(rng.randint(1, 12)))) for i in range(25)]
    return [*out, (3, out[3][1]), (None, "the end of\x85it"), (40, None), (41, ""), (42, " \t\n\x0b\f\r "), (43, "the " * 50)]


def as_tuples(df):
    return sorted((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 4)) for r in df.collect())


@pytest.mark.parametrize("frequent", [1, 4, lattice.FREQUENT])
def test_scores_are_those_of_all_segmentations_written_out(spark, frequent):
    own = rows()
    got = lattice.scored(documents(spark, own).repartition(3), MODEL, frequent=frequent)
    want = sorted((*r[:4], round(r[4], 6), round(r[5], 4)) for r in plain_scores(own))
    assert [r[:4] for r in as_tuples(got)] == [r[:4] for r in want]
    for a, b in zip(as_tuples(got), want, strict=True):
        assert a[4] == pytest.approx(b[4], abs=1e-5)
        assert a[5] == pytest.approx(b[5], abs=2e-3)  # expected counts are whole multiples of 1 / FIXED


def small_lattice(pieces, logp):
    return lattice.Lattice(*lattice.trie(pieces), max(map(len, pieces)), np.array(logp))


def test_weights_of_all_texts_add_up_to_at_most_one():
    pieces = ["▁", "▁a", "a", "ab", "b", "▁ab"]
    weight = lattice.weights_of([-1.0, -2.0, -3.0, -4.0, -5.0, -6.0] + [-7.0] * 256, "rank")
    assert weight.sum() == pytest.approx(1.0)
    own = small_lattice(pieces, np.log(weight))
    # All words over two letters up to five long: their probabilities are part of a whole.
    words = [w for n in range(6) for w in ("".join(x) for x in itertools.product("ab", repeat=n))]
    assert 0 < np.exp(own.scores([w.encode() for w in words])).sum() < 1
    logs = lattice.weights_of([-1.0, -2.0] + [-9.0] * 256, "log")
    assert logs[0] / logs[1] == pytest.approx(math.e)


def test_long_words_are_run_in_bands_with_the_same_result(monkeypatch):
    pieces, scores = lattice.vocabulary(MODEL)
    own = small_lattice(pieces, np.log(lattice.weights_of(scores, "rank")))
    words = [b"thinghand" * 40, "日本é".encode() * 30, b"a" * 333, b"on"]
    whole, mass = own.scores(words), own.expected(words, np.array([2, 3, 1, 5]))
    monkeypatch.setattr(lattice, "BAND", 50)
    assert own.scores(words) == pytest.approx(whole)
    assert np.abs(own.expected(words, np.array([2, 3, 1, 5])) - mass).max() <= 400


def test_long_texts_are_read_in_blocks(spark, monkeypatch):
    own = [(i, f"the thing {i} and ▁ of " * 40) for i in range(8)]
    want = as_tuples(lattice.scored(documents(spark, own), MODEL))
    monkeypatch.setattr(lattice, "BLOCK_BYTES", 100)
    for a, b in zip(as_tuples(lattice.scored(documents(spark, own), MODEL)), want, strict=True):
        assert a == pytest.approx(b)


def test_empty_tables_other_columns_and_no_training_rows(spark):
    assert lattice.scored(documents(spark, []), MODEL).count() == 0
    got = lattice.scored(with_clashes(documents(spark, [(1, "a b"), (2, None)])), MODEL)
    assert got.count() == 2
    assert unharmed(got)
    held = next(i for i in range(99) if crc32(str(i).encode()) % 5 == 1)
    row = lattice.scored(documents(spark, [(held, "the cat")]), MODEL).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (True, 3, 0, 0, 0.0)
    assert -20 < row["score"] < 0
