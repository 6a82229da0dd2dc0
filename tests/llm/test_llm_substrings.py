import random

from llm_cases import documents, unharmed, with_clashes

from stayline.llm import substrings

BAG = [f"word{i:03d}" for i in range(500)]


def prose(rng, n):
    return " ".join(rng.choices(BAG, k=n))


def test_chunks_cover_the_text_and_resist_insertions():
    rng = random.Random(1)
    text = "  " + prose(rng, 400).replace(" ", "\n", 3) + " é"
    starts, words = substrings.chunk_starts(text.encode())
    assert starts[0] == 0 and (words > 0).all() and words.sum() == len(text.split())
    bounds = [*starts.tolist(), len(text.encode())]
    cut = lambda raw, at: {raw[a:b] for a, b in zip(at, at[1:])}
    shifted = (prose(rng, 3) + " " + text).encode()
    more = [*substrings.chunk_starts(shifted)[0].tolist(), len(shifted)]
    before, after = cut(text.encode(), bounds), cut(shifted, more)
    assert len(before & after) >= len(before) - 3


def test_passages_of_fifty_words_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(2)
    passages = [prose(rng, 51) for _ in range(30)]
    rows = [(i, f"{prose(rng, 40)} {passages[i % 30]} {prose(rng, 25 + i % 9)}") for i in range(60)]
    rows += [(100 + i, prose(rng, 90)) for i in range(40)]
    got = {r["doc_id"]: r for r in substrings.repeats(documents(spark, rows).repartition(4)).collect()}
    assert all(got[i]["n_repeat_words"] >= 16 for i in range(60))
    assert all(got[100 + i]["n_repeat_words"] == 0 for i in range(40))
    assert all(16 <= got[i]["n_removed_words"] + got[i + 30]["n_removed_words"] <= 51 for i in range(30))
    assert all(min(got[i]["n_removed_words"], got[i + 30]["n_removed_words"]) == 0 for i in range(30))
    # Brute force: a removed range is text that another document holds.
    texts = dict(rows)
    for r in got.values():
        raw = texts[r["doc_id"]].encode()
        for a, b in zip(r["removed"][::2], r["removed"][1::2]):
            assert any(raw[a:b] in other.encode() for i, other in texts.items() if i != r["doc_id"])


def test_copies_nulls_and_extra_columns(spark):
    rng = random.Random(3)
    text = prose(rng, 80)
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, " \n "), (5, "same " * 300), (6, "short text")]
    df = with_clashes(documents(spark, rows).coalesce(1))
    out = substrings.deduplicated(df)
    assert out.columns == df.columns and unharmed(out)
    texts = [r["text"] for r in out.collect()]
    assert sorted(texts, key=repr) == sorted([text, "", "", None, "", " \n ", "same " * 300, "short text"], key=repr)
    rows_of = {r["doc_id"]: r for r in substrings.repeats(df).collect()}
    assert (rows_of[2]["n_chunks"], rows_of[4]["n_words"], rows_of[5]["n_words"]) == (0, 0, 300)


def test_empty_table(spark):
    assert substrings.repeats(documents(spark, [])).count() == 0
    assert substrings.deduplicated(documents(spark, [])).count() == 0
