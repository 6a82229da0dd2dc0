import re
from collections import Counter

from llm_cases import documents, unharmed, with_clashes

from stayline.llm import rules

TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one two three",
    "the quick brown fox jumps over the lazy dog and then the cat sleeps",
    "a b c d e f g a b c d e " * 4,
    "x\nx\n\nx\n y \n y \nz and the of to in a b c d e f",
    "SHOUT!! EVERY!! WORD!! OF!! THE!! TEXT!! AS!! LOUD!! AS!! CAN!! BE!! NOW!!",
    "a$$$ b&&& c*** d%%% e### f||| g<<< h>>> i$$$ j&&& k*** l%%%",
    "é ü\xa0ñ   ß the of and to in is it as at",
    "word " * 3000,
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        base,
    )


def test_counts_equal_a_plain_version(spark):
    df = documents(spark, list(enumerate(TEXTS)))
    got = {r["doc_id"]: r for r in rules.apply_rules(df).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, text in enumerate(TEXTS):
        assert tuple(got[i][n] for n in names) == plain(text), text
        assert got[i]["kept"] == (not got[i]["base_failed"] and not got[i]["failed_rules"])
    assert got[7]["failed_rules"] == ["upper case"]
    assert got[8]["failed_rules"] == ["symbols per word"]
    assert got[4]["kept"] and got[9]["kept"]


def test_rows_columns_and_empty_tables(spark):
    good = TEXTS[4]
    df = with_clashes(documents(spark, [(1, good), (1, good), (None, good), (2, None)]))
    kept = rules.passing(df)
    assert kept.columns == df.columns and unharmed(kept)
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"]) == [(False, 1), (False, 1)]
    assert kept.count() == 3
    assert rules.apply_rules(documents(spark, [])).count() == 0


def test_an_empty_rule_table_leaves_the_base_rule(spark):
    df = documents(spark, [(1, TEXTS[7]), (2, "few words")])
    assert {r["doc_id"]: r["kept"] for r in rules.apply_rules(df, ()).collect()} == {1: True, 2: False}


def test_plan_is_one_projection_without_python(spark):
    text = rules.apply_rules(documents(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
