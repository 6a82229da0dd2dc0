import random
import re

from llm_cases import documents, unharmed, with_clashes
from pyspark.sql import functions as F

from stayline.llm import secrets

KEY = "AKIA" + "ABCD2345EFGH6789"


def corpus(n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(["tion", "er", "the", "an", "lich", "keit"], k=rng.randint(1, 7))) for _ in range(60)]
        if i % 5 == 0:
            words.insert(30, "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)))
        if i % 7 == 0:
            words.insert(10, f'token = "{rng.getrandbits(160):040x}"')
        rows.append((i, " ".join(words)))
    return rows


def test_planted_secrets_go_and_words_stay(spark):
    rows = corpus()
    train, held_out = documents(spark, rows[:200]), documents(spark, rows[200:])
    words, score = secrets.trained(train)
    found = secrets.scan(held_out, words, score).select("doc_id", "text", "redacted", F.explode("findings").alias("f")).collect()
    real = re.compile(r"^(AKIA\w{16}|[0-9a-f]{40})$")
    assert {bool(r["f"]["real"]) for r in found} == {True, False}
    for r in found:
        value, start = r["f"]["value"], r["f"]["start"]
        assert r["text"][start : start + len(value)] == value
        assert r["f"]["real"] == bool(real.match(value)), value
    # The candidates are those of a plain search.
    for i, text in rows[200:]:
        assert [r["f"]["value"] for r in found if r["doc_id"] == i] == re.findall(secrets.CANDIDATE, text)


def test_redaction_keeps_everything_else(spark):
    rows = [*corpus(120), (500, f"ä {KEY}, {KEY} end"), (501, None), (502, ""), (502, ""), (None, f"x {KEY}"), (503, KEY)]
    df = with_clashes(documents(spark, rows).withColumn("source", F.when(F.col("doc_id") != 500, F.lit("a/b.env"))))
    out = secrets.redacted(df)
    assert out.columns == df.columns and unharmed(out)
    got = {r["doc_id"]: r["text"] for r in out.where("doc_id >= 500 or doc_id is null").collect()}
    assert got == {500: "ä [SECRET], [SECRET] end", 501: None, 502: "", None: "x [SECRET]", 503: "[SECRET]"}
    assert out.count() == len(rows)


def test_without_labels_of_both_kinds(spark):
    assert secrets.redacted(documents(spark, [])).count() == 0
    words = documents(spark, [(1, "no candidate here")])
    assert secrets.redacted(words).collect()[0]["text"] == "no candidate here"
    one_kind = documents(spark, [(1, "averyveryverylongplainword")])
    assert secrets.redacted(one_kind).collect()[0]["text"] == "averyveryverylongplainword"


def test_labelled_rows_are_bounded_and_scan_is_one_projection(spark):
    df = documents(spark, corpus(100))
    words = secrets.dictionary(df)
    assert secrets.labelled_findings(df, words, limit=20).count() <= 20
    plan = secrets.scan(df, words, secrets.compiled(0.5))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
