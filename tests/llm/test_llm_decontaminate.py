import random
import re
from hashlib import sha256

from llm_cases import documents, unharmed, with_clashes

from stayline.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        if item is None or not w:
            continue
        for i in range(max(1, len(w) - window + 1)):
            one = w[i : i + window]
            for at in range(len(own) - len(one) + 1):
                if own[at : at + len(one)] == one:
                    hit.update(range(at, at + len(one)))
                    found.add(item)
    return len(own), len(hit), sorted(found)


def cases(seed):
    rng = random.Random(seed)
    bag = [*"abcdefgh", "É", "ß", "X9", "日本"]
    some = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choices(bag, k=n))
    items = [(i, some(rng.choice([0, 1, 2, 3, 4, 6]))) for i in range(12)] + [(3, some(5)), (None, some(3)), (99, None)]
    docs = [(i, some(rng.randint(0, 40))) for i in range(60)] + [(60, None), (61, ""), (1, some(9)), (None, some(20))]
    return docs, items


def test_hits_equal_a_plain_version_in_one_block_and_in_many(spark):
    for seed in (1, 2):
        docs, items = cases(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        want = sorted(((d, *plain(t, items, 3)) for d, t in docs), key=repr)
        for block in (1_000, 5):
            found = decontaminate.contamination(documents(spark, docs), bench, window=3, block_windows=block).collect()
            got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=repr)
            assert got == want


def test_digest(spark):
    bench = spark.createDataFrame([(10, "a b c"), (9, "b c d")], "item_id long, text string")
    docs = documents(spark, [(1, "x a b c d"), (2, "nothing here")])
    rows = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.contamination(docs, bench, 3)).collect()}
    assert rows[1]["n_items"] == 2 and rows[1]["contaminated"] and not rows[2]["contaminated"]
    assert rows[1]["items_sha256"] == sha256(b"10,9").hexdigest()
    assert rows[2]["items_sha256"] == sha256(b"").hexdigest()


def test_spans_are_cut_and_mostly_hit_documents_go(spark):
    bench = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    rows = [(1, "One, (B-C d) end. More words stay here!"), (2, "b c d x"), (3, None), (4, "clean  text "), (4, "clean  text ")]
    df = with_clashes(documents(spark, rows))
    out = decontaminate.decontaminated(df, bench, window=3)
    assert out.columns == df.columns and unharmed(out)
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == [(1, "One, ( ) end. More words stay here!"), (3, None), (4, "clean  text "), (4, "clean  text ")]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, "a b c")])
    assert decontaminate.contamination(docs, empty).collect()[0]["n_hit"] == 0
    assert decontaminate.decontaminated(docs, empty).count() == 1
    assert decontaminate.contamination(documents(spark, []), empty).count() == 0


def test_item_ids_may_be_text(spark):
    docs = documents(spark, [(1, "a b c d e f g h i j k"), (2, "none of it")])
    items = spark.createDataFrame([("q-1", "a b c d e f g h i j"), ("q-0", "b c d e f g h i j k")], "item_id string, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: ["q-0", "q-1"], 2: []}
    assert decontaminate.digest(decontaminate.contamination(docs, items)).count() == 2
