from datetime import datetime

import pytest
from helpers import d, dec, tuples
from pyspark.sql import functions as F

from stayline.schemas import RAW_SCHEMAS, table_schema
from stayline.sources import rejects, tables

RATINGS = RAW_SCHEMAS["raw_user_ratings"]
HEADER = "rating_id,customer_id,content_id,rating,rated_at\n"


def split(spark, path, *args, **kwargs):
    kept, rejected = rejects.read_csv_checked(spark, str(path), *args, **kwargs)
    return tuples(kept), sorted((r["file"].rsplit("/", 1)[-1], r["line"], r["reasons"], r["record"]) for r in rejected.collect())


def test_bad_records_are_set_aside_with_file_line_and_reasons(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER + "r1,c,t,5,2024-01-01\n\nr2,c,t,five,2024-01-01\nr3,c,t,4\nr4,c,t,4,2024-01-01,x\n" + '"r5,""q""",c,,,\n'
    )
    (tmp_path / "b.csv").write_text(HEADER + "r6,c,t,99999999999,soon\nr7,c,t,3,2024-1-1\n" + HEADER)
    kept, rejected = split(spark, tmp_path, RATINGS)
    assert kept == [("r1", "c", "t", 5, d("2024-01-01")), ('r5,"q"', "c", None, None, None)]
    assert rejected == [
        ("a.csv", 4, ["bad int: rating"], "r2,c,t,five,2024-01-01"),
        ("a.csv", 5, ["malformed record"], "r3,c,t,4"),
        ("a.csv", 6, ["malformed record"], "r4,c,t,4,2024-01-01,x"),
        ("b.csv", 2, ["bad int: rating", "bad date: rated_at"], "r6,c,t,99999999999,soon"),
        ("b.csv", 3, ["bad date: rated_at"], "r7,c,t,3,2024-1-1"),
        ("b.csv", 4, ["bad int: rating", "bad date: rated_at"], HEADER.strip()),
    ]


def test_lines_are_counted_over_the_splits_of_a_file(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="200", spark__sql__files__openCostInBytes="0")
    for name in "xy":
        (tmp_path / f"{name}.csv").write_text(HEADER + "".join(f"r{i},c,t,{'bad' if i % 7 == 3 else i},2024-01-01\n" for i in range(200)))
    df = rejects.numbered_lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 10
    kept, rejected = split(spark, tmp_path, RATINGS)
    assert len(kept) + len(rejected) == 400
    want = [(f"{name}.csv", i + 2) for name in "xy" for i in range(200) if i % 7 == 3]
    assert [r[:2] for r in rejected] == want


def test_good_files_read_as_the_strict_reader_reads_them(spark, tmp_path):
    schema = RAW_SCHEMAS["raw_support_tickets"]
    rows = [
        ("t1", 'say "hi", then\\leave', "billing", "chat", datetime(2024, 1, 2, 3, 4, 5, 678901), dec("4.1"), True, dec("-0.31")),
        ("t2", "it's; 1,5", None, None, datetime(2024, 1, 2, 3, 4, 5), None, False, None),
    ]
    tables.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "x.csv"))
    kept, rejected = rejects.read_csv_checked(spark, str(tmp_path / "x.csv"), schema)
    assert kept.schema == schema
    assert tuples(kept) == tuples(tables.read_csv(spark, str(tmp_path / "x.csv"), schema))
    assert rejected.isEmpty()


@pytest.mark.parametrize(
    ("kind", "good", "bad"),
    [("int", "+5", "5.0"), ("boolean", "TRUE", "yes"), ("decimal(5,2)", "1.25", "1e9"), ("double", "1e3", "x"), ("date", "2024-02-29", "2023-02-29")],
)
def test_casts_by_type(spark, tmp_path, kind, good, bad):
    (tmp_path / "v.csv").write_text(f"{good},a\n{bad},b\n,c\n")
    schema = spark.createDataFrame([], f"v {kind}, name string").schema
    kept, rejected = split(spark, tmp_path / "v.csv", schema, header=False)
    assert {r[1]: r[0] is None for r in kept} == {"a": False, "c": True}
    assert rejected == [("v.csv", 2, [f"bad {kind}: v"], f"{bad},b")]


def test_json_documents_and_the_reject_table(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"id": 1, "runtime": "90"}\n{"id": \n{"id": "x"}\n\n{"id": 2}\n')
    schema = table_schema(id=RATINGS["rating"].dataType, runtime=RATINGS["rating_id"].dataType)
    kept, rejected = rejects.read_json_checked(spark, str(tmp_path), schema)
    assert tuples(kept) == [(1, "90"), (2, None)]
    assert sorted(r["line"] for r in rejected.collect()) == [2, 3]
    spark.sql("create schema if not exists reject_test")
    for _ in range(2):
        rejects.append_rejects(rejected, "pages", "reject_test.rejects")
    assert spark.table("reject_test.rejects").where(F.col("source") == "pages").count() == 4
