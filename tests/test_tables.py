from datetime import datetime

import pytest
from helpers import AS_OF, d, dec, tuples

from stayline.plans.warehouse import MARTS, Warehouse, run
from stayline.schemas import RAW_SCHEMAS
from stayline.sources import tables
from stayline.sources.samples import raw_tables


@pytest.mark.parametrize(
    ("target", "layer", "expected"),
    [
        ("dev", "raw", "prod.dbo_raw.t"),
        ("dev", "staging", "dev.sandbox.t"),
        ("dev", "marts", "dev.sandbox.t"),
        ("dev", None, "dev.sandbox.t"),
        ("prod", "raw", "dev.sandbox_raw.t"),
        ("prod", "marts", "dev.sandbox_marts.t"),
        ("prod", None, "dev.sandbox.t"),
    ],
)
def test_routing_by_target_and_layer(target, layer, expected):
    assert tables.routed_name(target, layer, "t", "sandbox", "dev") == expected


def test_routing_with_a_catalog_of_its_own_or_none():
    assert tables.routed_name("prod", "marts", "t", "dbo", "prod", catalog=" other ") == "other.dbo_marts.t"
    assert tables.routed_name("dev", "raw", "t", "sandbox", "dev", catalog="other") == "prod.dbo_raw.t"
    assert tables.routed_name("prod", " marts ", "t", "dbo") == "dbo_marts.t"


def test_csv_keeps_awkward_values(spark, tmp_path):
    rows = [
        ("t1", 'say "hi", then\\leave', "billing", "chat", datetime(2024, 1, 2, 3, 4, 5, 678901), dec("4.1"), True, dec("-0.31")),
        ("t2", "it's; 1,5", None, None, None, None, None, None),
    ]
    schema = RAW_SCHEMAS["raw_support_tickets"]
    df = spark.createDataFrame(rows, schema)
    tables.write_csv(df, str(tmp_path / "x.csv"))
    assert tuples(tables.read_csv(spark, str(tmp_path / "x.csv"), schema)) == tuples(df)


def test_an_empty_csv_field_is_null(spark, tmp_path):
    schema = RAW_SCHEMAS["raw_user_ratings"]
    (tmp_path / "r.csv").write_text('rating_id,customer_id,content_id,rating,rated_at\nr,"",,,\n')
    assert tuples(tables.read_csv(spark, str(tmp_path / "r.csv"), schema)) == [("r", None, None, None, None)]


def test_csv_as_other_tools_write_it(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        "customer_id,email,country,age,signup_date,plan_type,monthly_revenue,is_churned,churn_date,acquisition_channel,"
        "device_type,preferred_genres,activity_level\n"
        "CUST_000001,a@b.c,US,31,2023-05-01,basic,9.99,True,2024-01-01,organic,mobile,Action|Drama,low\n"
        "CUST_000002,,US,31,2023-05-01,basic,9.99,False,,organic,mobile,Drama,low\n"
    )
    got = tables.read_csv(spark, str(tmp_path / "u.csv"), RAW_SCHEMAS["raw_users"]).orderBy("customer_id").collect()
    assert [(r.is_churned, r.churn_date, r.email) for r in got] == [(True, d("2024-01-01"), "a@b.c"), (False, None, None)]


def test_a_line_break_inside_a_field_fails_the_read(spark, tmp_path):
    """Files stay splittable, one record per line; a record over two lines is refused, not torn apart."""
    (tmp_path / "r.csv").write_text('rating_id,customer_id,content_id,rating,rated_at\n"r\nx",c,t,5,2024-01-01\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        tables.read_csv(spark, str(tmp_path / "r.csv"), RAW_SCHEMAS["raw_user_ratings"]).collect()


def test_a_malformed_value_fails_the_read(spark, tmp_path):
    (tmp_path / "r.csv").write_text("rating_id,customer_id,content_id,rating,rated_at\nr,c,t,five,2024-01-01\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        tables.read_csv(spark, str(tmp_path / "r.csv"), RAW_SCHEMAS["raw_user_ratings"]).collect()


def test_full_refresh_replaces_rows_and_schema(spark):
    first = spark.createDataFrame([(1,)], "a int")
    second = spark.createDataFrame([("x", 2)], "b string, c int")
    assert tuples(tables.refresh_table(first, "refresh_test.t")) == [(1,)]
    assert tuples(tables.refresh_table(second, "refresh_test.t")) == [("x", 2)]


def failing(spark):
    return spark.range(100).selectExpr("cast(if(id = 77, raise_error('lost'), id) as int) a")


def test_a_failed_refresh_leaves_the_table_as_it_was(spark):
    good = spark.createDataFrame([(1,)], "a int")
    tables.refresh_table(good, "refresh_test.kept")
    reader = spark.table("refresh_test.kept")
    for bad, checks in ((failing(spark), []), (good.limit(0), [tables.not_empty])):
        with pytest.raises(Exception, match="lost|no rows"):
            tables.refresh_table(bad, "refresh_test.kept", checks=checks)
        assert tuples(spark.table("refresh_test.kept")) == tuples(reader) == [(1,)]
    assert [t.name for t in spark.catalog.listTables("refresh_test") if t.name.startswith("kept")] == ["kept"]
    folder = spark.catalog.getDatabase("refresh_test").locationUri + "/kept.versions"
    assert len(tables._folders(spark, folder)) == 1


def test_a_reader_that_has_begun_keeps_its_version(spark):
    one, two = (spark.createDataFrame([(i,)], "a int") for i in (1, 2))
    tables.refresh_table(one, "refresh_test.versions")
    begun = tables.read_table(spark, "refresh_test.versions")
    assert tuples(begun) == [(1,)]
    assert tuples(tables.refresh_table(two, "refresh_test.versions")) == [(2,)]
    assert tuples(begun) == [(1,)]
    for _ in range(3):
        tables.refresh_table(two, "refresh_test.versions")
    folder = spark.catalog.getDatabase("refresh_test").locationUri + "/versions.versions"
    assert len(tables._folders(spark, folder)) == 2


def test_a_table_of_another_making_is_replaced(spark):
    spark.sql("create schema if not exists refresh_test")
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("refresh_test.managed")
    assert tuples(tables.refresh_table(spark.createDataFrame([(2,)], "a int"), "refresh_test.managed")) == [(2,)]
    assert tuples(tables.refresh_table(spark.createDataFrame([(3,)], "a int"), "refresh_test.managed")) == [(3,)]


def test_folders_are_refreshed_by_pointer(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_folder(spark, folder)
    first = tables.refresh_folder(spark.createDataFrame([(1,)], "a int"), folder)
    with pytest.raises(Exception, match="lost"):
        tables.refresh_folder(failing(spark), folder)
    with pytest.raises(ValueError, match="no rows"):
        tables.refresh_folder(spark.createDataFrame([], "a int"), folder, checks=[tables.not_empty])
    assert tuples(tables.read_folder(spark, folder)) == [(1,)]
    assert tuples(tables.refresh_folder(spark.createDataFrame([("x",)], "b string"), folder)) == [("x",)]
    assert tuples(first) == [(1,)]
    versions = [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()]
    assert len(versions) == 2
    assert tables.current_version(spark, folder) == max(versions)


def test_seeds_catalogue_and_stored_run(spark, tmp_path):
    """CSV seeds and a stored catalogue in, all marts out as tables under their routed names."""
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    tables.write_seeds(raw, str(tmp_path))
    tables.refresh_table(raw["raw_content_catalog"], "run_raw.raw_content_catalog")
    read_back = tables.read_raw(spark, str(tmp_path), "run_raw.raw_content_catalog")
    stored = run(read_back, AS_OF, tables.table_store("prod", "run"))
    assert set(MARTS) <= set(stored)
    lazy = Warehouse(raw, AS_OF)
    for name in ("ml_churn_feature_store", "fct_subscription_event", "fct_daily_user_activity"):
        assert tuples(spark.table(f"run_marts.{name}")) == tuples(lazy[name]), name


def test_parquet_store_reads_back_only_the_asked_columns(spark, tmp_path):
    store = tables.parquet_store(str(tmp_path))
    fact = Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF, store)["fct_watch_event"]
    text = fact.where("watch_duration_minutes > 60").select("customer_key")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<customer_key:string,watch_duration_minutes:int>" in text
    assert "GreaterThan(watch_duration_minutes,60)" in text


def test_views_are_evaluated_on_use(spark):
    tables.publish_views({"stg_x": spark.createDataFrame([(1,)], "a int")}, ["stg_x"])
    assert spark.sql("select a + 1 b from stg_x").first().b == 2


def test_seeds_are_written_compressed(spark, tmp_path):
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    tables.write_seeds(raw, str(tmp_path))
    assert {p.suffix for p in tmp_path.glob("raw_*.csv/part-*")} == {".gz"}
    back = tables.read_seeds(spark, str(tmp_path))
    assert back["raw_watch_events"].count() == raw["raw_watch_events"].count() > 0
