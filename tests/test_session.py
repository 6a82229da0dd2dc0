import os

from stayline import session
from stayline.session import cut_lineage, remove_intermediates, scratch_path, shared_dir


def test_nothing_is_left_after_a_run(spark):
    remove_intermediates(spark)
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    frame = cut_lineage(spark.range(10))
    assert frame.count() == 10
    scratch_path(spark, "never-written")
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before
    assert remove_intermediates(spark) == 2
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
    assert remove_intermediates(spark) == 0


def test_what_is_stored_for_a_folder_is_known_by_its_files(spark, tmp_path):
    (tmp_path / "a.parquet").write_text("x")
    first = session.run_key(spark, str(tmp_path))
    assert session.run_key(spark, str(tmp_path)) == first
    (tmp_path / "a.parquet").write_text("longer")
    assert session.run_key(spark, str(tmp_path)) != first


def test_a_table_is_broadcast_by_its_rows_not_by_its_files(spark, conf, tmp_path):
    """Keys in sequence take a few bits in a file and a whole row each in the driver."""
    conf(spark__sql__autoBroadcastJoinThreshold="1m", spark__sql__adaptive__autoBroadcastJoinThreshold="1m")
    path = str(tmp_path / "t")
    spark.range(0, 300_000, 1, 1).selectExpr("id k", "id % 5 v").write.parquet(path)
    size = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path))
    assert session.UNMEASURED_BROADCAST < size < 2**20
    big = spark.range(0, 600_000, 1, 4).selectExpr("id % 300000 k", "id w")
    session.prepare(spark)
    joined = big.join(spark.read.parquet(path), "k")
    assert joined.count() == 600_000
    joined.collect()
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    few = big.join(spark.read.parquet(path).where("v = 1").groupBy("k").count().where("k < 100"), "k")
    assert len(few.collect()) == 40
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_session_without_broadcasts_stays_so(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    session.prepare(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
