import os

import pytest

from corpusweave import session


class Stub:
    def __init__(self, named, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()


def test_the_named_folder_is_used(spark):
    assert session.shared_dir(Stub("/shared/x", "yarn")) == "/shared/x"
    assert session.run_dir(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError):
        session.shared_dir(Stub(None, "spark://host:7077"))


def test_a_local_session_makes_its_own_once():
    own = session.shared_dir(Stub(None, "local[2]"))
    assert os.path.isdir(own) and session.shared_dir(Stub(None, "local[2]")) == own


def test_written_tables_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "array(cast(id as string)) as a")
    back = session.written(df, "t")
    assert back.dtypes == df.dtypes and back.count() == 10
    empty = session.written(df.where("id < 0"), "t")
    assert empty.count() == 0 and empty.columns == ["id", "a"]


def test_only_scans_of_few_splits_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread_small(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    for n in (cores, session.SPREAD_SPLITS + 1):
        same = spark.range(0, 100, 1, n)
        assert session.spread_small(same) is same
