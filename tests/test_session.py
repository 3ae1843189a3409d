"""The shared working folder."""

from types import SimpleNamespace

import pytest

from duskwatch.session import shared_dir, stage, work_dir


def fake(master, configured=None, given=None):
    made = []
    sc = SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": configured}, getCheckpointDir=lambda: made[-1] if made else given, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=sc)


def test_setting_first_then_what_was_given():
    assert shared_dir(fake("yarn", "hdfs://x/work/")) == "hdfs://x/work"
    assert shared_dir(fake("yarn", None, "s3a://y/work")) == "s3a://y/work"


@pytest.mark.parametrize("master", ["yarn", "spark://h:1", "local-cluster[2,1,512]"])
def test_no_folder_on_a_cluster_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(fake(master), "x")


def test_local_sessions_get_one():
    assert "duskwatch-" in shared_dir(fake("local[4]"))


def test_stage_reads_back_what_it_wrote(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n bigint, t string")
    assert sorted(map(str, stage(df, "t").collect())) == sorted(map(str, df.collect()))
    assert stage(df.limit(0), "t").schema == df.schema
