from types import SimpleNamespace

import pytest

from civicpanel import lineage


def session(folder, master="yarn", set_before=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: set_before)
    conf = SimpleNamespace(get=lambda key, default: folder if key == lineage.CHECKPOINT_DIR else default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_session_names_the_folder():
    assert lineage.checkpoint_folder(session("hdfs://shared/cp/")) == "hdfs://shared/cp"
    assert lineage.checkpoint_folder(session(None, set_before="hdfs://other")) == "hdfs://other"


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(ValueError, match="shared folder"):
        lineage.checkpoint_folder(session(None))
    assert "civicpanel-checkpoint" in lineage.checkpoint_folder(session(None, master="local[2]"))


def test_written_copy_equals_the_frame(spark):
    df = spark.range(100).selectExpr("id", "CAST(id AS decimal(20,2)) AS d")
    copy = lineage.written(df)
    assert copy.dtypes == df.dtypes and copy.exceptAll(df).count() == 0


def test_copies_of_a_scope_are_deleted(spark):
    import os

    with lineage.Scratch(spark) as scratch:
        first = scratch.written(spark.range(10))
        second = scratch.written(first.where("id > 4"))
        places = [scratch._copies[k][1] for k in (0, 1)]
        assert all(map(os.path.isdir, places))
        scratch.drop(first)
        assert not os.path.isdir(places[0]) and second.count() == 5
        result = lineage.written(second)
    assert not os.path.isdir(places[1]) and result.count() == 5
    with pytest.raises(ValueError, match="stop"), lineage.Scratch(spark) as scratch:
        scratch.written(spark.range(3))
        place = scratch._copies[0][1]
        raise ValueError("stop")
    assert not os.path.isdir(place)
