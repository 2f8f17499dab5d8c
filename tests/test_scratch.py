import os
from types import SimpleNamespace

import pytest

from marketloom.scratch import scratch_folder, scratch_path, scratch_root, written


def session(master, setting=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint
    )
    known = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "file:/w/"}
    conf = SimpleNamespace(get=lambda key, default: known[key] or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    assert scratch_root(session("yarn", setting="hdfs:///tmp/work/")) == "hdfs:///tmp/work"
    assert scratch_root(session("yarn", checkpoint="hdfs:///set")) == "hdfs:///set"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://host:7077"))


def test_a_local_session_uses_its_warehouse():
    assert scratch_root(session("local[2]")) == "file:/w/_scratch"


def test_a_folder_goes_with_its_block(spark, make_panel):
    with scratch_folder(spark, "block") as temp:
        rows = temp(make_panel([{"day": 0}]), "rows")
        path = rows.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and rows.count() == 1
    assert not os.path.exists(os.path.dirname(os.path.dirname(path)))


def test_written_rows_come_back(spark, make_panel):
    panel = make_panel([{"day": d} for d in range(5)])
    again = written(panel, "rows")
    assert again.schema == panel.schema and sorted(again.collect()) == sorted(panel.collect())
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
