"""Where intermediate tables go."""

import pytest

from ferryline import shared


class Session:
    """Just the settings that the choice of folder depends on."""

    def __init__(self, master, folder=None):
        self.conf = {shared.CHECKPOINT_DIR: folder}
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app-1"})


def test_the_configured_folder_is_used():
    assert shared.shared_dir(Session("spark://x", "hdfs:///shared")) == "hdfs:///shared"
    assert shared.new_path(Session("spark://x", "hdfs:///s/"), "load").startswith("hdfs:///s/load-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session("spark://x"))


def test_local_mode_keeps_one_temporary_folder():
    first = shared.shared_dir(Session("local[2]"))
    assert first == shared.shared_dir(Session("local[2]"))


def test_materialize_cuts_lineage(spark):
    stored = shared.materialize(spark.range(10).repartition(3))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and stored.count() == 10
