"""Where intermediates are stored, and that they can be removed."""

import os
from types import SimpleNamespace

import pytest

from salesops.sources.storage import _base, drop_stored, drop_work, materialize


def test_a_cluster_session_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(master="spark://host:7077", applicationId="app-1", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _base(session)


def test_the_context_is_left_alone(spark):
    before = spark.sparkContext.getCheckpointDir()
    materialize(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() == before


def test_stored_tables_can_be_dropped_one_by_one_and_all_together(spark):
    one, two = materialize(spark.range(3)), materialize(spark.range(4))
    folder = os.path.dirname(one.inputFiles()[0].removeprefix("file://"))
    drop_stored(one)
    assert not os.path.exists(folder) and two.count() == 4
    drop_work(spark)
    assert not os.path.exists(os.path.dirname(folder))


def test_other_files_are_not_dropped(spark, sf):
    with pytest.raises(ValueError):
        drop_stored(spark.read.parquet(f"{sf}/region.parquet"))
