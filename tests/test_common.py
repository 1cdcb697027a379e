"""Intermediate tables: where they lie and that they go."""

import os

from quarry.operators.common import Scratch


def _local(path):
    return path.split(":", 1)[-1]


def test_scratch_writes_under_the_checkpoint_folder_and_releases(spark):
    folder = _local(spark.sparkContext.getCheckpointDir())
    scratch = Scratch(spark)
    out = scratch.save(spark.range(0, 50).selectExpr("id", "id * 2 as x"))
    assert out.inputFiles() and all(folder in f for f in out.inputFiles())
    assert out.count() == 50
    assert os.path.isdir(_local(scratch.path))
    scratch.release()
    assert not os.path.exists(_local(scratch.path))


def test_scratch_in_a_folder_of_the_caller(spark, tmp_path):
    scratch = Scratch(spark, f"file://{tmp_path}/work")
    assert scratch.save(spark.range(3)).count() == 3
    assert os.listdir(tmp_path / "work")
    scratch.release()
    assert not os.listdir(tmp_path / "work")
