"""Scratch space comes from the session; a cluster without one is an error."""

from __future__ import annotations

import types

import pytest

from quarry.session import ensure_checkpoint_dir, scratch_path


def _stub(master: str, configured: str | None):
    conf = {"spark.checkpoint.dir": configured} if configured else {}
    state = {"dir": None}
    sc = types.SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=d),
    )
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda k, default=None: conf.get(k, default), set=conf.__setitem__),
        sparkContext=sc,
    )


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_stub("spark://cluster:7077", None))


def test_cluster_folder_is_used_as_is():
    spark = _stub("yarn", "hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(spark) == "hdfs:///shared/ckpt"
    assert spark.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"
    p1, p2 = scratch_path(spark, "stage", "x"), scratch_path(spark, "stage", "x")
    assert p1.startswith("hdfs:///shared/ckpt/quarry/stage/x/") and p1 != p2


def test_local_mode_without_folder_gets_a_private_one():
    spark = _stub("local[2]", None)
    assert ensure_checkpoint_dir(spark)
