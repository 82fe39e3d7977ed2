"""The shared folder comes from the session; a local one is set only when
the session names none."""

import pytest

from entiscore.session import ensure_checkpoint_dir, scratch_path


def test_existing_checkpoint_dir_is_kept(spark, tmp_path):
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(str(tmp_path / "shared"))
    try:
        configured = sc.getCheckpointDir()
        assert ensure_checkpoint_dir(spark) == configured
        p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
        assert p1.startswith(configured) and p1 != p2  # fresh folder per call
    finally:
        if before:
            sc.setCheckpointDir(before)


def test_a_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
