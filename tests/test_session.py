from types import SimpleNamespace

import pytest

from marketbars.session import ensure_checkpoint_dir, work_dir


def fake(shared, master="local[2]"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared),
        sparkContext=SimpleNamespace(master=master),
    )


def test_work_dir_is_below_the_shared_folder():
    first, second = (work_dir(fake("s3a://bucket/shared/"), "run") for _ in range(2))
    assert first.startswith("s3a://bucket/shared/run-")
    assert first != second


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(fake(None, master="yarn"), "run")
    assert "run-" in work_dir(fake(None), "run")


def test_checkpoint_dir_is_kept(spark):
    ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert before and spark.sparkContext.getCheckpointDir() == before
