from types import SimpleNamespace

import pytest

from rowloom.plans.staging import staging_path, staging_root


def session(setting=None, checkpoint=None, master="spark://host:7077"):
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint, master=master, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_the_named_shared_folder_is_used():
    assert staging_root(session(setting="s3a://bucket/checkpoints/")) == "s3a://bucket/checkpoints"
    assert staging_root(session(checkpoint="hdfs://nn/c/1")) == "hdfs://nn/c/1"
    first, second = (staging_path(session(setting="/shared"), "settled") for _ in range(2))
    assert first.startswith("/shared/rowloom/settled-") and first != second


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(session())
    assert staging_root(session(master="local[2]")).startswith("/tmp/run-")
