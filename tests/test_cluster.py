import os
import time

import pytest

from docenrich import storage
from docenrich.cluster import drop_scratch, scratch_path, shared_dir, written_once


class _Cluster:
    """As much of a session as tells that it runs on a cluster and names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Cluster)


def test_a_local_session_gets_one(spark):
    assert shared_dir(spark).startswith("file:")


def test_only_old_scratch_is_dropped(spark):
    root = storage.local_path(shared_dir(spark))
    kept = [os.path.join(root, name) for name in ("mine", "state-1", f"{'a' * 8}-{'b' * 32}.txt")]
    for folder in kept:
        os.makedirs(folder, exist_ok=True)
    fresh = written_once(spark.range(3), "fresh")
    old = storage.local_path(scratch_path(spark, "old-label"))
    os.makedirs(old)
    for folder in [*kept, old]:
        os.utime(folder, (1000, 1000))
    assert drop_scratch(spark, before=2000) == 1
    assert not os.path.exists(old) and all(map(os.path.exists, kept)) and fresh.count() == 3
    assert drop_scratch(spark, before=time.time() - 10_000) == 0
