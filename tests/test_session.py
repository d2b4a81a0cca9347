"""Session helpers: shared checkpoint directory, scratch paths, profiles."""

import pytest

from marketpulse.session import (CLUSTER_DEFAULTS, SESSION_DEFAULTS, checkpoint_root, is_local,
                                 scratch_path)


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured and root == configured        # read from the session, never replaced
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_session_defaults_applied(spark):
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            assert spark.conf.get(k) == v


def test_cluster_profile_is_a_superset_of_sane_values():
    assert int(CLUSTER_DEFAULTS["spark.sql.shuffle.partitions"]) >= 1000
    assert "RocksDB" in CLUSTER_DEFAULTS["spark.sql.streaming.stateStore.providerClass"]


class _Cluster:
    """A session on a cluster master without a checkpoint folder."""
    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_Cluster)


def test_only_one_process_masters_are_local():
    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[3,2,3000]") and not is_local("yarn")
