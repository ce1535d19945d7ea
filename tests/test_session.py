"""Cluster sizing and scratch folders."""

import os

import pytest
from conftest import SF_SMALL
from roadlens import session


def test_shuffle_partitions_scale_with_input():
    tb = 10 ** 12
    assert session.shuffle_partitions_for(0) == session.MIN_SHUFFLE_PARTITIONS
    assert session.shuffle_partitions_for(tb) > 5_000
    # 100 TB keeps the same bytes per partition: no cap
    n = session.shuffle_partitions_for(100 * tb)
    assert 100 * tb * session.SHUFFLE_EXPANSION / n <= session.TARGET_SHUFFLE_PARTITION_BYTES
    sizes = [session.shuffle_partitions_for(k * tb // 10) for k in range(1, 30)]
    assert sizes == sorted(sizes)


def test_input_bytes_from_listing(spark):
    n = session.input_bytes(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    assert abs(n - os.path.getsize(f"{SF_SMALL}/events.parquet")) < 1024


def test_set_partitions_left_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session.size_for_input(spark, f"{SF_SMALL}/events.parquet")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_default_partitions_grow_only_for_large_input(spark, monkeypatch):
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "200")
    session.size_for_input(s, f"{SF_SMALL}/events.parquet")
    assert s.conf.get("spark.sql.shuffle.partitions") == "200"
    monkeypatch.setattr(session, "input_bytes", lambda df: 10 ** 12)
    session.size_for_input(s, f"{SF_SMALL}/events.parquet")
    assert int(s.conf.get("spark.sql.shuffle.partitions")) == session.shuffle_partitions_for(10 ** 12)


class _Cluster:
    """Only what checkpoint_dir asks of a session without spark.checkpoint.dir."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Cluster)


@pytest.mark.parametrize("master,local", [("local", True), ("local[8]", True), ("local[*]", True), ("local[4,2]", True),
                                          ("local-cluster[3,2,1024]", False), ("yarn", False), ("k8s://x", False)])
def test_is_local(master, local):
    assert session.is_local(type("S", (), {"sparkContext": type("C", (), {"master": master})})) is local


def test_scratch_path_is_fresh_and_below_the_shared_folder(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(session.checkpoint_dir(spark)) and not os.path.exists(a)


def test_stream_session_has_its_own_state_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = session.stream_session(spark, 5)
    assert s.conf.get("spark.sql.shuffle.partitions") == "5"
    assert s.conf.get("spark.sql.streaming.stateStore.providerClass") == session.ROCKSDB
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
