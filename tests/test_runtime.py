"""Session helpers: cluster sizing, temporary settings, shared folder."""

import os

from shoplens.runtime import scale_conf, session_conf, shared_dir


def test_scale_conf_sizes_partitions_from_input():
    small = scale_conf(10 << 30, total_cores=64)
    big = scale_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64          # floor: three tasks per core
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)  # ~256 MB each
    assert big["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")


def test_session_conf_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_conf(spark, {"spark.sql.shuffle.partitions": 3}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_dir_lives_under_the_checkpoint_folder(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir")
    assert a != b and os.path.commonpath([a, root.replace("file:", "")]) == root.replace("file:", "")
