from tickcast.session import checkpoint_dir, cluster_settings, ensure_session, scratch_path


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10**9)
    big = cluster_settings(100 * 10**12)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_session_pins_utc_and_uses_checkpoint_dir(spark):
    ensure_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    base = checkpoint_dir(spark)
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(base.rstrip("/"))


def test_session_conf_restores_caller_settings(spark):
    from tickcast.session import session_conf, stream_settings

    spark.conf.set("spark.sql.shuffle.partitions", "8")
    with session_conf(spark, stream_settings(spark, 3)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_no_local_scratch_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
