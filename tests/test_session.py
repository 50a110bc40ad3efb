"""Session helper: settings fixed elsewhere are kept."""

from sparkqc.session import _launcher_conf, ensure_checkpoint_dir, get_session


def test_active_session_is_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        s = get_session()
        assert s is spark
        assert s.conf.get("spark.sql.shuffle.partitions") == "13"
        assert s.sparkContext.master == "local[4]"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_launcher_outside_spark_submit(monkeypatch):
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    assert _launcher_conf() == {}


def test_checkpoint_dir_is_read_from_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_cluster_master_needs_shared_checkpoint_dir():
    """No machine-local fallback folder on a cluster master."""
    import pytest

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
