"""Session defaults and the shared folder."""

from jobtide.session import DEFAULT_CONF, get_spark, run_dir, shared_dir


def test_run_dirs_live_under_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b
    assert a.startswith(f"{base}/") and b.startswith(f"{base}/")


def test_defaults_fill_only_unset_keys(spark):
    s = get_spark("again", extra_conf={"spark.sql.shuffle.partitions": "8"})
    assert s is spark  # the active session is reused, not replaced
    assert s.conf.get("spark.sql.shuffle.partitions") == "8"
    cluster = s.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if not cluster.contains(key):
            assert s.conf.get(key) == value, key
    assert s.conf.get("spark.ui.enabled") == "false"


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from jobtide.session import shared_dir

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
