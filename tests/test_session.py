import os

from stationlake.session import checkpoint_root, shared_dir


def test_shared_folders_live_under_the_sessions_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root) and os.path.isdir(a)


def test_folders_are_removed_when_the_application_ends_and_a_cluster_needs_the_setting(spark):
    import pytest

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Cluster)


def test_a_local_folder_is_made_only_when_the_setting_is_missing(tmp_path):
    """Needs a JVM without the setting (it is static), so it runs in a child process whose
    configuration folder is empty."""
    import subprocess
    import sys

    conf = tmp_path / "conf"
    conf.mkdir()
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from stationlake.session import checkpoint_root, shared_dir\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "a = checkpoint_root(s); d = shared_dir(s, 'x')\n"
        "assert a == checkpoint_root(s) and d.startswith(a)\n"
        "print('OK', a)\n" % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-2000:]
