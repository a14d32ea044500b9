import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_configured_checkpoint_dir_is_used(spark):
    from assetlake.session import checkpoint_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    if configured:
        assert got == configured
    assert checkpoint_dir(spark) == got


def test_unset_checkpoint_dir_gets_a_session_folder(tmp_path):
    """A session without spark.checkpoint.dir (no defaults file) still works."""
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from assetlake.session import checkpoint_dir
        from assetlake.operators.rank import dense_ids
        s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        assert s.conf.get("spark.checkpoint.dir", None) is None
        a = checkpoint_dir(s)
        assert checkpoint_dir(s) == a
        ids = dense_ids(s.createDataFrame([("b",), ("a",)], "n string"), "n")
        assert sorted((r.n, r.id) for r in ids.collect()) == [("a", 0), ("b", 1)]
        print("ok", a)
    """)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    r = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "ok " in r.stdout
