"""Session helpers: the shared checkpoint folder and cluster sizing."""

from tierstat.session import checkpoint_root, scale_conf, scratch_path


def test_checkpoint_folder_is_the_sessions(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root.replace("file:", "").startswith(configured.replace("file:", ""))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_scale_conf_sizes_partitions_by_input():
    small = scale_conf(1 << 30, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"  # three waves of 8 cores
    big = scale_conf(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_stats_table_reuses_a_stored_path(spark, tmp_path):
    import os

    from conftest import SF001
    from tierstat.sources import tpch

    path = str(tmp_path / "stats")
    tpch._MATERIALISED.clear()
    built = tpch.stats_table(spark, SF001, path=path)  # nothing there yet: built and written
    marker = os.path.join(path, "_SUCCESS")
    stamp = os.stat(marker).st_mtime_ns
    tpch._MATERIALISED.clear()
    again = tpch.stats_table(spark, SF001, path=path)  # a later application: read, not rebuilt
    assert os.stat(marker).st_mtime_ns == stamp
    assert again.count() == built.count() == 1763
    assert again.columns == built.columns
    tpch._MATERIALISED.clear()


def test_refresh_replaces_only_the_given_periods(spark, tmp_path):
    import glob
    import os

    from conftest import SF001
    from tierstat.sources import tpch

    path = str(tmp_path / "stats")
    full = tpch.store_stats(spark, SF001, path=path)
    before = sorted(tuple(repr(v) for v in r) for r in full.collect())

    def files(period):
        return {
            f: os.stat(f).st_mtime_ns
            for f in glob.glob(os.path.join(path, f"time_period={period.replace('/', '%2F')}", "*", "*.parquet"))
        }

    old_1995, old_1997 = files("1995/96"), files("1997/98")
    refreshed = tpch.refresh_periods(spark, SF001, path, years=[1997])
    after = sorted(tuple(repr(v) for v in r) for r in refreshed.collect())
    assert after == before  # same table, row for row
    assert files("1995/96") == old_1995  # other periods untouched
    assert set(files("1997/98")).isdisjoint(old_1997)  # this period's files replaced
    tpch._MATERIALISED.clear()


def test_local_fallback_when_no_checkpoint_folder_is_configured(tmp_path):
    """Without spark.checkpoint.dir (and a local master) a temporary folder is set."""
    import os
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from tierstat.session import local_session, checkpoint_root\n"
        "from tierstat.functions import global_row_number\n"
        "s = local_session(2)\n"
        "assert not s.conf.get('spark.checkpoint.dir', None)\n"
        "print(checkpoint_root(s))\n"
        "print(global_row_number(s.range(5).toDF('v'), ['v']).count())\n"
    ) % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))  # no spark-defaults.conf there
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    lines = out.stdout.strip().splitlines()
    assert out.returncode == 0, out.stderr[-2000:]
    assert "tierstat-ckpt-" in lines[-2] and lines[-1] == "5"


def test_stats_table_rebuilds_when_its_files_are_gone(spark, tmp_path):
    from conftest import SF001
    from tierstat.sources import tpch

    tpch._MATERIALISED.clear()
    first = tpch.stats_table(spark, SF001)
    key = tpch._key(spark, SF001, tpch.DEFAULT, None)
    # Simulate a cleaned-up scratch folder: the remembered path no longer exists.
    tpch._MATERIALISED[key] = (tpch.inputs_mark(spark, SF001), str(tmp_path / "gone"), first)
    again = tpch.stats_table(spark, SF001)
    assert again.count() == 1763
    assert tpch._MATERIALISED[key][1] != str(tmp_path / "gone")  # rebuilt at a new path
    tpch._MATERIALISED.clear()


def test_ordinal_and_percent_names():
    from tierstat.functions import ordinal
    from tierstat.operators.ratios import percent_name

    assert [ordinal(n) for n in (1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 101, 111, 112)] == [
        "1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "101st", "111th", "112th"
    ]
    assert percent_name("sess_auth_illness_percent") == "illness_percent"
    assert percent_name("sess_unauth_late_percent") == "unauth_late_percent"
    assert percent_name("enrolments_pa_10_exact_percent") == "enrolments_pa_10_exact_percent"
