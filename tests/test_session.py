"""Scratch location rules."""

from netpulse.session import checkpoint_root, configure, scratch_path


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/netpulse/x/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_configure_sets_runtime_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
