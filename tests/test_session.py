"""The shared work folder comes from the session's checkpoint folder."""

from strata.session import DEFAULT_CONF, checkpoint_root, work_dir


def test_work_dirs_live_under_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and configured.rstrip("/").split("/")[-1] in root
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_default_conf_keeps_the_ui_off_and_aqe_on():
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
