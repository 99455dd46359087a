from tickweave.session import RUNTIME_CONF, checkpoint_root, configure, work_path


def test_work_paths_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a.startswith(root + "/tickweave/x-") and a != b


def test_configure_is_idempotent(spark):
    configure(spark)
    configure(spark)
    for k, v in RUNTIME_CONF.items():
        assert spark.conf.get(k) == v


def test_configure_leaves_the_callers_settings(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "123")
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        configure(spark)
        assert spark.conf.get(key) == "123" and spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
