from tidemark.session import SEMANTIC_CONF, ensure_checkpoint_dir, get_session


def test_get_session_keeps_launch_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ckpt = spark.sparkContext.getCheckpointDir()
    s = get_session("again")
    assert s is spark
    assert s.conf.get("spark.sql.shuffle.partitions") == before
    assert ensure_checkpoint_dir(s) == ckpt
    for k, v in SEMANTIC_CONF.items():
        assert s.conf.get(k) == v
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
