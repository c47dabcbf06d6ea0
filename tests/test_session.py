import __spark_entry__ as E
from cutpoint.operators.prefix import RELIABLE_REUSE, release
from cutpoint.session import ensure_checkpoint_dir, scale_conf


def test_checkpoint_dir_is_shared_setting(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def test_reliable_reuse_gives_same_answers(spark, sf001):
    a = sorted(map(tuple, E.queries()["psi"](spark, sf001).collect()))
    spark.conf.set(RELIABLE_REUSE, "true")
    try:
        b = sorted(map(tuple, E.queries()["psi"](spark, sf001).collect()))
    finally:
        spark.conf.set(RELIABLE_REUSE, "false")
        release()
    assert a == b


def test_scale_conf():
    c = scale_conf(100 * 2**40)
    assert int(c["spark.sql.shuffle.partitions"]) >= 8000
    assert c["spark.sql.adaptive.enabled"] == "true"
