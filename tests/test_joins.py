import pytest
from pyspark.sql import functions as F

from casewise.operators import joins
from casewise.session import durable

SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_hot_key_is_shared_out(spark, skew_settings, how):
    rows = spark.range(0, 400_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    table = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = joins.split_join(rows, table, ["k"], how)
    out = joined.agg(F.count("*"), F.max("payload"), F.max(joined.columns[-1]))
    assert out.collect()[0][0] == 400_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_rows, expected", [(10, True), (2, False)])
def test_lookup_is_broadcast_only_below_its_bound(spark, max_rows, expected):
    rows = spark.range(100).select((F.col("id") % 4).alias("k"), "id")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    out = joins.lookup(rows, table, ["k"], max_rows=max_rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == expected
    assert out.where("name is null").count() == 25 and out.count() == 100


def test_durable_uses_the_session_folder(spark):
    df = durable(spark.range(5))
    folder = spark.sparkContext.getCheckpointDir()
    assert df.count() == 5 and folder is not None
    assert spark.conf.get("spark.checkpoint.dir", folder) in folder or folder.startswith("file:")
