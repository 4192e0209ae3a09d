import pytest
from pyspark.sql import functions as F

from casewise.operators import metrics, sampling
from casewise.plans import jobs

GOLD = "call_id int, state string, district string, crop string, season string, question string, answer string, category string, query_type string"


def calls(spark, sizes):
    data, i = [], 0
    for category, n in sizes.items():
        for _ in range(n):
            data.append((i, "K", "D", "C", "R", "q", "a", category, "t"))
            i += 1
    return spark.createDataFrame(data, GOLD)


def test_U6_equal_shares_and_top_up(spark):
    sample = sampling.sample_gold(calls(spark, {"a": 300, "b": 40, "c": 3}), n=30)
    counts = {r[0]: r[1] for r in sample.groupBy("category").count().collect()}
    assert sum(counts.values()) == 30 and counts["c"] == 3 and counts["a"] >= 10 and counts["b"] >= 10
    assert sample.select("call_id").distinct().count() == 30
    assert sample.columns[-4:] == ["category_verified", "query_type_verified", "resolution_signal_verified", "notes"]


def test_U6_more_categories_than_n(spark):
    assert sampling.sample_gold(calls(spark, {x: 2 for x in "abcdef"}), n=4).count() == 6


def test_U6_large_samples_take_the_histogram(spark, rows, monkeypatch):
    df = calls(spark, {"a": 300, "b": 40, "c": 3})
    small = rows(sampling.sample_gold(df, n=90), "call_id")
    monkeypatch.setattr(sampling, "GROUP_LIMIT", 10)
    assert rows(sampling.sample_gold(df, n=90), "call_id") == small and len(small) == 90


def test_U6_same_rows_however_partitioned(spark, rows):
    df = calls(spark, {"a": 300, "b": 40})
    once, again = (sampling.sample_gold(d, n=20) for d in (df, df.repartition(9)))
    assert rows(once, "call_id") == rows(again, "call_id")
    assert rows(sampling.sample_gold(df, n=20, seed=7), "call_id") != rows(once, "call_id")


@pytest.mark.parametrize("quota", [0, 1, 57, 300, 500])
def test_W7_quota_is_exact(spark, quota):
    df = calls(spark, {"a": 300})
    quotas = spark.createDataFrame([("a", quota)], "category string, quota int")
    taken = sampling.take_by_hash(df, quotas, "category", "call_id", 1)
    assert taken.count() == 300
    lowest = [r[0] for r in df.orderBy(sampling.draw_key("call_id", 1), "call_id").limit(quota).collect()] if quota else []
    assert sorted(r["call_id"] for r in taken.where("taken").collect()) == sorted(lowest)


def test_U8_split(spark):
    df = calls(spark, {"a": 101, "b": 33, "c": 5})
    train, test = sampling.stratified_split(df, "category", "call_id")
    assert test.count() == 28 and train.count() == 111  # ceil(0.2 * 139)
    assert train.join(test, "call_id").count() == 0
    assert {r[0]: r[1] for r in test.groupBy("category").count().collect()} == {"a": 20, "b": 7, "c": 1}


def test_U7_verified_labels_are_truth(spark):
    sample = sampling.sample_gold(calls(spark, {"a": 4}), n=4)
    labelled = sample.withColumn("category_verified", F.lit("fixed")).withColumn(
        "resolution_signal_verified", F.when(F.col("call_id") == 0, "resolved").when(F.col("call_id") == 1, "")
    )
    assert tuple(sampling.blank_signals(labelled).first()) == (4, 3)
    gold = sampling.merge_gold(labelled)
    assert "notes" not in gold.columns and len(gold.columns) == len(set(gold.columns))
    assert {r["category"] for r in gold.collect()} == {"fixed"} and "resolution_signal" in gold.columns


def test_M7_labels_are_the_union_and_zero_division_is_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "x")], "t string, p string")
    report = {r["label"]: r for r in metrics.per_class(metrics.confusion(df, "t", "p")).collect()}
    assert set(report) == {"a", "b", "c", "x"}
    assert report["c"]["f1"] == 0 and report["x"]["support"] == 0
    row = metrics.scores(df, "t", "p").first()
    assert row["accuracy"] == 0.5
    assert row["macro_f1"] == pytest.approx((2 / 3 + 2 / 3 + 0 + 0) / 4)


def test_L2_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "y string")
    assert {r["y"]: r["weight"] for r in metrics.class_weights(df, "y").collect()} == {"a": pytest.approx(2 / 3), "b": 2.0}


def test_M9_agreement(spark):
    votes = [(1, "x"), (1, "x"), (1, "y"), (2, "z"), (2, "z"), (2, "z")]
    found = metrics.vote_agreement(spark.createDataFrame(votes, "id int, v string"), "id", ["v"]).first()
    assert (found["n_records"], found["n_repeats"]) == (2, 3) and found["mean_agreement"] == pytest.approx((2 / 3 + 1) / 2)


def test_JN4_JN5(spark):
    gold = spark.createDataFrame([(1, "A", "R"), (2, "B", None), (3, "C", "R")], "call_id int, Category string, signal string")
    extracted = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (9, "z")], "call_id int, category string")
    both = metrics.align(gold, extracted, "call_id")
    assert both.columns == ["call_id", "gold_Category", "gold_signal", "ext_category"] and both.count() == 3
    assert tuple(metrics.align_audit(gold, extracted, "call_id").first()) == (3, 4, 3, 1)
    assert metrics.align_audit(gold, extracted.where("call_id <> 2"), "call_id").first()["n_dropped"] == 2
    with pytest.raises(ValueError, match="gold_signal"):
        metrics.require_values(both, ["gold_Category", "gold_signal"])
    assert metrics.require_values(both, ["gold_Category"]) is both


@pytest.mark.parametrize("base, expected", [("t", "Baseline classifier"), ("e", "Tie"), ("x", "LLM extraction")])
def test_L8_winner(spark, base, expected):
    df = spark.createDataFrame([("a", "a", "s", "s", "zz"), ("b", "c", "s", "u", "zz")], "t string, e string, gs string, es string, x string")
    row = jobs.compare_methods(df, "t", "e", "gs", "es", base).first()
    assert row["winner"] == expected and row["n_compared"] == 2 and row["signal_accuracy"] == 0.5


def test_U8_null_stratum_gets_its_quota(spark):
    df = spark.createDataFrame([(i, [None, "a", "b", "c"][i % 4]) for i in range(100)], "call_id int, topic string")
    quotas = df.groupBy("topic").agg(F.lit(5).alias("quota"))
    taken = sampling.take_by_hash(df, quotas, "topic", "call_id", 1).where("taken")
    assert {r["topic"]: r["count"] for r in taken.groupBy("topic").count().collect()} == {None: 5, "a": 5, "b": 5, "c": 5}
