import pytest
from pyspark.sql import functions as F

from casewise.operators import hierarchy
from casewise.operators.hierarchy import HierarchicalClassifier
from casewise.plans import jobs

TEXTS = {
    ("Fruits", "Pest"): "insect borer attack on mango fruit tree",
    ("Fruits", "Water"): "water irrigation drip for mango fruit tree",
    ("Cereals", "Seed"): "seed rate variety sowing of wheat paddy cereal",
    ("Cereals", "Price"): "market price rate of wheat paddy cereal today",
    ("Cereals", "Rust"): "leaf rust disease spots in wheat paddy cereal",
    ("Spices", "Weather"): "rain forecast for pepper cardamom spice",
    ("Fodder", "Rare 1"): "grass fodder silage cattle one",
}


@pytest.fixture(scope="module")
def calls(spark):
    data, i = [], 0
    for (category, label), text in TEXTS.items():
        for k in range(2 if category == "Fodder" else 12):
            data.append((i, f"{text} {'please help now'.split()[k % 3]} {k}", category, label))
            i += 1
    data.append((i, "grass fodder silage cattle two", "Fodder", "Rare 2"))
    return spark.createDataFrame(data, "call_id int, question string, category string, query_type string").repartition(3)


@pytest.fixture(scope="module")
def model(calls):
    return HierarchicalClassifier(max_iter=10).fit(calls)


def test_L3_plan(calls, rows):
    plan = {r[0]: r[1:] for r in rows(hierarchy.level2_plan(calls, "category", "query_type"))}
    assert plan["Fruits"] == (2, 24, "train", None)
    assert plan["Spices"] == (1, 12, "fallback", "Weather")
    assert plan["Fodder"] == (0, 0, "none", None)


def test_L1_L4_L5_levels_fallback_and_unknown(spark, calls, model):
    plan = {r["category"]: (r["decision"], r["fallback_label"]) for r in model.plan.collect()}
    assert plan == {"Fruits": ("train", None), "Cereals": ("train", None), "Spices": ("fallback", "Weather"), "Fodder": ("none", None)}
    assert model.labels("Cereals") == ["Price", "Rust", "Seed"] and model.labels("Spices") == []
    found = model.predict(calls).collect()
    assert sum(r["pred_category"] == r["category"] for r in found) / len(found) > 0.95
    for r in found:
        assert 0 < r["category_confidence"] <= 1
        if r["pred_category"] == "Spices":
            assert r["pred_query_type"] == "Weather" and r["query_type_confidence"] is None
        elif r["pred_category"] == "Fodder":
            assert r["pred_query_type"] == "UNKNOWN"
        else:
            assert r["pred_query_type"] == r["query_type"] and 0 < r["query_type_confidence"] <= 1


def test_L4_one_pass_without_a_shuffle(calls, model):
    plan = model.predict(calls.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Exchange") <= 1  # the one of the fixture's repartition


def test_S6_save_and_load(spark, calls, model, tmp_path, rows):
    model.save(spark, str(tmp_path))
    loaded = HierarchicalClassifier.load(spark, str(tmp_path))
    assert (loaded.C, loaded.min_class_count, rows(loaded.plan)) == (model.C, model.min_class_count, rows(model.plan))
    assert rows(loaded.predict(calls)) == rows(model.predict(calls))


def test_L6_L7_train_job(spark, calls, tmp_path):
    fitted, scores = jobs.train_job(calls, str(tmp_path / "m"), str(tmp_path / "s"), max_iter=10)
    found = {r["level"]: r for r in scores.collect()}
    assert found["category"]["n"] == 15 and found["category"]["accuracy"] > 0.8
    assert "Rare/Other" in fitted.labels() and "Fodder" not in fitted.labels()
    assert spark.read.json(str(tmp_path / "s")).count() == 2


def test_L7_gold_calls_can_be_kept_out(spark, calls, tmp_path):
    gold = calls.where(F.col("category") == "Spices").select("call_id")
    fitted, _ = jobs.train_job(calls, str(tmp_path / "m"), str(tmp_path / "s"), exclude_ids=gold, max_iter=5)
    assert "Spices" not in fitted.labels()


def test_L8_comparison_job(spark, calls, model, tmp_path):
    gold = calls.where("call_id % 5 = 0").withColumn("resolution_signal", F.lit("resolved"))
    extracted = gold.select("call_id", F.lit("Pest").alias("category"), F.lit("resolved").alias("resolution_signal"))
    out = jobs.comparison_job(gold, extracted, model, str(tmp_path / "c")).first()
    assert out["winner"] == "Baseline classifier" and out["signal_accuracy"] == 1
    crosswalk = spark.createDataFrame([("Pest", "no such label")], "category string, query_type string")
    again = jobs.comparison_job(gold, extracted, model, str(tmp_path / "d"), crosswalk=crosswalk).first()
    assert again["extraction_accuracy"] == 0 < out["extraction_accuracy"]
    with pytest.raises(ValueError, match="call_id"):
        jobs.comparison_job(gold, extracted.withColumn("call_id", F.col("call_id") + 10_000), model, str(tmp_path / "e"))


def test_L9_tuning_uses_the_training_rows(calls):
    best, results = hierarchy.tune_C(calls.where("category <> 'Fodder'"), "call_id", grid=(0.5, 2.0), max_iter=5)
    assert best in (0.5, 2.0) and len(results) == 2 and all(0 <= f <= 1 for _, f in results)


def test_L9_the_grid_equals_a_plain_search(calls):
    """All C together give the scores of one fit for each C, and the best one wins."""
    from casewise.operators.sampling import stratified_split

    rows = calls.where("category <> 'Fodder'")
    grid = (0.01, 0.5, 2.0)
    best, results = hierarchy.tune_C(rows, "call_id", grid=grid)
    fit_part, check_part = stratified_split(rows, "category", "call_id")
    plain = []
    for C in grid:
        model = HierarchicalClassifier(C=C).fit(fit_part)
        plain.append((C, hierarchy.evaluate_against_gold(model, check_part).where("level = 'query_type'").first()["macro_f1"]))
    assert results == plain and best == max(plain, key=lambda r: (r[1], -r[0]))[0]
