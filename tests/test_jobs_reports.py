import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from casewise.operators import cases, variants
from casewise.operators.event_log import build_event_log
from casewise.operators.hierarchy import HierarchicalClassifier
from casewise.operators.retrieval import TfidfRetriever
from casewise.plans import jobs, reports
from casewise.sources import tables

HEADER = "StateName, DistrictName ,Crop,Category,QueryType,QueryText,Reply,CreatedOn,Id,Season"


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "calls.csv"
    lines = [HEADER]
    for i in range(60):
        crop = ["Banana", "Rice", "Others", "Pepper"][i % 4]
        label = ["Weather", "Plant Protection", "Plant Protections", "Nutrient, micro", "Government Schemes"][i % 5]
        lines.append(f'K,D{i % 3},{crop},Fruits,"{label}","how about ""no {i}""\nfor {crop}",answer {i},2024-03-{i % 28 + 1:02d} 10:00:00,{i},NA')
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def calls(spark, csv):
    return tables.load_calls(spark, csv, {"Reply": "answer", "Id": "call_id"})


def test_S1_headers_quotes_and_missing_values(calls):
    row = calls.where("call_id = '0'").first()
    assert row["question"] == 'how about "no 0"\nfor Banana' and row["district"] == "D0" and row["season"] is None
    assert calls.count() == 60


def test_S1_missing_column(spark, csv):
    with pytest.raises(ValueError, match="answer"):
        tables.load_calls(spark, csv)


def test_S3_S4_S5(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc')], "x int, y string")
    for fmt in ("parquet", "csv"):
        tables.write_table(df, str(tmp_path / fmt), fmt)
        assert tables.read_table(spark, str(tmp_path / fmt), fmt, "x int, y string").first()["y"] == 'a "b"\nc'
    tables.write_metrics(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["x"] == 1
    assert tables.read_optional(spark, str(tmp_path / "absent")) is None
    assert tables.read_optional(spark, str(tmp_path / "parquet")).count() == 1


def test_row_order(spark):
    df = tables.with_row_order(spark.range(10))
    assert df.select("row_order").distinct().count() == 10


@pytest.fixture(scope="module")
def clean(calls):
    return jobs.clean_calls(calls).withColumn("call_id", F.col("call_id").cast("int")).persist()


def test_cleaning_job(clean):
    assert clean.count() == 48
    found = {r[0] for r in clean.select("query_type_raw", "query_type").where("query_type_raw <> query_type").distinct().collect()}
    assert found == {"Plant Protections"}


def test_G5_event_log_job(spark, clean, tmp_path):
    jobs.event_log_job(clean, str(tmp_path), "query_type")
    assert set(os.listdir(tmp_path)) == {
        "loop_rate_per_case", "case_durations", "variants", "summary_by_crop", "dfg_edges", "dfg_nodes", "footprint", "top_variants",
        "variant_parts",
    }
    top = spark.read.parquet(str(tmp_path / "top_variants"))
    shares = spark.read.parquet(str(tmp_path / "variants")).groupBy("variant_key").count()
    assert top.count() == min(5, shares.count()) and top.join(shares, "variant_key").where("n <> count").count() == 0
    durations = spark.read.parquet(str(tmp_path / "case_durations"))
    summary = spark.read.parquet(str(tmp_path / "summary_by_crop"))
    assert durations.where("crop = 'Others'").count() == 0
    again = durations.groupBy("crop").agg(F.avg("duration_days").alias("d"), F.count("*").alias("n"))
    joined = summary.join(again, "crop")
    assert joined.where("d <> mean_duration_days or n <> n_cases").count() == 0 and joined.count() == 3
    ids = durations.where("not endswith(case_id, concat('_', crop))").count()
    assert ids == 0


@pytest.fixture(scope="module")
def log(clean):
    return build_event_log(clean, activity_col="query_type").persist()


@pytest.fixture(scope="module")
def metrics(log):
    return cases.case_metrics(log).persist()


def test_R2_selection(metrics):
    everything, own = reports.dashboard(metrics), reports.dashboard(metrics, None, ["Rice"])
    assert everything["kpis"].first()["n_cases"] == metrics.count()
    assert own["kpis"].first()["n_cases"] == metrics.where("crop = 'Rice'").count()
    assert own["kpis"].first()["pct_mismatch"] is None and own["correlation"] is None
    none = reports.dashboard(metrics, None, ["Nothing"])["kpis"].first()
    assert (none["n_cases"], none["mean_loop_rate"], none["mean_duration_days"]) == (0, 0.0, 0.0)


def test_P11_T5_small_selections_are_still_shown(metrics):
    found = [r["loop_rate"] for r in reports.top_segments(metrics).collect()]
    assert len(found) == 4 and found == sorted(found)


def test_R3_R4_R5(log, metrics):
    explorer = reports.variant_explorer(variants.variant_analysis(log), n=3).orderBy("rank").collect()
    assert [r["rank"] for r in explorer] == [1, 2, 3] and explorer[0]["short_label"].startswith("#1 (")
    first = reports.case_picker(metrics).first()
    assert f"{first['case_id']}  —  {first['n_events']} events, loop rate " in first["label"]
    stats, events = reports.case_explorer(log, metrics, first["case_id"])
    assert stats.first()["n_calls"] == first["n_events"] == events.count()
    assert [r["step"] for r in events.orderBy("step").collect()] == list(range(1, first["n_events"] + 1))
    absent, _ = reports.case_explorer(log, metrics.where("false"), first["case_id"])
    assert absent.first()["loop_rate"] == "—" and absent.first()["duration"] == "—"


def test_R6_too_few_events(log):
    full = reports.process_map(log)
    assert full["edges"].count() > 0 and full["size"].first()["n_events"] == log.count()
    one = reports.process_map(log.limit(1))
    assert one["edges"].count() == 0 and one["nodes"].count() == 0 and one["size"].first()["note"].startswith("too few")


def test_R1_headline(metrics):
    row = reports.headline(metrics, cases.summarize_by_segment(metrics)).first()
    assert row["n_cases"] == metrics.count() and row["top_segments"] == ""  # no crop has five cases


def test_R7_answers(spark, clean):
    model = HierarchicalClassifier(max_iter=5).fit(clean.withColumn("category", F.concat(F.lit("cat "), "crop")))
    retriever = TfidfRetriever().fit(clean)
    queries = spark.createDataFrame([(1, "no 3 for Pepper"), (2, "  "), (3, "zzzz")], "query_id int, text string")
    predictions, shown = reports.answer_queries(model, retriever, queries)
    assert {r["query_id"]: r["pred_category"] for r in predictions.collect()}[1] == "cat Pepper"
    found = {}
    for r in shown.collect():
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == {1, 3} and found[3][0]["note"] is not None
    assert 0 < len(found[1]) <= 5 and found[1][0]["match"].endswith("%") and found[1][0]["note"] is None
