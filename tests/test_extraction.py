import json

import pytest
from pyspark.sql import functions as F

from casewise.operators import extraction

GOOD = {"category": "Weather", "crop": "Millet", "issue": "hail before harvest", "resolution_signal": "unresolved"}
RAW = {
    1: json.dumps(GOOD),
    2: '>> result >> {"category": "Plant Protection", "crop": "Okra", "issue": "leaf curl", "resolution_signal": "resolved"} << end',
    3: "no object at all " * 30,
    4: '{"category": "Moon Phase", "crop": "Sesame", "issue": "when to sow", "resolution_signal": "unclear"}',
    5: '{"category": "Weather"} or {"category": "Other"}',
    6: "{'category': 'Weather'}",
    7: '{"category": "Weather", "crop": "Rice", "resolution_signal": "done"}',
    8: '{"category": "Weather", ',
    9: None,
    10: '{"category": null, "crop": null, "extra": [1, {"a": 2}]}',
    11: '{"category": "Weather"},{"category": "Other"}',
    12: '{"category": "Other", "category": "Weather"}',
}


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(RAW.items()), "call_id int, raw string")
    return {r["call_id"]: r for r in extraction.parse_responses(df, "call_id").collect()}


def test_J2_valid_object(parsed):
    assert {k: parsed[1][k] for k in GOOD} == GOOD and parsed[1]["parse_error"] is False and parsed[1]["raw_head"] is None


def test_J2_text_around_the_object(parsed):
    assert parsed[2]["crop"] == "Okra"


@pytest.mark.parametrize("i", [3, 5, 6, 8, 9, 11])
def test_J2_not_one_strict_object(parsed, i):
    r = parsed[i]
    assert r["parse_error"] and (r["category"], r["crop"], r["issue"], r["resolution_signal"]) == (
        "Other", "Unknown", "parse_error", "unclear",
    )
    assert r["raw_head"] == (RAW[i][:200] if RAW[i] else None)


def test_J2_vocabulary_and_defaults(parsed):
    assert parsed[4]["category"] == "Other" and not parsed[4]["parse_error"]
    assert parsed[7]["issue"] == "unspecified" and parsed[7]["resolution_signal"] == "unclear"
    assert parsed[10]["category"] == "Other" and parsed[10]["crop"] == "Unknown" and not parsed[10]["parse_error"]
    assert parsed[12]["category"] == "Weather"


@pytest.fixture(scope="module")
def calls(spark):
    return spark.createDataFrame([(i, f"question {i}", f"answer {i}") for i in range(6)], "call_id int, question string, answer string")


def test_J1_prompt(spark, calls):
    text = calls.where("call_id = 3").select(extraction.prompt(F.col("question"), F.col("answer"))).first()[0]
    assert "Question: question 3\nAnswer: answer 3\n" in text and '"Plant Protection", "Nutrient Management"' in text
    assert "{" not in text


def test_J3_failing_batch_marks_its_rows(calls):
    def responder(texts):
        if any("question 4" in t for t in texts):
            raise ConnectionError("no model")
        return [json.dumps(GOOD)] * len(texts)

    asked = calls.coalesce(1).select("call_id", extraction.prompt(F.col("question"), F.col("answer")).alias("prompt"))
    schema_before = asked.schema.names
    answered = extraction.respond(asked, responder, batch=2)
    assert asked.schema.names == schema_before
    found = {r["call_id"]: r for r in extraction.parse_responses(answered, "call_id", "raw", "error").collect()}
    failed = {i for i, r in found.items() if r["issue"] == "api_error"}
    assert 4 in failed and len(failed) == 2
    assert found[4]["raw_head"] == "no model" and found[4]["parse_error"]
    assert found[0]["crop"] == GOOD["crop"]


def test_J3_T9_first_rows_by_id(calls):
    out = extraction.run_extraction(calls.repartition(4), lambda texts: [json.dumps(GOOD)] * len(texts), n=2)
    assert sorted(r["call_id"] for r in out.collect()) == [0, 1]


def test_J4_consistency(calls):
    def responder(texts):
        return [json.dumps({**GOOD, "category": ["Weather", "Other", "Weather"][i % 3]}) for i in range(len(texts))]

    report = extraction.consistency_check(calls.coalesce(1), responder, n_records=4, n_repeats=3)
    found = {r["field"]: r for r in report.collect()}
    assert found["resolution_signal"]["mean_agreement"] == 1
    assert found["category"]["n_records"] == 4 and found["category"]["mean_agreement"] < 1


def counting(path, down=()):
    """A responder that notes each prompt it sees and fails for some."""
    def responder(texts):
        with open(path, "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        if any(d in t for t in texts for d in down):
            raise RuntimeError("down")
        return [f"reply to {t}" for t in texts]

    return responder


def test_J3_each_distinct_prompt_is_asked_once_and_only_what_failed_again(spark, tmp_path, rows):
    prompts = [f"p{i % 7}" for i in range(60)] + [None]
    frame = spark.createDataFrame(list(enumerate(prompts)), "id int, prompt string").repartition(5)
    clean, folder = str(tmp_path / "clean"), str(tmp_path / "answers")
    wanted = rows(extraction.ask(frame, counting(tmp_path / "a"), clean))
    assert sorted((tmp_path / "a").read_text().split()) == [f"p{i}" for i in range(7)]
    assert [r for r in wanted if r[1] is None] == [(60, None, None, None)]
    assert all(r[2] == f"reply to {r[1]}" and r[3] is None for r in wanted if r[1])
    first = rows(extraction.ask(frame, counting(tmp_path / "b", ["p3", "p5"]), folder, batch=1))
    assert {(r[1], r[3]) for r in first if r[3]} == {("p3", "down"), ("p5", "down")}
    assert rows(extraction.ask(frame, counting(tmp_path / "c"), folder)) == wanted
    assert sorted((tmp_path / "c").read_text().split()) == ["p3", "p5"]
    assert rows(extraction.ask(frame, counting(tmp_path / "d"), folder)) == wanted and not (tmp_path / "d").exists()
    more = frame.union(spark.createDataFrame([(99, "new")], frame.schema))
    assert len(rows(extraction.ask(more, counting(tmp_path / "e"), folder))) == 62 and (tmp_path / "e").read_text() == "new\n"
    attempts = {(r["error"], r["attempt"]) for r in spark.read.parquet(folder).collect()}
    assert attempts == {(None, 1), ("down", 1), (None, 2)}


def test_J4_repeats_are_requests_of_their_own(spark, tmp_path):
    calls = spark.createDataFrame([(1, "q", "a"), (2, "q", "a"), (3, "other", "a")], "call_id int, question string, answer string")
    extraction.consistency_check(calls, lambda texts: counting(tmp_path / "n")([t.split()[-1] for t in texts]), None, 3).collect()
    assert len((tmp_path / "n").read_text().split()) == 2 * 3


def test_J3_no_prompts(spark, tmp_path):
    empty = spark.createDataFrame([], "id int, prompt string")
    assert extraction.ask(empty, counting(tmp_path / "z"), str(tmp_path / "none")).collect() == []
