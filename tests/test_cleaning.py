import pytest
from pyspark.sql import functions as F

from casewise.operators import cleaning

SCHEMA = (
    "call_id int, state string, district string, crop string, category string, query_type string, season string, "
    "question string, answer string, created_on string"
)


def call(i, question="how to water", answer="twice a week", crop="Rice", label="Weather", date="2024-05-01", district="D"):
    return (i, "K", district, crop, "Cereals", label, None, question, answer, date)


@pytest.fixture(scope="module")
def calls(spark):
    data = [
        call(1, question="  padded question \t"),
        call(2, answer="Irrelevant call"),
        call(3, answer=" NAN "),
        call(4, question="abc"),
        call(5, question="abcd"),
        call(6, date="yesterday"),
        call(8, question="same", answer="copy", crop="Second"),
        call(7, question="same", answer="copy", crop="First"),
        call(9, question="deny one", label="Government Schemes"),
        call(10, question="deny two", label="Crop Insurance"),
        call(11, question="null label", label=None),
        call(12, question="malayalam", answer="നെല്ല് നന്നായി"),
        call(13, question="devanagari", answer="धान की फसल"),
        call(14, question="null crop", crop=None),
        call(15, question=None),
        call(16, question="null answer", answer=None),
    ]
    return spark.createDataFrame(data, SCHEMA)


def ids(df):
    return sorted(r["call_id"] for r in df.collect())


def test_P1_P4_U4_basic_clean(calls):
    clean = cleaning.basic_clean(calls)
    assert ids(clean) == [1, 5, 7, 9, 10, 11, 12, 13, 14]
    assert clean.where("call_id = 1").first()["question"] == "padded question"
    assert clean.schema["created_on"].dataType.simpleString() == "timestamp_ntz"


def test_U4_first_by_id_however_partitioned(calls):
    assert cleaning.basic_clean(calls.repartition(5)).where("question = 'same'").first()["crop"] == "First"


def test_U4_plan_limits_groups_before_the_shuffle(calls):
    plan = cleaning.drop_duplicates(calls)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_P4_other_date_formats(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00",), ("01/02/2024",), ("x",), (None,)], "created_on string")
    plain = [r[0] is not None for r in cleaning.parse_date(df).collect()]
    assert plain == [True, False, False, False]
    found = [str(r[0]) for r in cleaning.parse_date(df, formats=["dd/MM/yyyy"]).collect()]
    assert found == ["2024-03-01 10:00:00", "2024-02-01 00:00:00", "None", "None"]


def test_P5_P6_filters_keep_nulls(calls):
    clean = cleaning.basic_clean(calls)
    assert ids(cleaning.filter_to_advisory(clean)) == [1, 5, 7, 11, 12, 13, 14]
    assert ids(cleaning.filter_scripts(clean)) == [1, 5, 7, 9, 10, 11, 14]


def test_P7_scope_dates_are_inclusive(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (2, "2024-01-31", "b"), (3, "2024-02-01", None)], "call_id int, d string, state string")
    df = df.withColumn("created_on", F.col("d").cast("timestamp_ntz"))
    assert ids(cleaning.scope(df, start_date="2024-01-01", end_date="2024-01-31")) == [1, 2]
    assert ids(cleaning.scope(df, states=["a", "b"])) == [1, 2]
    assert ids(cleaning.scope(df, states=[], crops=None)) == [1, 2, 3]


def test_P12_rare_classes(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)], "category string")
    merged = {r[0]: r[1] for r in cleaning.merge_rare(df).groupBy("category").count().collect()}
    assert merged == {"a": 5, "Rare/Other": 4, None: 1}


def test_A15_audit_equals_the_steps(calls):
    audit = {r["rule"]: (r["n_in"], r["n_out"]) for r in cleaning.cleaning_audit(calls, crops=["Rice"]).collect()}
    assert audit["question length"] == (16, 14)
    assert audit["answer length"] == (14, 12)
    assert audit["junk answer"] == (12, 11)
    assert audit["date"] == (11, 10)
    assert audit["duplicate"] == (10, 9)
    assert audit["advisory label"] == (9, 7)
    assert audit["script"] == (7, 5)
    assert audit["scope"] == (5, 3)


def test_A15_own_rules(calls):
    def out(**rules):
        return {r["rule"]: r["n_out"] for r in cleaning.cleaning_audit(calls, **rules).collect()}

    assert out(deny=[], scripts=[])["script"] == out()["duplicate"]
