"""Reader and writer queries: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casewise.operators import cases, metrics
from casewise.session import shared_folder
from casewise.sources import tables
from checks.cleaning import GUESSES, _class_sql, _guesses
from checks.common import CASES, DOCUMENT_CALLS, EVENTS_LOG, document_calls, events_log, query, rounded


def _path(spark) -> str:
    return f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"


@query(
    "load_calls_csv",
    f"""WITH {DOCUMENT_CALLS} SELECT call_id, state, district, crop, category, query_type, md5(question) AS question,
        md5(answer) AS answer, created_on FROM raw""",
)
def load_calls_csv(spark, sf):
    """Whole texts with quotes and line breaks, through CSV with the headers of an export."""
    names = {ours: theirs for theirs, ours in tables.HEADERS.items()} | {"answer": "Reply", "call_id": "Id"}
    calls = document_calls(spark, sf)
    path = _path(spark)
    exported = calls.withColumnsRenamed({c: f" {names[c]} " for c in calls.columns})
    exported.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    loaded = tables.load_calls(spark, path, {"Reply": "answer", "Id": "call_id"})
    return loaded.select(
        F.col("call_id").cast("long").alias("call_id"), "state", "district", "crop", "category", "query_type",
        F.md5("question").alias("question"), F.md5("answer").alias("answer"), "created_on",
    )


@query(
    "result_tables",
    f"WITH {EVENTS_LOG}, {CASES} SELECT case_id, duration_days, n_events, crop, state FROM cases",
)
def result_tables(spark, sf):
    path = _path(spark)
    tables.write_table(cases.case_durations(events_log(spark, sf)), path)
    return tables.read_table(spark, path)


@query(
    "result_tables_csv",
    f"WITH {EVENTS_LOG}, {CASES} SELECT case_id, duration_days, n_events, crop, state FROM cases",
)
def result_tables_csv(spark, sf):
    path = _path(spark)
    tables.write_table(cases.case_durations(events_log(spark, sf)), path, "csv")
    return tables.read_table(
        spark, path, "csv", "case_id string, duration_days int, n_events bigint, crop string, state string"
    )


@query(
    "metrics_json",
    f"""WITH {GUESSES} SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(n_correct) / sum(support), 6) AS accuracy,
        round(avg(f1), 6) AS macro_f1 FROM {_class_sql("truth", "guess")}""",
)
def metrics_json(spark, sf):
    path = _path(spark)
    tables.write_metrics(metrics.scores(_guesses(spark, sf), "truth", "guess"), path)
    return rounded(tables.read_table(spark, path, "json").select("n", "accuracy", "macro_f1"), "accuracy", "macro_f1")


@query(
    "optional_source",
    "SELECT false AS absent_found, true AS present_found, count(*) AS n FROM documents",
)
def optional_source(spark, sf):
    absent = tables.read_optional(spark, f"{sf}/no_such_table.parquet")
    present = tables.read_optional(spark, f"{sf}/documents.parquet")
    return present.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(absent is not None).alias("absent_found"), F.lit(present is not None).alias("present_found"), "n"
    )
