"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.operators import cases, variants
from casewise.session import durable
from casewise.plans import reports
from checks.common import CASES, EVENTS_LOG, ORDERS_LOG, VARIANT_COUNTS, VARIANTS, events_log, orders_log, query, rounded, table
from checks.process import ACTIVITY_TOTALS
from checks.common import STEPS

SEGMENTS = ("BUILDING", "MACHINERY")
SEGMENTS_SQL = "('BUILDING', 'MACHINERY')"


def _scored(spark, sf):
    """Orders with a flag in the place of the mismatch flag."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.select(F.col("c_mktsegment").alias("crop"), (F.col("o_totalprice") >= 200000).alias("is_mismatch"))


SCORED = "scored AS (SELECT c_mktsegment AS crop, o_totalprice >= 200000 AS is_mismatch FROM orders JOIN customer ON o_custkey = c_custkey)"


def kpi_sql(cases_table: str, scored_table: str) -> str:
    return f"""SELECT count(DISTINCT case_id) AS n_cases, round(coalesce(avg(loop_rate), 0), 6) AS mean_loop_rate,
      round(coalesce(avg(duration_days), 0), 6) AS mean_duration_days,
      round((SELECT avg(CAST(is_mismatch AS INT)) * 100 FROM {scored_table}), 6) AS pct_mismatch FROM {cases_table}"""


KPI_COLUMNS = ("mean_loop_rate", "mean_duration_days", "pct_mismatch")


@query("kpis", f"WITH {ORDERS_LOG}, {CASES}, {SCORED} {kpi_sql('cases', 'scored')}")
def kpis(spark, sf):
    return rounded(reports.kpis(cases.case_metrics(orders_log(spark, sf)), _scored(spark, sf)), *KPI_COLUMNS)


CHOSEN = f"""own AS (SELECT * FROM cases WHERE crop IN {SEGMENTS_SQL}),
marks AS (SELECT * FROM scored WHERE crop IN {SEGMENTS_SQL})"""


def _dashboard(spark, sf):
    return reports.dashboard(cases.case_metrics(orders_log(spark, sf)), _scored(spark, sf), SEGMENTS)


@query("filtered_kpis", f"WITH {ORDERS_LOG}, {CASES}, {SCORED}, {CHOSEN} {kpi_sql('own', 'marks')}")
def filtered_kpis(spark, sf):
    return rounded(_dashboard(spark, sf)["kpis"], *KPI_COLUMNS)


@query(
    "filtered_case_list",
    f"""WITH {ORDERS_LOG}, {CASES} SELECT case_id, n_events, round_even(loop_rate, 2) AS loop_rate, duration_days, crop, state
        FROM cases WHERE crop IN {SEGMENTS_SQL}""",
)
def filtered_case_list(spark, sf):
    return _dashboard(spark, sf)["case_list"]


@query(
    "filtered_loop_and_mismatch",
    f"""WITH {ORDERS_LOG}, {CASES}, {SCORED}, {CHOSEN}
        SELECT crop, round(l, 6) AS loop_rate, n_cases, round(m, 6) AS mismatch_rate, n_calls
        FROM (SELECT crop, avg(loop_rate) AS l, count(*) AS n_cases FROM own GROUP BY 1)
        JOIN (SELECT crop, avg(CAST(is_mismatch AS INT)) AS m, count(*) AS n_calls FROM marks GROUP BY 1) USING (crop)
        WHERE n_calls >= 5""",
)
def filtered_loop_and_mismatch(spark, sf):
    return rounded(_dashboard(spark, sf)["loop_and_mismatch"], "loop_rate", "mismatch_rate")


SEGMENT_STATS = "stats AS (SELECT crop, avg(loop_rate) AS loop_rate, count(DISTINCT case_id) AS n_cases FROM cases GROUP BY 1)"


@query(
    "segment_stats",
    f"WITH {EVENTS_LOG}, {CASES}, {SEGMENT_STATS} SELECT crop, round(loop_rate, 6) AS loop_rate, n_cases FROM stats",
)
def segment_stats(spark, sf):
    return rounded(reports.segment_stats(cases.case_metrics(events_log(spark, sf))), "loop_rate")


@query(
    "supported_segments",
    f"""WITH {EVENTS_LOG}, {CASES}, {SEGMENT_STATS} SELECT crop, round(loop_rate, 6) AS loop_rate, n_cases FROM stats
        WHERE n_cases >= least(25, (SELECT max(n_cases) FROM stats))""",
)
def supported_segments(spark, sf):
    found = reports.supported_segments(cases.case_metrics(events_log(spark, sf)), min_cases=25)
    return rounded(found, "loop_rate")


@query(
    "top_segments",
    f"""WITH {EVENTS_LOG}, {CASES}, {SEGMENT_STATS} SELECT crop, round(stats.loop_rate, 6) AS loop_rate, n_cases FROM stats
        WHERE n_cases >= least(5, (SELECT max(n_cases) FROM stats)) ORDER BY stats.loop_rate DESC, crop LIMIT 15""",
)
def top_segments(spark, sf):
    return rounded(reports.top_segments(cases.case_metrics(events_log(spark, sf))), "loop_rate")


@query(
    "headline",
    f"""WITH {EVENTS_LOG}, {CASES},
        summary AS (SELECT crop, avg(loop_rate) AS l, count(*) AS n FROM cases GROUP BY 1),
        top AS (SELECT crop, l FROM summary WHERE n >= 5 ORDER BY l DESC, crop LIMIT 3)
        SELECT count(*) AS n_cases, round(avg(loop_rate), 6) AS mean_loop_rate, round(avg(duration_days), 6) AS mean_duration_days,
          CAST(NULL AS DOUBLE) AS pct_mismatch, (SELECT string_agg(crop || ' (' || CAST(CAST(round_even(l * 100, 0) AS INT) AS VARCHAR)
            || '%)', ', ' ORDER BY l DESC, crop) FROM top) AS top_segments FROM cases""",
)
def headline(spark, sf):
    metrics = cases.case_metrics(events_log(spark, sf))
    return rounded(reports.headline(metrics, cases.summarize_by_segment(metrics)), "mean_loop_rate", "mean_duration_days")


@query(
    "variant_explorer",
    f"""WITH {EVENTS_LOG}, {VARIANTS}, {VARIANT_COUNTS},
        top AS (SELECT *, row_number() OVER (ORDER BY n_cases DESC, variant) AS rank FROM variant_counts QUALIFY rank <= 30)
        SELECT rank, n_cases, round_even(pct_of_cases, 1) AS pct_of_cases, n_steps, example_crops,
          CASE WHEN length(variant) > 200 THEN rtrim(left(variant, 200)) || '…' ELSE variant END AS sequence,
          '#' || rank || ' (' || n_steps || CASE WHEN n_steps = 1 THEN ' step)' ELSE ' steps)' END AS short_label FROM top""",
)
def variant_explorer(spark, sf):
    return reports.variant_explorer(durable(variants.variant_analysis(events_log(spark, sf))))


@query(
    "case_picker",
    f"""WITH {ORDERS_LOG}, {CASES} SELECT case_id, n_events, case_id || '  —  ' || n_events || ' events, loop rate '
        || CAST(CAST(round_even(loop_rate * 100, 0) AS INT) AS VARCHAR) || '%' AS label FROM cases WHERE crop IN {SEGMENTS_SQL}""",
)
def case_picker(spark, sf):
    return reports.case_picker(cases.case_metrics(orders_log(spark, sf)), SEGMENTS)


BUSIEST = "busiest AS (SELECT case_id FROM log GROUP BY 1 ORDER BY count(*) DESC, case_id LIMIT 1)"


def _explored(spark, sf):
    log = orders_log(spark, sf).withColumns({"question": F.col("season"), "answer": F.col("activity")})
    metrics = cases.case_metrics(log)
    default = reports.case_picker(metrics, n=1).first()["case_id"]
    return reports.case_explorer(log, metrics, default)


@query(
    "case_explorer",
    f"""WITH {ORDERS_LOG}, {BUSIEST} SELECT row_number() OVER (ORDER BY ts, ord) AS step, strftime(ts, '%Y-%m-%d') AS date,
        activity AS issue_type, season AS question, activity AS answer FROM log WHERE case_id IN (SELECT case_id FROM busiest)""",
)
def case_explorer(spark, sf):
    return _explored(spark, sf)[1]


@query(
    "case_statistics",
    f"""WITH {ORDERS_LOG}, {CASES}, {BUSIEST} SELECT case_id, n_events AS n_calls,
        CAST(CAST(round_even(loop_rate * 100, 0) AS INT) AS VARCHAR) || '%' AS loop_rate, duration_days || ' days' AS duration, crop
        FROM cases WHERE case_id IN (SELECT case_id FROM busiest)""",
)
def case_statistics(spark, sf):
    return _explored(spark, sf)[0]


MAP = f"""WITH {ORDERS_LOG.replace("log AS", "whole AS")},
log AS (SELECT * FROM whole WHERE crop IN {SEGMENTS_SQL}), {STEPS}"""


@query(
    "process_map_nodes",
    f"{MAP} {ACTIVITY_TOTALS}",
)
def process_map_nodes(spark, sf):
    return reports.process_map(orders_log(spark, sf), SEGMENTS, 6, 100)["nodes"]


@query(
    "process_map_size",
    f"""{MAP} SELECT count(*) AS n_events, count(DISTINCT case_id) AS n_cases,
        'from ' || count(*) || ' events across ' || count(DISTINCT case_id) || ' cases' AS note FROM log""",
)
def process_map_size(spark, sf):
    return reports.process_map(orders_log(spark, sf), SEGMENTS)["size"]
