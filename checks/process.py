"""Process-mining queries: cases, graph, variants, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.operators import cases, dfg, event_log, variants, windows
from casewise.session import durable
from casewise.plans import jobs
from checks.common import (
    CASES,
    EVENTS_LOG,
    ORDERS_LOG,
    STEPS,
    VARIANT_COUNTS,
    VARIANTS,
    events_log,
    orders_log,
    query,
    rounded,
    table,
)


@query("event_log", f"WITH {ORDERS_LOG} SELECT case_id, activity, ts, ord, state, crop, season FROM log")
def event_log_rows(spark, sf):
    return orders_log(spark, sf)


@query(
    "event_log_rejects",
    "SELECT count(*) FILTER (WHERE p_name IS NOT NULL AND p_brand <> 'Brand#1') AS n_kept, "
    "count(*) FILTER (WHERE p_name IS NULL OR p_brand = 'Brand#1') AS n_rejected FROM part",
)
def event_log_rejects(spark, sf):
    parts = table(spark, sf, "part").select("p_name", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"))
    return event_log.event_log_rejects(parts, ["p_name", "p_brand"])


@query(
    "drop_segment",
    "SELECT c_mktsegment AS crop, count(*) AS n FROM customer WHERE c_mktsegment IS DISTINCT FROM 'BUILDING' GROUP BY 1",
)
def drop_segment(spark, sf):
    named = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("crop"))
    return cases.value_counts(event_log.drop_segment(named, "crop", "BUILDING"), "crop")


@query(
    "case_loop_rate",
    f"WITH {EVENTS_LOG}, {CASES} SELECT case_id, n_events, n_repeats, round(loop_rate, 6) AS loop_rate, crop, state FROM cases",
)
def case_loop_rate(spark, sf):
    return rounded(cases.loop_rate_per_case(events_log(spark, sf)), "loop_rate")


@query(
    "case_durations",
    f"WITH {ORDERS_LOG}, {CASES} SELECT case_id, duration_days, n_events, crop, state FROM cases",
)
def case_durations(spark, sf):
    return cases.case_durations(orders_log(spark, sf))


@query(
    "case_metrics_one_pass",
    f"WITH {ORDERS_LOG}, {CASES} SELECT case_id, n_events, n_repeats, round(loop_rate, 6) AS loop_rate, "
    "duration_days, crop, state FROM cases",
)
def case_metrics(spark, sf):
    return rounded(cases.case_metrics(orders_log(spark, sf)), "loop_rate")


@query(
    "case_tables_joined",
    f"WITH {EVENTS_LOG}, {CASES} SELECT case_id, n_events, n_repeats, round(loop_rate, 6) AS loop_rate, crop, state, "
    "duration_days FROM cases",
)
def case_tables_joined(spark, sf):
    log = events_log(spark, sf)
    return rounded(cases.join_case_tables(cases.loop_rate_per_case(log), cases.case_durations(log)), "loop_rate")


SUMMARY = """SELECT crop, round(avg(loop_rate), 6) AS mean_loop_rate, round(avg(duration_days), 6) AS mean_duration_days,
  count(*) AS n_cases FROM cases GROUP BY crop"""


@query("segment_summary", f"WITH {EVENTS_LOG}, {CASES} {SUMMARY}")
def segment_summary(spark, sf):
    summary = cases.summarize_by_segment(cases.case_metrics(events_log(spark, sf)))
    return rounded(summary, "mean_loop_rate", "mean_duration_days")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf):
    return cases.value_counts(table(spark, sf, "events"), "event_type")


@query("distinct_count", "SELECT count(DISTINCT p_name) AS n_distinct FROM part")
def distinct_count(spark, sf):
    return cases.distinct_count(table(spark, sf, "part"), "p_name")


@query(
    "event_steps",
    f"""WITH {ORDERS_LOG} SELECT case_id, ord, row_number() OVER w AS step, lag(ts) OVER w AS prev_ts,
        lead(activity) OVER w AS next_activity FROM log WINDOW w AS (PARTITION BY case_id ORDER BY ts, ord)""",
)
def event_steps(spark, sf):
    return event_log.sequence_events(orders_log(spark, sf)).select("case_id", "ord", "step", "prev_ts", "next_activity")


@query(
    "event_steps_chunked",
    f"""WITH {ORDERS_LOG} SELECT case_id, ord, row_number() OVER w AS step, lag(ts) OVER w AS prev_ts,
        lead(activity) OVER w AS next_activity FROM log WINDOW w AS (PARTITION BY case_id ORDER BY ts, ord)""",
)
def event_steps_chunked(spark, sf):
    """The same rows with a bound so low that large cases are cut over several tasks."""
    ordered = event_log.sequence_events(orders_log(spark, sf), hot_events=100)
    return ordered.select("case_id", "ord", "step", "prev_ts", "next_activity")


@query(
    "seen_before",
    f"""WITH {EVENTS_LOG} SELECT case_id, ord, activity,
        row_number() OVER (PARTITION BY case_id, activity ORDER BY ts, ord) > 1 AS is_repeat FROM log""",
)
def seen_before(spark, sf):
    return event_log.seen_before(events_log(spark, sf)).select("case_id", "ord", "activity", "is_repeat")


@query(
    "top_activities",
    f"WITH {ORDERS_LOG} SELECT activity, count(*) AS n FROM log GROUP BY 1 ORDER BY n DESC, activity LIMIT 3",
)
def top_activities(spark, sf):
    return event_log.top_activities(orders_log(spark, sf), 3)


TOP_OTHER = """
top AS (SELECT activity FROM log GROUP BY 1 ORDER BY count(*) DESC, activity LIMIT 3),
bucketed AS (SELECT log.* REPLACE (CASE WHEN activity IN (SELECT activity FROM top) THEN activity ELSE 'Other' END AS activity) FROM log)"""


@query(
    "top_activities_other",
    f"WITH {ORDERS_LOG}, {TOP_OTHER} SELECT case_id, activity, count(*) AS n FROM bucketed GROUP BY ALL",
)
def top_activities_other(spark, sf):
    bucketed = event_log.bucket_activities(orders_log(spark, sf), 3)
    return bucketed.groupBy("case_id", "activity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "plain_labels",
    "SELECT replace(p_type, ',', ' -') AS activity, count(*) AS n FROM part GROUP BY 1",
)
def plain_labels(spark, sf):
    named = event_log.plain_labels(table(spark, sf, "part").select(F.col("p_type").alias("activity")))
    return cases.value_counts(named, "activity")


@query(
    "dfg_edges",
    f"""WITH {EVENTS_LOG}, {STEPS} SELECT activity AS src, next_activity AS dst, count(*) AS n FROM steps
        WHERE next_activity IS NOT NULL GROUP BY ALL""",
)
def dfg_edges(spark, sf):
    return dfg.edge_counts(dfg.transitions(events_log(spark, sf)))


ACTIVITY_TOTALS = """SELECT activity, count(*) AS n_total, count(*) FILTER (WHERE is_start) AS n_start,
  count(*) FILTER (WHERE next_activity IS NULL) AS n_end, count(*) FILTER (WHERE next_activity = activity) AS n_self
  FROM steps GROUP BY 1"""


@query("start_end_activities", f"WITH {ORDERS_LOG}, {STEPS} {ACTIVITY_TOTALS}")
def start_end_activities(spark, sf):
    return dfg.activity_totals(dfg.transitions(orders_log(spark, sf)))


TRIMMED = f"""WITH {EVENTS_LOG.replace("log AS", "whole AS")},
top AS (SELECT activity FROM whole GROUP BY 1 ORDER BY count(*) DESC, activity LIMIT 3),
log AS (
  SELECT whole.* REPLACE (replace(CASE WHEN activity IN (SELECT activity FROM top) THEN activity ELSE 'Other' END,
         ',', ' -') AS activity) FROM whole), {STEPS},
edges AS (
  SELECT activity AS src, next_activity AS dst, count(*) AS n FROM steps WHERE next_activity IS NOT NULL GROUP BY ALL),
kept AS (
  (SELECT * FROM edges WHERE src <> dst ORDER BY n DESC, src, dst LIMIT 4)
  UNION ALL SELECT * FROM edges WHERE src = dst)"""


@query("dfg_trimmed", f"{TRIMMED} SELECT src, dst, n FROM kept")
def dfg_trimmed(spark, sf):
    return dfg.discover_dfg(events_log(spark, sf), 3, 4)[0]


@query(
    "dfg_nodes",
    f"{TRIMMED} SELECT * FROM ({ACTIVITY_TOTALS}) WHERE activity IN (SELECT src FROM kept UNION SELECT dst FROM kept)",
)
def dfg_nodes(spark, sf):
    return dfg.discover_dfg(events_log(spark, sf), 3, 4)[1]


DISCOVERY = f"""WITH {EVENTS_LOG.replace("log AS", "whole AS")},
top AS (SELECT activity FROM whole GROUP BY 1 ORDER BY count(*) DESC, activity LIMIT 3),
bucketed AS (
  SELECT whole.* REPLACE (CASE WHEN activity IN (SELECT activity FROM top) THEN activity ELSE 'Other' END AS activity)
  FROM whole),
paths AS (SELECT case_id, string_agg(activity, ' -> ' ORDER BY ts, ord) AS variant FROM bucketed GROUP BY 1),
top_paths AS (SELECT variant FROM paths GROUP BY 1 ORDER BY count(*) DESC, variant LIMIT 15),
log AS (
  SELECT * FROM bucketed
  WHERE case_id IN (SELECT case_id FROM paths WHERE variant IN (SELECT variant FROM top_paths)))"""


@query("discovery_log", f"{DISCOVERY} SELECT case_id, ord, activity FROM log")
def discovery_log(spark, sf):
    return jobs.discovery_log(events_log(spark, sf), 3, 15).select("case_id", "ord", "activity")


@query(
    "footprint",
    f"""{DISCOVERY}, {STEPS},
        edges AS (SELECT activity AS src, next_activity AS dst, count(*) AS n FROM steps
                  WHERE next_activity IS NOT NULL GROUP BY ALL),
        names AS (SELECT DISTINCT activity FROM log),
        pairs AS (
          SELECT a.activity AS src, b.activity AS dst, coalesce(f.n, 0) AS n_forward, coalesce(r.n, 0) AS n_backward
          FROM names a CROSS JOIN names b
          LEFT JOIN edges f ON f.src = a.activity AND f.dst = b.activity
          LEFT JOIN edges r ON r.src = b.activity AND r.dst = a.activity)
        SELECT src, dst, n_forward, n_backward,
          CASE WHEN n_forward > 0 AND n_backward > 0 THEN 'parallel' WHEN n_forward > 0 THEN 'causal'
               WHEN n_backward > 0 THEN 'reverse' ELSE 'none' END AS relation FROM pairs""",
)
def footprint(spark, sf):
    return dfg.footprint(dfg.transitions(jobs.discovery_log(events_log(spark, sf), 3, 15)))


@query(
    "variants",
    f"WITH {EVENTS_LOG}, {VARIANTS} SELECT case_id, variant, n_steps, crop, state, season FROM variants",
)
def variant_rows(spark, sf):
    log = events_log(spark, sf)
    found = variants.variant_analysis(log).join(variants.sequences(log), "case_id")
    return found.select("case_id", "variant", "n_steps", "crop", "state", "season")


@query(
    "variant_parts",
    f"""WITH {ORDERS_LOG}, numbered AS (
          SELECT case_id, activity, row_number() OVER (PARTITION BY case_id ORDER BY ts, ord) AS step FROM log)
        SELECT case_id, (step - 1) // 50 AS part, count(*) AS n_steps, string_agg(activity, ' -> ' ORDER BY step) AS text
        FROM numbered GROUP BY ALL""",
)
def variant_parts(spark, sf):
    return variants.variant_parts(orders_log(spark, sf), 50)


@query(
    "variant_counts",
    f"""WITH {EVENTS_LOG}, {VARIANTS}, {VARIANT_COUNTS} SELECT variant, n_cases, example_crops, n_steps,
        round(pct_of_cases, 6) AS pct_of_cases FROM variant_counts""",
)
def variant_counts(spark, sf):
    log = events_log(spark, sf)
    counts = variants.with_sequences(variants.variant_counts(durable(variants.variant_analysis(log))), log)
    return rounded(counts.select("variant", "n_cases", "example_crops", "n_steps", "pct_of_cases"), "pct_of_cases")


@query(
    "variant_ranks",
    f"""WITH {EVENTS_LOG}, {VARIANTS}, {VARIANT_COUNTS} SELECT variant, n_cases,
        row_number() OVER (ORDER BY n_cases DESC, variant) AS rank FROM variant_counts""",
)
def variant_ranks(spark, sf):
    log = events_log(spark, sf)
    counts = variants.variant_counts(durable(variants.variant_analysis(log)))
    return variants.with_sequences(variants.ranked_variants(counts), log).select("variant", "n_cases", "rank")


@query(
    "variant_topk_log",
    f"""WITH {EVENTS_LOG}, {VARIANTS},
        top AS (SELECT variant FROM variants GROUP BY 1 ORDER BY count(*) DESC, variant LIMIT 15)
        SELECT case_id, ord, activity FROM log
        WHERE case_id IN (SELECT case_id FROM variants WHERE variant IN (SELECT variant FROM top))""",
)
def variant_topk_log(spark, sf):
    log = events_log(spark, sf)
    return variants.filter_top_variants(log, durable(variants.variant_analysis(log)), 15).select("case_id", "ord", "activity")


@query(
    "variant_coverage",
    f"""WITH {EVENTS_LOG}, {VARIANTS}, counts AS (SELECT variant, count(*) AS n FROM variants GROUP BY 1),
        top AS (SELECT n FROM counts ORDER BY n DESC, variant LIMIT 15)
        SELECT (SELECT count(*) FROM top) AS n_variants, CAST((SELECT sum(n) FROM top) AS BIGINT) AS cases_kept,
          CAST(sum(n) AS BIGINT) AS cases_total, round((SELECT sum(n) FROM top) / sum(n), 6) AS coverage FROM counts""",
)
def variant_coverage(spark, sf):
    counts = variants.variant_counts(durable(variants.variant_analysis(events_log(spark, sf))))
    return rounded(variants.variant_coverage(counts, 15), "coverage")


def _sensitivity(gap: int) -> str:
    return f"""
      SELECT '{gap} days' AS gap, case_id, activity, ts,
        sum(CASE WHEN ts - prev > INTERVAL {gap} DAY THEN 1 ELSE 0 END)
          OVER (PARTITION BY case_id ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS session FROM timed"""


@query(
    "case_window_sensitivity",
    f"""WITH {ORDERS_LOG},
        timed AS (SELECT *, lag(ts) OVER (PARTITION BY case_id ORDER BY ts, ord) AS prev FROM log),
        split AS (SELECT 'none' AS gap, case_id, activity, ts, 0 AS session FROM timed
          UNION ALL {_sensitivity(7)} UNION ALL {_sensitivity(30)}),
        per_case AS (SELECT gap, case_id, session, (count(*) - count(DISTINCT activity)) / count(*) AS loop_rate,
          date_sub('day', min(ts), max(ts)) AS days FROM split GROUP BY ALL),
        rows AS (SELECT gap, count(*) AS n_cases, avg(loop_rate) AS l, avg(days) AS d FROM per_case GROUP BY 1)
        SELECT gap, n_cases, round(l, 6) AS mean_loop_rate, round(d, 6) AS mean_duration_days,
          round(l - (SELECT l FROM rows WHERE gap = 'none'), 6) AS loop_rate_change,
          round(d - (SELECT d FROM rows WHERE gap = 'none'), 6) AS duration_change FROM rows""",
)
def case_window_sensitivity(spark, sf):
    report = windows.case_window_sensitivity(orders_log(spark, sf), (7, 30))
    return rounded(report, "mean_loop_rate", "mean_duration_days", "loop_rate_change", "duration_change")


@query(
    "calendar_cases",
    f"""WITH {ORDERS_LOG} SELECT case_id || '#' || strftime(date_trunc('month', ts), '%Y-%m-%d') AS case_id,
        count(*) AS n_events FROM log GROUP BY 1""",
)
def calendar_cases(spark, sf):
    monthly = windows.split_by_calendar(orders_log(spark, sf), "month")
    return monthly.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_events"))
