"""Queries answered from stored tables: partials, bucketed logs and sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casewise.operators import cases, dfg, event_log, partials, sketches, variants
from casewise.session import shared_folder
from casewise.sources import bucketed
from checks.common import CASES, EVENTS_LOG, ORDERS_LOG, VARIANTS, events_log, orders_log, query, rounded, table
from checks.process import ACTIVITY_TOTALS
from checks.report import CHOSEN, KPI_COLUMNS, MAP, SCORED, SEGMENTS, SEGMENTS_SQL, _scored, kpi_sql
from checks.common import STEPS


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _partials(spark, sf):
    return partials.build(orders_log(spark, sf), _folder(spark, "partials"), _scored(spark, sf))


def _refreshed(spark, sf):
    """Built from two thirds of the orders, then refreshed with the others."""
    log, scored = orders_log(spark, sf), _scored(spark, sf)
    first = F.col("ord") % 3 != 0
    built = partials.build(log.where(first), _folder(spark, "partials"), scored)
    return built.refreshed(log.where(~first), _folder(spark, "partials"))


@query("partial_kpis", f"WITH {ORDERS_LOG}, {CASES}, {SCORED}, {CHOSEN} {kpi_sql('own', 'marks')}")
def partial_kpis(spark, sf):
    return rounded(_partials(spark, sf).kpis(SEGMENTS), *KPI_COLUMNS)


@query("refreshed_kpis", f"WITH {ORDERS_LOG}, {CASES}, {SCORED}, {CHOSEN} {kpi_sql('own', 'marks')}")
def refreshed_kpis(spark, sf):
    return rounded(_refreshed(spark, sf).kpis(SEGMENTS), *KPI_COLUMNS)


@query(
    "refreshed_case_list",
    f"""WITH {ORDERS_LOG}, {CASES} SELECT case_id, n_events, round_even(loop_rate, 2) AS loop_rate, duration_days, crop, state
        FROM cases WHERE crop IN {SEGMENTS_SQL}""",
)
def refreshed_case_list(spark, sf):
    return _refreshed(spark, sf).case_list(SEGMENTS)


@query(
    "partial_loop_and_mismatch",
    f"""WITH {ORDERS_LOG}, {CASES}, {SCORED}, {CHOSEN}
        SELECT crop, round(l, 6) AS loop_rate, n_cases, round(m, 6) AS mismatch_rate, n_calls
        FROM (SELECT crop, avg(loop_rate) AS l, count(*) AS n_cases FROM own GROUP BY 1)
        JOIN (SELECT crop, avg(CAST(is_mismatch AS INT)) AS m, count(*) AS n_calls FROM marks GROUP BY 1) USING (crop)
        WHERE n_calls >= 5""",
)
def partial_loop_and_mismatch(spark, sf):
    return rounded(_partials(spark, sf).loop_and_mismatch(SEGMENTS), "loop_rate", "mismatch_rate")


@query("refreshed_map_nodes", f"{MAP} {ACTIVITY_TOTALS}")
def refreshed_map_nodes(spark, sf):
    return _refreshed(spark, sf).process_map(SEGMENTS, 6, 100)["nodes"]


@query(
    "partial_map_size",
    f"""{MAP} SELECT count(*) AS n_events, count(DISTINCT case_id) AS n_cases,
        'from ' || count(*) || ' events across ' || count(DISTINCT case_id) || ' cases' AS note FROM log""",
)
def partial_map_size(spark, sf):
    return _partials(spark, sf).process_map(SEGMENTS)["size"]


# -- logs stored by case ---------------------------------------------------------------------


def _stored(spark, log, hot_events):
    return bucketed.save_log(log, _folder(spark, "log"), 8, hot_events)


@query(
    "stored_event_steps",
    f"""WITH {ORDERS_LOG} SELECT case_id, ord, row_number() OVER w AS step, lag(ts) OVER w AS prev_ts,
        lead(activity) OVER w AS next_activity FROM log WINDOW w AS (PARTITION BY case_id ORDER BY ts, ord)""",
)
def stored_event_steps(spark, sf):
    """Steps from buckets; cases above 100 events are stored apart and cut into chunks."""
    log = _stored(spark, orders_log(spark, sf), 100)
    return log.each(lambda part: event_log.sequence_events(part, hot_events=100)).select(
        "case_id", "ord", "step", "prev_ts", "next_activity"
    )


@query(
    "stored_variants",
    f"WITH {EVENTS_LOG}, {VARIANTS} SELECT case_id, variant, n_steps, crop, state, season FROM variants",
)
def stored_variants(spark, sf):
    log = _stored(spark, events_log(spark, sf), event_log.HOT_CASE_EVENTS)
    return log.each(lambda part: variants.variant_analysis(part).join(variants.sequences(part), "case_id")).select(
        "case_id", "variant", "n_steps", "crop", "state", "season"
    )


@query(
    "stored_dfg_edges",
    f"""WITH {EVENTS_LOG}, {STEPS} SELECT activity AS src, next_activity AS dst, count(*) AS n FROM steps
        WHERE next_activity IS NOT NULL GROUP BY ALL""",
)
def stored_dfg_edges(spark, sf):
    return dfg.edge_counts(_stored(spark, events_log(spark, sf), event_log.HOT_CASE_EVENTS).each(dfg.transitions))


@query(
    "stored_case_tables",
    f"WITH {EVENTS_LOG}, {CASES} SELECT case_id, n_events, n_repeats, round(loop_rate, 6) AS loop_rate, crop, state, "
    "duration_days FROM cases",
)
def stored_case_tables(spark, sf):
    log = _stored(spark, events_log(spark, sf), event_log.HOT_CASE_EVENTS)
    both = lambda part: cases.join_case_tables(cases.loop_rate_per_case(part), cases.case_durations(part))
    return rounded(log.each(both), "loop_rate")


# -- sketches ------------------------------------------------------------------------------------

PERIOD = ("1995-03-01", "1996-08-31")


@query(
    "distinct_from_sketches",
    f"""WITH {ORDERS_LOG}, own AS (
          SELECT l.*, o_custkey FROM log l JOIN orders ON o_orderkey = ord
          WHERE ts >= '{PERIOD[0]}' AND ts < CAST('{PERIOD[1]}' AS DATE) + 1),
        counted AS (SELECT crop AS segment, unnest(['ord', 'o_custkey']) AS field, unnest([ord, o_custkey]) AS value FROM own)
        SELECT segment, field, count(value) AS n, count(DISTINCT value) AS n_exact, true AS within FROM counted GROUP BY ALL""",
)
def distinct_from_sketches(spark, sf):
    """Customers and orders of a period by segment: the estimate is within four standard errors of the exact count."""
    buyers = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), "o_custkey")
    log = orders_log(spark, sf).join(buyers, "ord")
    path = _folder(spark, "sketches")
    sketches.daily_sketches(log, ["ord", "o_custkey"]).write.parquet(path)
    estimated = sketches.distinct_between(spark.read.parquet(path), *PERIOD, by=["segment"])
    period = log.where((F.to_date("ts") >= PERIOD[0]) & (F.to_date("ts") <= PERIOD[1]))
    exact = period.select(F.col("crop").alias("segment"), F.inline(F.array(
        *(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("ord", "o_custkey"))
    ))).groupBy("segment", "field").agg(F.count_distinct("value").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) / F.col("n_exact")
    return estimated.join(exact, ["segment", "field"]).select(
        "segment", "field", "n", "n_exact", (off <= 4 * sketches.standard_error()).alias("within")
    )
