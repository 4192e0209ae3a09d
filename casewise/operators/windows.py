"""How case metrics change when a long pause starts a new case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.cases import case_metrics
from casewise.operators.event_log import HOT_CASE_EVENTS, sequence_events


def split_by_gap(log: DataFrame, gap_days: float, hot_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """A stricter log: a pause of more than ``gap_days`` days inside a case starts a new case."""
    ordered = sequence_events(log, {"session": gap_days}, hot_events)
    return ordered.withColumn("case_id", F.concat_ws("#", "case_id", "session")).select(*log.columns)


def split_by_calendar(log: DataFrame, unit: str = "month") -> DataFrame:
    """A stricter log: the calendar unit of the event is part of the case key."""
    bucket = F.date_format(F.date_trunc(unit, F.col("ts")), "yyyy-MM-dd")
    return log.withColumn("case_id", F.concat_ws("#", "case_id", bucket))


def case_window_sensitivity(
    log: DataFrame, gap_days: Sequence[int] = (7, 30), hot_events: int = HOT_CASE_EVENTS
) -> DataFrame:
    """Cases, mean loop rate and mean duration per gap, with the change against no gap.

    The log is ordered once for all gaps; each event is then counted once per gap.
    """
    names = {f"session_{g}": g for g in gap_days}
    ordered = sequence_events(log.select("case_id", "activity", "ts", "ord"), names, hot_events)
    settings = F.array(
        F.struct(F.lit("none").alias("gap"), F.lit(0).cast("long").alias("session")),
        *[F.struct(F.lit(f"{g} days").alias("gap"), F.col(f"session_{g}").alias("session")) for g in gap_days],
    )
    per_case = case_metrics(
        ordered.select("case_id", "activity", "ts", "ord", F.inline(settings)),
        keys=("gap", "case_id", "session"),
        attributes=(),
    )
    rows = per_case.groupBy("gap").agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.avg("loop_rate").alias("mean_loop_rate"),
        F.avg("duration_days").alias("mean_duration_days"),
    )
    # one row per gap, so the one-task window is over a handful of rows
    base = Window.orderBy(F.col("gap") != "none").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(
        "gap",
        "n_cases",
        "mean_loop_rate",
        "mean_duration_days",
        (F.col("mean_loop_rate") - F.first("mean_loop_rate").over(base)).alias("loop_rate_change"),
        (F.col("mean_duration_days") - F.first("mean_duration_days").over(base)).alias("duration_change"),
    )
