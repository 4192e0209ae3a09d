"""Case-level metrics: loop rate, duration and their summary by segment.

All of it is partially aggregated before the shuffle, so a case or a segment that holds a
large part of the rows costs no task more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_key(log: DataFrame) -> Column:
    """The order of events inside a case as one comparable value.

    For integer ids it is a number, time * 2e19 + id, which a hash aggregate can keep. Other
    ids, and zones in which local times do not map to instants in order, need a struct, for
    which Spark sorts the rows of each task.
    """
    steady = log.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")
    if steady and log.schema["ord"].dataType.typeName() in ("long", "integer", "short", "byte"):
        micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(19,0)")
        return micros * F.lit("20000000000000000000").cast("decimal(20,0)") + F.col("ord").cast("decimal(19,0)")
    return F.struct("ts", "ord")


def case_metrics(log: DataFrame, keys: Sequence[str] = ("case_id",), attributes: Sequence[str] = ("crop", "state")) -> DataFrame:
    """A1, A2 and JN1 in one pass: counts, repeats, loop rate, whole days, first attributes.

    A repeat is an event whose activity occurred earlier in its case, so there are
    ``events - distinct activities`` of them. Days are whole 24-hour periods.

    Events are first reduced to one row per case, activity and attribute values, with
    numeric buffers only, so the first aggregate is a hash aggregate that combines before
    the shuffle; the second one sees a few rows per case.
    """
    groups = log.groupBy(*keys, "activity", *attributes).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        *([F.min(_first_key(log)).alias("first_key")] if attributes else []),
    )
    first = F.min_by(F.struct(*attributes), "first_key").alias("first") if attributes else None
    out = groups.groupBy(*keys).agg(
        F.sum("n").alias("n_events"),
        (F.sum("n") - F.count_distinct("activity")).alias("n_repeats"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *([first] if attributes else []),
    )
    return out.select(
        *keys,
        "n_events",
        "n_repeats",
        (F.col("n_repeats") / F.col("n_events")).alias("loop_rate"),
        F.extract(F.lit("DAY"), F.col("last_ts") - F.col("first_ts")).alias("duration_days"),
        *[F.col(f"first.{a}").alias(a) for a in attributes],
    )


def loop_rate_per_case(log: DataFrame) -> DataFrame:
    """A1."""
    return case_metrics(log).select("case_id", "n_events", "n_repeats", "loop_rate", "crop", "state")


def case_durations(log: DataFrame) -> DataFrame:
    """A2."""
    return case_metrics(log).select("case_id", "duration_days", "n_events", "crop", "state")


def join_case_tables(loops: DataFrame, durations: DataFrame, how: str = "left") -> DataFrame:
    """JN1 (inner) and JN2 (left): loop table with the duration of the same case."""
    return loops.join(durations.select("case_id", "duration_days"), "case_id", how)


def summarize_by_segment(cases: DataFrame, segment: str = "crop") -> DataFrame:
    """A4: mean loop rate, mean duration and number of cases per segment."""
    return cases.groupBy(segment).agg(
        F.avg("loop_rate").alias("mean_loop_rate"),
        F.avg("duration_days").alias("mean_duration_days"),
        F.count(F.lit(1)).alias("n_cases"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Value frequencies; ``top`` keeps the most frequent, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), column).limit(top)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values, exact unless asked otherwise."""
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(counter(column).alias("n_distinct"))
