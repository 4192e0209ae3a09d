"""Event log construction and per-event operators.

An event log is a DataFrame with ``case_id, activity, ts, ord`` and any attributes.
``(ts, ord)`` is a total order inside a case: ``ord`` is a unique id, so results never
depend on how the input happened to be partitioned.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.session import durable

#: A case above this many events is ordered in chunks by several tasks instead of by one.
HOT_CASE_EVENTS = 1_000_000

DEFAULT_ATTRIBUTES = {
    "state": "state",
    "crop": "crop",
    "season": "season",
    "question": "question",
    "answer": "answer",
}


def drop_segment(calls: DataFrame, column: str, value: str = "Others", enabled: bool = True) -> DataFrame:
    """Drop a pseudo-segment; rows with a null segment stay."""
    return calls.where(~F.col(column).eqNullSafe(value)) if enabled else calls


def build_event_log(
    calls: DataFrame,
    *,
    activity_col: str,
    case_cols: Sequence[str] = ("district", "crop"),
    ts_col: str = "created_on",
    ord_col: str = "call_id",
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Composite case id, activity, timestamp, order id and attributes.

    Rows with a null case key, activity or timestamp are no events and are dropped
    (``event_log_rejects`` counts them). ``attributes`` maps log column to call column.
    Distinct keys whose joined text is equal ("A_B"+"C", "A"+"B_C") share a case.
    """
    attributes = DEFAULT_ATTRIBUTES if attributes is None else attributes
    required = [*case_cols, activity_col, ts_col]
    kept = calls
    for name in required:
        kept = kept.where(F.col(name).isNotNull())
    return kept.select(
        F.concat_ws("_", *[F.col(c).cast("string") for c in case_cols]).alias("case_id"),
        F.col(activity_col).cast("string").alias("activity"),
        F.col(ts_col).alias("ts"),
        F.col(ord_col).alias("ord"),
        *[F.col(source).alias(name) for name, source in attributes.items()],
    )


def event_log_rejects(calls: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: events kept, events rejected for a null in any required column."""
    bad = F.lit(False)
    for name in required:
        bad = bad | F.col(name).isNull()
    return calls.agg(
        F.count_if(~bad).alias("n_kept"),
        F.count_if(bad).alias("n_rejected"),
    )


def _gap_flag(gap_days: float) -> Column:
    paused = F.col("ts") - F.col("prev_ts") > F.lit(dt.timedelta(days=gap_days))
    return F.coalesce(paused, F.lit(False)).cast("long")


def sequence_events(
    log: DataFrame, gaps: Mapping[str, float] | None = None, hot_events: int = HOT_CASE_EVENTS
) -> DataFrame:
    """Add ``step`` (1..n), ``prev_ts`` and ``next_activity`` to every event.

    ``gaps`` maps a column name to a number of days: the column numbers the sessions of the
    case, a new one starting after a pause longer than that.

    Cases up to ``hot_events`` events take one window over ``case_id``. Larger ones are
    range-partitioned on (case, ts, ord), so a single case spreads over as many tasks as its
    size asks for; each chunk is numbered on its own and a small per-chunk table carries
    counts, the next chunk's first activity and the previous chunk's last time across the
    boundaries. The chunk assignment is checkpointed because it must not change between the
    two reads of it. A chunk is a task, so a low ``hot_events`` does not make more chunks than
    a shuffle has partitions, unless they would hold more than ``HOT_CASE_EVENTS`` each.
    """
    gaps = dict(gaps or {})
    sizes = log.groupBy("case_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_events)
    hot_total = sizes.agg(F.sum("n")).first()[0]
    if hot_total is None:
        return _sequence_within(log, ["case_id"], gaps)

    # at most total/hot_events cases can be hot, so this side is small whatever the input
    hot = F.broadcast(sizes.select("case_id"))
    cold = _sequence_within(log.join(hot, "case_id", "left_anti"), ["case_id"], gaps)

    n_chunks = _chunk_count(hot_total, hot_events, int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunked = durable(
        log.join(hot, "case_id", "left_semi")
        .repartitionByRange(n_chunks, "case_id", "ts", "ord")
        .withColumn("chunk", F.spark_partition_id())
    )
    local = _sequence_within(chunked, ["case_id", "chunk"], {})
    by_chunk = Window.partitionBy("case_id").orderBy("chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        chunked.groupBy("case_id", "chunk")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("activity", F.struct("ts", "ord")).alias("first_activity"),
            F.max("ts").alias("last_ts"),
        )
        .select(
            "case_id",
            "chunk",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
            F.lead("first_activity").over(by_chunk).alias("after_activity"),
            F.lag("last_ts").over(by_chunk).alias("before_ts"),
        )
    )
    whole = (
        local.join(edges, ["case_id", "chunk"])
        .withColumn("step", (F.col("step") + F.col("offset")).cast("int"))
        .withColumn("next_activity", F.coalesce("next_activity", "after_activity"))
        .withColumn("prev_ts", F.coalesce("prev_ts", "before_ts"))
        .drop("offset", "after_activity", "before_ts")
    )
    if gaps:
        flags = [_gap_flag(days).alias(f"flag_{name}") for name, days in gaps.items()]
        whole = whole.select("*", *flags)
        carried = whole.groupBy("case_id", "chunk").agg(
            *[F.sum(f"flag_{name}").alias(f"sum_{name}") for name in gaps]
        ).select(
            "case_id",
            "chunk",
            *[F.coalesce(F.sum(f"sum_{name}").over(before), F.lit(0)).alias(f"sum_{name}") for name in gaps],
        )
        running = Window.partitionBy("case_id", "chunk").orderBy("ts", "ord").rowsBetween(
            Window.unboundedPreceding, 0
        )
        whole = whole.join(carried, ["case_id", "chunk"])
        for name in gaps:
            whole = whole.withColumn(name, F.sum(f"flag_{name}").over(running) + F.col(f"sum_{name}"))
        whole = whole.drop(*[f"flag_{n}" for n in gaps], *[f"sum_{n}" for n in gaps])
    return cold.unionByName(whole.drop("chunk"))


def _chunk_count(events: int, hot_events: int, shuffle_partitions: int) -> int:
    most = max(shuffle_partitions, math.ceil(events / HOT_CASE_EVENTS))
    return max(2, min(math.ceil(events / hot_events), most))


def _sequence_within(log: DataFrame, keys: Sequence[str], gaps: Mapping[str, float]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("ts", "ord")
    out = log.select(
        "*",
        F.row_number().over(order).alias("step"),
        F.lag("ts").over(order).alias("prev_ts"),
        F.lead("activity").over(order).alias("next_activity"),
    )
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    for name, days in gaps.items():
        out = out.withColumn(name, F.sum(_gap_flag(days)).over(running))
    return out


def seen_before(log: DataFrame, hot_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """``is_repeat`` is true where the activity occurred earlier in the same case.

    A (case, activity) pair too large for one task is compared with its first occurrence,
    found by a partially aggregated minimum, instead of being sorted.
    """
    pair = ["case_id", "activity"]
    hot = (
        log.groupBy(*pair)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ts", "ord")).alias("first_at"))
        .where(F.col("n") > hot_events)
        .drop("n")
    )
    order = Window.partitionBy(*pair).orderBy("ts", "ord")

    def windowed(part: DataFrame) -> DataFrame:
        return part.withColumn("is_repeat", F.row_number().over(order) > 1)

    if hot.isEmpty():
        return windowed(log)
    # at most total/hot_events pairs can be hot
    hot = F.broadcast(hot)
    large = log.join(hot, pair).withColumn("is_repeat", F.struct("ts", "ord") > F.col("first_at"))
    return windowed(log.join(hot, pair, "left_anti")).unionByName(large.drop("first_at"))


def top_activities(log: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent activities, ties by name."""
    return (
        log.groupBy("activity")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "activity")
        .limit(n)
    )


def bucket_activities(log: DataFrame, n: int, other: str = "Other") -> DataFrame:
    """Activities outside the top ``n`` become ``other``."""
    top = top_activities(log, n).select("activity", F.lit(True).alias("is_top"))
    joined = log.join(F.broadcast(top), "activity", "left")
    return joined.withColumn(
        "activity", F.when(F.col("is_top"), F.col("activity")).otherwise(other)
    ).select(*log.columns)


def plain_labels(log: DataFrame) -> DataFrame:
    """Commas in activity names become " -", as graph labels need."""
    return log.withColumn("activity", F.replace("activity", F.lit(","), F.lit(" -")))
