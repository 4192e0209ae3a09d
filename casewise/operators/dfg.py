"""Directly-follows graph and the relations derived from it.

Everything is read off one small table, ``transitions``: per activity, next activity and
start flag, the number of events. It costs one ordering of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators.event_log import (
    HOT_CASE_EVENTS,
    bucket_activities,
    plain_labels,
    sequence_events,
)
from casewise.session import durable


def transitions(log: DataFrame, hot_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """Counts per (activity, next activity or null at the case end, is first of its case).

    The table is materialised: it is tiny next to the log, and all that reads it would
    otherwise push its own filters down and order the log again.
    """
    ordered = sequence_events(log.select("case_id", "activity", "ts", "ord"), hot_events=hot_events)
    return durable(
        ordered.groupBy("activity", "next_activity", (F.col("step") == 1).alias("is_start")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )


def edge_counts(steps: DataFrame) -> DataFrame:
    """A5: how often ``src`` is directly followed by ``dst`` within a case."""
    return (
        steps.where(F.col("next_activity").isNotNull())
        .groupBy(F.col("activity").alias("src"), F.col("next_activity").alias("dst"))
        .agg(F.sum("n").alias("n"))
    )


def activity_totals(steps: DataFrame) -> DataFrame:
    """Events, case starts, case ends and self-loops per activity."""
    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return steps.groupBy("activity").agg(
        F.sum("n").alias("n_total"),
        total(F.col("is_start")).alias("n_start"),
        total(F.col("next_activity").isNull()).alias("n_end"),
        total(F.coalesce(F.col("next_activity") == F.col("activity"), F.lit(False))).alias("n_self"),
    )


def top_edges(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` strongest edges between different activities, and every self-loop."""
    between = edges.where(F.col("src") != F.col("dst")).orderBy(F.desc("n"), "src", "dst").limit(k)
    return between.unionByName(edges.where(F.col("src") == F.col("dst")))


def trimmed_nodes(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """Totals of the activities that still have an edge; totals are from before the trim."""
    kept = edges.select(F.explode(F.array("src", "dst")).alias("activity")).distinct()
    return activity_totals(steps).join(kept, "activity", "left_semi")


def discover_dfg(
    log: DataFrame, n_activities: int = 6, n_edges: int = 10, hot_events: int = HOT_CASE_EVENTS
) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) of the most frequent activities and strongest edges."""
    steps = transitions(plain_labels(bucket_activities(log, n_activities)), hot_events)
    edges = top_edges(edge_counts(steps), n_edges)
    return edges, trimmed_nodes(steps, edges)


def footprint(steps: DataFrame) -> DataFrame:
    """Per ordered pair of activities, both counts and their relation.

    causal: only a->b occurs; reverse: only b->a; parallel: both; none: neither.
    The pair table is bounded by the distinct activities of an already bucketed log.
    """
    edges = edge_counts(steps)
    both = edges.select("src", "dst", F.col("n").alias("n_forward"), F.lit(0).alias("n_backward")).unionByName(
        edges.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0).alias("n_forward"), F.col("n").alias("n_backward")
        )
    )
    names = F.collect_set("activity").alias("names")
    everything = (
        steps.agg(names)
        .select(F.explode("names").alias("src"), "names")
        .select("src", F.explode("names").alias("dst"))
        .select("src", "dst", F.lit(0).alias("n_forward"), F.lit(0).alias("n_backward"))
    )
    counts = (
        both.unionByName(everything)
        .groupBy("src", "dst")
        .agg(F.sum("n_forward").alias("n_forward"), F.sum("n_backward").alias("n_backward"))
    )
    forward, backward = F.col("n_forward") > 0, F.col("n_backward") > 0
    return counts.withColumn(
        "relation",
        F.when(forward & backward, "parallel").when(forward, "causal").when(backward, "reverse").otherwise("none"),
    )
