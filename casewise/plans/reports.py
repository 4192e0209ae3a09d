"""The report tables, over case tables with one row per case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.functions.numeric import correlation_verdict, pearson
from casewise.functions.text import number, percent, plural, truncate
from casewise.operators import dfg, variants as variant_ops
from casewise.operators.hierarchy import HierarchicalClassifier
from casewise.operators.mismatch import loop_and_mismatch
from casewise.operators.retrieval import TfidfRetriever, above

MIN_CASES = 5


def select_segments(df: DataFrame, values: Sequence[str] | None, column: str = "crop") -> DataFrame:
    """P10: rows of the chosen segments; nothing chosen means all."""
    return df.where(F.col(column).isin(*values)) if values else df


def kpis(cases: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """A10: cases, mean loop rate, mean duration, percent of mismatches (null when absent)."""
    out = cases.agg(
        F.count("case_id").alias("n_cases"),
        F.coalesce(F.avg("loop_rate"), F.lit(0.0)).alias("mean_loop_rate"),
        F.coalesce(F.avg("duration_days"), F.lit(0.0)).alias("mean_duration_days"),
    )
    if scored is None:
        return out.withColumn("pct_mismatch", F.lit(None).cast("double"))
    return out.withColumn("pct_mismatch", scored.agg(F.avg(F.col("is_mismatch").cast("double")) * 100).scalar())


def segment_stats(cases: DataFrame, segment: str = "crop") -> DataFrame:
    """A11."""
    return cases.groupBy(segment).agg(
        F.avg("loop_rate").alias("loop_rate"), F.count("case_id").alias("n_cases")
    )


def supported_segments(cases: DataFrame, segment: str = "crop", min_cases: int = MIN_CASES) -> DataFrame:
    """Segments with ``min_cases`` cases, or with as many as the largest one has."""
    stats = segment_stats(cases, segment)
    most = stats.agg(F.max("n_cases")).scalar()
    return stats.where(F.col("n_cases") >= F.least(F.lit(min_cases), most))


def top_segments(cases: DataFrame, segment: str = "crop", n: int = 15) -> DataFrame:
    """T5: the segments with the highest loop rate, shown lowest first."""
    return (
        supported_segments(cases, segment).orderBy(F.desc("loop_rate"), segment).limit(n)
        .orderBy("loop_rate", F.desc(segment))
    )


def busiest_segments(summary: DataFrame, segment: str = "crop", n: int = 3, min_cases: int = MIN_CASES) -> DataFrame:
    """The summary's segments with enough cases and the highest loop rate."""
    return summary.where(F.col("n_cases") >= min_cases).orderBy(F.desc("mean_loop_rate"), segment).limit(n)


def headline(cases: DataFrame, summary: DataFrame, scored: DataFrame | None = None, segment: str = "crop") -> DataFrame:
    """One row: KPIs and the three segments with the highest loop rate as text."""
    names = Window.orderBy(F.desc("mean_loop_rate"), segment)
    top = busiest_segments(summary, segment).select(
        F.row_number().over(names).alias("place"),
        F.concat(F.col(segment), F.lit(" ("), percent(F.col("mean_loop_rate")), F.lit(")")).alias("text"),
    )
    line = top.agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("t")).select(
        F.array_join(F.col("t.text"), ", ")
    )
    return kpis(cases, scored).withColumn("top_segments", line.scalar())


def case_table(cases: DataFrame) -> DataFrame:
    """JN2, N16: the case list of the report; the loop rate is shown with two places."""
    return cases.select("case_id", "n_events", F.bround("loop_rate", 2).alias("loop_rate"), "duration_days", "crop", "state")


def loop_vs_mismatch(cases: DataFrame, scored: DataFrame, segment: str = "crop", min_calls: int = 5) -> DataFrame:
    """One row: supported segments, correlation of the two rates, verdict."""
    pairs = loop_and_mismatch(cases, scored, segment, min_calls)
    return pairs.agg(
        F.count(F.lit(1)).alias("n_segments"), pearson("loop_rate", "mismatch_rate").alias("correlation")
    ).withColumn("verdict", correlation_verdict(F.col("correlation")))


def dashboard(
    cases: DataFrame, scored: DataFrame | None = None, crops: Sequence[str] | None = None, segment: str = "crop"
) -> dict[str, DataFrame | None]:
    """R2: all tables of the overview for a selection of segments.

    ``case_list`` is not ordered: sort it, or the pages of it that are shown, where it is
    displayed (``case_picker`` gives the busiest cases).
    """
    own = select_segments(cases, crops, segment)
    marks = None if scored is None else select_segments(scored, crops, segment)
    return {
        "kpis": kpis(own, marks),
        "top_segments": top_segments(own, segment),
        "case_list": case_table(own),
        "loop_and_mismatch": None if marks is None else loop_and_mismatch(own, marks, segment),
        "correlation": None if marks is None else loop_vs_mismatch(own, marks, segment),
    }


def variant_explorer(variants: DataFrame, crops: Sequence[str] | None = None, n: int = 30) -> DataFrame:
    """Rank, cases, share, steps, example crops, cut sequence and short label."""
    counts = variant_ops.variant_counts(select_segments(variants, crops))
    return variant_ops.top_variants(counts, n).select(
        "rank",
        "n_cases",
        F.bround("pct_of_cases", 1).alias("pct_of_cases"),
        "n_steps",
        "example_crops",
        truncate(F.col("opening"), 200).alias("sequence"),
        F.concat(F.lit("#"), F.col("rank"), F.lit(" ("), plural(F.col("n_steps"), "step"), F.lit(")")).alias("short_label"),
    )


def case_picker(cases: DataFrame, crops: Sequence[str] | None = None, n: int | None = None) -> DataFrame:
    """(case_id, label), busiest first; the first one is the default case."""
    label = F.concat(
        F.col("case_id"), F.lit("  —  "), F.col("n_events"), F.lit(" events, loop rate "), percent(F.col("loop_rate"))
    )
    ordered = select_segments(cases, crops).orderBy(F.desc("n_events"), "case_id")
    return (ordered if n is None else ordered.limit(n)).select("case_id", "n_events", label.alias("label"))


def case_explorer(log: DataFrame, cases: DataFrame, case_id: str) -> tuple[DataFrame, DataFrame]:
    """R5, JN8: (statistics, events) of one case.

    Steps are numbered over the one case that was asked for, in the order of its events.
    """
    own = log.where(F.col("case_id") == case_id)
    stats = (
        own.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_calls"))
        .join(cases.where(F.col("case_id") == case_id).select("case_id", "loop_rate", "duration_days", "crop"), "case_id", "left")
        .select(
            "case_id",
            "n_calls",
            F.coalesce(percent(F.col("loop_rate")), F.lit("—")).alias("loop_rate"),
            F.coalesce(F.concat(F.col("duration_days").cast("string"), F.lit(" days")), F.lit("—")).alias("duration"),
            "crop",
        )
    )
    from casewise.operators.event_log import sequence_events

    events = sequence_events(own).select(
        "step",
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("activity").alias("issue_type"),
        truncate(F.col("question"), 160).alias("question"),
        truncate(F.col("answer"), 160).alias("answer"),
    )
    return stats, events


def map_note() -> Column:
    """What a process map was drawn from, of ``n_events`` and ``n_cases``."""
    return F.when(F.col("n_events") < 2, "too few events to draw a flow from").otherwise(
        F.concat(F.lit("from "), F.col("n_events"), F.lit(" events across "), F.col("n_cases"), F.lit(" cases"))
    )


def process_map(
    log: DataFrame, crops: Sequence[str] | None = None, n_activities: int = 6, n_edges: int = 10
) -> dict[str, DataFrame]:
    """Events and cases of the selection with a note, and its graph.

    With fewer than two events there is nothing to follow and edges and nodes are empty.
    """
    own = select_segments(log, crops)
    size = own.agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("case_id").alias("n_cases")).withColumn("note", map_note())
    edges, nodes = dfg.discover_dfg(own, n_activities, n_edges)
    enough = size.select(F.col("n_events") >= 2).scalar()
    return {"size": size, "edges": edges.where(enough), "nodes": nodes.where(enough)}


def answer_queries(
    model: HierarchicalClassifier, retriever: TfidfRetriever, queries: DataFrame, k: int = 5, floor: float = 0.03
) -> tuple[DataFrame, DataFrame]:
    """(predictions, similar past calls) for a table of ``query_id, text``.

    Blank texts are not asked. A query without a match above the floor has one row with a note.
    """
    asked = queries.where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0)
    predictions = model.predict(asked, "text")
    similar = above(retriever.query(asked, k), floor).select(
        "query_id",
        "rank",
        F.concat(F.bround(F.col("similarity") * 100, 0).cast("int").cast("string"), F.lit("%")).alias("match"),
        "crop",
        "category",
        truncate(F.col("question"), 140).alias("similar_question"),
        truncate(F.col("answer"), 220).alias("answer_given"),
    )
    shown = asked.select("query_id").join(similar, "query_id", "left").withColumn(
        "note", F.when(F.col("rank").isNull(), "no sufficiently similar past question found")
    )
    return predictions, shown
