"""Additive partials of an event log by segment, from which any selection is answered by adding rows.

Built once from the log: one row a case (metrics and variant), and by segment the counts and sums of cases, the transitions
between activities, and the marks of its calls. A selection of segments reads these tables only. Grouping rare activities
under one name maps both ends of a transition, so the graph of a selection comes from the transitions as well.

A segment does not change within a case; the build checks it. Added events change only their cases: a refresh computes the
partials of these cases before and after, takes the first away and adds the second, and writes a new version beside the old
one. Sums of whole numbers are exact; rates are sums over cases of the case's own rate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators import cases as case_ops
from casewise.operators import dfg
from casewise.operators import variants as variant_ops
from casewise.operators.event_log import HOT_CASE_EVENTS, sequence_events
from casewise.operators.joins import split_join
from casewise.plans import reports

LOG = ("case_id", "activity", "ts", "ord", "crop", "state", "season")
STEPS = ("crop", "activity", "next_activity", "is_start")


def _case_rows(log: DataFrame, hot_events: int) -> DataFrame:
    """One row a case: metrics, variant, and how many segments it has (which must be one)."""
    crops = log.groupBy("case_id").agg((F.min("crop").eqNullSafe(F.max("crop")) & (F.count("crop").isin(0) | (F.count("crop") == F.count(F.lit(1))))).alias("one"))
    variants = variant_ops.variant_analysis(log, hot_events).drop("crop", "state")
    return case_ops.case_metrics(log).join(variants, "case_id").join(crops, "case_id")


def _segment_rows(cases: DataFrame, sign: int = 1) -> DataFrame:
    """Rates are kept as whole numbers of 1e-12, so that rows can be taken away again without a rest."""
    return cases.groupBy("crop").agg(
        (F.count(F.lit(1)) * sign).alias("n_cases"), (F.sum("n_events") * sign).alias("n_events"),
        (F.sum(F.round(F.col("loop_rate") * 10**12).cast("decimal(38,0)")) * sign).cast("decimal(38,0)").alias("loop_rate"),
        (F.sum("duration_days") * sign).cast("long").alias("duration_days"),
    )


def _transition_rows(log: DataFrame, hot_events: int, sign: int = 1) -> DataFrame:
    ordered = sequence_events(log.select("case_id", "activity", "ts", "ord", "crop"), hot_events=hot_events)
    return ordered.groupBy("crop", "activity", "next_activity", (F.col("step") == 1).alias("is_start")).agg(
        (F.count(F.lit(1)) * sign).alias("n")
    )


def _mark_rows(scored: DataFrame) -> DataFrame:
    return scored.groupBy("crop").agg(
        F.count("is_mismatch").alias("n_calls"), F.count_if("is_mismatch").alias("n_mismatches")
    )


def _added(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys added up; nothing is left of what was taken away."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    numbers = [c for c in every.columns if c not in keys]
    sums = [F.sum(c).cast(every.schema[c].dataType).alias(c) for c in numbers]
    return every.groupBy(*keys).agg(*sums).where(F.col(numbers[0]) != 0)


@dataclass
class Partials:
    spark: SparkSession
    folder: str
    hot_events: int = HOT_CASE_EVENTS
    #: folders of the events: those of the first build, then those of each refresh
    logs: tuple[str, ...] = ()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def log(self) -> DataFrame:
        return self.spark.read.parquet(*self.logs)

    # -- answers ---------------------------------------------------------------------------

    def _own(self, name: str, crops: Sequence[str] | None) -> DataFrame:
        return reports.select_segments(self.table(name), crops)

    def kpis(self, crops: Sequence[str] | None = None) -> DataFrame:
        """A10 for a selection: the sum of its segments' rows."""
        def mean(total: Column, n: Column) -> Column:
            return F.coalesce(F.try_divide(total.cast("double"), n), F.lit(0.0))

        marks = self._own("marks", crops).agg(F.try_divide(F.sum("n_mismatches") * 100, F.sum("n_calls")))
        return self._own("segments", crops).agg(
            F.coalesce(F.sum("n_cases"), F.lit(0)).alias("n_cases"),
            mean(F.sum("loop_rate").cast("double") / 1e12, F.sum("n_cases")).alias("mean_loop_rate"),
            mean(F.sum("duration_days"), F.sum("n_cases")).alias("mean_duration_days"),
        ).withColumn("pct_mismatch", marks.scalar())

    def segment_stats(self, crops: Sequence[str] | None = None) -> DataFrame:
        """A11."""
        return self._own("segments", crops).select(
            "crop", (F.col("loop_rate").cast("double") / 1e12 / F.col("n_cases")).alias("loop_rate"), "n_cases"
        )

    def loop_and_mismatch(self, crops: Sequence[str] | None = None, min_calls: int = 5) -> DataFrame:
        """JN3: both rates of the segments with enough calls."""
        marks = self._own("marks", crops).where(F.col("n_calls") >= min_calls).select(
            "crop", (F.col("n_mismatches") / F.col("n_calls")).alias("mismatch_rate"), "n_calls"
        )
        return self.segment_stats(crops).join(marks, "crop")

    def case_list(self, crops: Sequence[str] | None = None) -> DataFrame:
        """JN2."""
        return reports.case_table(self._own("cases", crops))

    def variant_explorer(self, crops: Sequence[str] | None = None, n: int = 30) -> DataFrame:
        """R3."""
        return reports.variant_explorer(self.table("cases"), crops, n)

    def process_map(
        self, crops: Sequence[str] | None = None, n_activities: int = 6, n_edges: int = 10, other: str = "Other"
    ) -> dict[str, DataFrame]:
        """The graph of a selection, from its transitions."""
        raw = self._own("transitions", crops)
        top = raw.groupBy("activity").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "activity").limit(n_activities)
        named = top.agg(F.collect_list("activity")).scalar()

        def grouped(name: str) -> Column:
            plain = F.replace(F.col(name), F.lit(","), F.lit(" -"))
            return F.when(F.col(name).isNull(), None).when(F.array_contains(named, F.col(name)), plain).otherwise(other)

        steps = raw.select(grouped("activity").alias("activity"), grouped("next_activity").alias("next_activity"), "is_start", "n")
        steps = steps.groupBy("activity", "next_activity", "is_start").agg(F.sum("n").alias("n"))
        edges = dfg.top_edges(dfg.edge_counts(steps), n_edges)
        nodes = dfg.trimmed_nodes(steps, edges)
        size = self._own("segments", crops).agg(
            F.coalesce(F.sum("n_events"), F.lit(0)).alias("n_events"), F.coalesce(F.sum("n_cases"), F.lit(0)).alias("n_cases")
        ).withColumn("note", reports.map_note())
        enough = size.select(F.col("n_events") >= 2).scalar()
        return {"size": size, "edges": edges.where(enough), "nodes": nodes.where(enough)}

    # -- refresh -----------------------------------------------------------------------------

    def refreshed(self, added: DataFrame, folder: str, scored: DataFrame | None = None) -> Partials:
        """A new version with the added events (and the marks of added calls); only their cases are computed."""
        new = Partials(self.spark, folder, self.hot_events, (*self.logs, f"{folder}/log"))
        added = new._store("log", added.select(*LOG))
        changed = new._store("changed", added.select("case_id").distinct())
        before = split_join(self.log(), changed, ["case_id"], "left_semi")
        now = new._store("now", split_join(new.log(), changed, ["case_id"], "left_semi"))
        cases_now = new._store("cases-now", _case_rows(now, self.hot_events))
        cases_before = split_join(self.table("cases"), changed, ["case_id"], "left_semi")
        kept = split_join(self.table("cases"), changed, ["case_id"], "left_anti")
        new._store("cases", kept.unionByName(cases_now))
        new._store("segments", _added([self.table("segments"), _segment_rows(cases_before, -1), _segment_rows(cases_now)], ["crop"]))
        steps = [self.table("transitions"), _transition_rows(before, self.hot_events, -1), _transition_rows(now, self.hot_events)]
        new._store("transitions", _added(steps, STEPS))
        marks = self.table("marks")
        new._store("marks", marks if scored is None else _added([marks, _mark_rows(scored)], ["crop"]))
        new._checked()
        return new

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.table(name)

    def _checked(self) -> None:
        several = self.table("cases").where(~F.col("one")).select("case_id").first()
        if several:
            raise ValueError(f"case {several['case_id']} has more than one segment")


def build(log: DataFrame, folder: str, scored: DataFrame | None = None, hot_events: int = HOT_CASE_EVENTS) -> Partials:
    """The partials of an event log, and of scored calls (crop, is_mismatch), under ``folder``."""
    out = Partials(log.sparkSession, folder, hot_events, (f"{folder}/log",))
    stored = out._store("log", log.select(*LOG))
    cases = out._store("cases", _case_rows(stored, hot_events))
    out._checked()
    out._store("segments", _segment_rows(cases))
    out._store("transitions", _transition_rows(stored, hot_events))
    none = out.spark.createDataFrame([], "crop string, is_mismatch boolean")
    out._store("marks", _mark_rows(none if scored is None else scored.select("crop", "is_mismatch")))
    return out
