"""Partials, logs in buckets and sketches: the answers of the whole log, from what is stored."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casewise.operators import cases, dfg, event_log, partials, sketches, variants
from casewise.plans import reports
from casewise.sources import bucketed

SCHEMA = "case_id string, activity string, ts timestamp_ntz, ord bigint, crop string, state string, season string"


def made(n, seed=1, first=0):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        case = draw.randrange(12) if draw.random() < 0.9 else 99
        crop = None if case == 7 else f"crop {case % 4}"
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randrange(2000))
        out.append((f"c{case}", draw.choice("abcde") + draw.choice(["", ", x"]), ts, first + i, crop, "s", draw.choice(["k", "r", None])))
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(made(400), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame([(f"crop {i % 4}", [True, False, None][i % 3]) for i in range(40)], "crop string, is_mismatch boolean")


def answers(part, crops):
    """All answers of the partials for a selection, as sorted rows."""
    found = part.process_map(crops, 4, 6)
    frames = [part.kpis(crops), part.case_list(crops), part.segment_stats(crops), part.loop_and_mismatch(crops), part.variant_explorer(crops), *found.values()]
    return [sorted(map(tuple, f.select(*sorted(f.columns)).collect()), key=repr) for f in frames]


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert len(x) == len(y)
        for r, s in zip(x, y):
            for v, w in zip(r, s):
                assert v == pytest.approx(w, rel=1e-9) if isinstance(v, float) else v == w


@pytest.mark.parametrize("crops", [None, ["crop 1"], ["crop 0", "crop 3"], ["none"]])
def test_a_selection_equals_the_reports_of_its_log(spark, log, scored, tmp_path, crops):
    part = partials.build(log, str(tmp_path / "p"), scored)
    metrics = cases.case_metrics(log)
    own = reports.select_segments(metrics, crops)
    marks = reports.select_segments(scored, crops)
    plain = reports.process_map(log, crops, 4, 6)
    frames = [
        reports.kpis(own, marks), reports.case_table(own), reports.segment_stats(own), reports.loop_and_mismatch(own, marks, "crop"),
        reports.variant_explorer(variants.variant_analysis(log), crops), *plain.values(),
    ]
    close(answers(part, crops), [sorted(map(tuple, f.select(*sorted(f.columns)).collect()), key=repr) for f in frames])


def test_answers_read_no_events(log, scored, tmp_path):
    part = partials.build(log, str(tmp_path / "p"), scored)
    for frame in (part.kpis(["crop 1"]), part.process_map(["crop 1"])["nodes"], part.variant_explorer(), part.case_list(), part.loop_and_mismatch()):
        assert "/log" not in "".join(frame.inputFiles()) and frame.inputFiles()


def test_a_refresh_equals_a_build_from_all(spark, log, scored, tmp_path):
    """Added events of old and new cases, twice; what is left is what a build from all events gives."""
    more = [spark.createDataFrame(made(n, seed, first), SCHEMA) for n, seed, first in ((30, 5, 1000), (1, 6, 2000))]
    new_case = spark.createDataFrame([("new", "z", dt.datetime(2025, 1, 1), 3000, "crop 9", "s", None)], SCHEMA)
    built = partials.build(log, str(tmp_path / "a"), scored)
    once = built.refreshed(more[0].unionByName(new_case), str(tmp_path / "b"), scored)
    twice = once.refreshed(more[1], str(tmp_path / "c"))
    whole = partials.build(log.unionByName(more[0]).unionByName(new_case).unionByName(more[1]), str(tmp_path / "d"), scored.unionByName(scored))
    for crops in (None, ["crop 1", "crop 9"]):
        close(answers(twice, crops), answers(whole, crops))
    for name in ("cases", "segments", "transitions", "marks"):
        columns = sorted(whole.table(name).columns)
        assert sorted(map(repr, twice.table(name).select(*columns).collect())) == sorted(map(repr, whole.table(name).select(*columns).collect()))
    assert twice.log().count() == 432 and len(twice.logs) == 3


def test_a_segment_that_changes_within_a_case_is_an_error(spark, tmp_path):
    rows = [("c", "a", dt.datetime(2024, 1, 1), 1, "x", "s", None), ("c", "a", dt.datetime(2024, 1, 2), 2, "y", "s", None)]
    with pytest.raises(ValueError, match="more than one segment"):
        partials.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "p"))


def test_no_events(spark, tmp_path):
    part = partials.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "p"))
    assert tuple(part.kpis().first()) == (0, 0.0, 0.0, None)
    assert part.process_map()["edges"].collect() == [] and part.process_map()["size"].first()["n_events"] == 0


# -- buckets -----------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_need_no_shuffle_by_case(spark, log, tmp_path):
    stored = bucketed.save_log(log, str(tmp_path / "log"), 4)
    cold = stored.cold()
    assert not stored.has_hot
    both = cases.join_case_tables(cases.loop_rate_per_case(cold), cases.case_durations(cold).hint("merge"))
    for frame in (
        event_log.sequence_events(cold), variants.variant_analysis(cold), cases.case_metrics(cold), both,
        event_log.sequence_events(cold).groupBy("case_id").count(),
    ):
        assert "Exchange" not in plan(frame)
    assert "hashpartitioning(case_id" in plan(event_log.sequence_events(log))
    edges = event_log.sequence_events(cold).groupBy("activity", "next_activity").count()
    assert "hashpartitioning(case_id" not in plan(edges)


@pytest.mark.parametrize("hot_events", [1_000, 30])
def test_stored_logs_give_the_same_rows(spark, log, rows, tmp_path, hot_events):
    stored = bucketed.save_log(log, str(tmp_path / "log"), 4, hot_events)
    assert stored.has_hot == (hot_events == 30)
    steps = lambda part: event_log.sequence_events(part, hot_events=hot_events)
    columns = ("case_id", "ord", "step", "prev_ts", "next_activity")
    assert rows(stored.each(steps), *columns) == rows(event_log.sequence_events(log), *columns)
    assert rows(stored.each(variants.variant_analysis)) == rows(variants.variant_analysis(log))
    edges = dfg.edge_counts(stored.each(lambda part: dfg.transitions(part, hot_events)))
    assert rows(edges) == rows(dfg.edge_counts(dfg.transitions(log)))
    if stored.has_hot:
        n = stored.hot().groupBy("case_id").count()
        assert n.where("count <= 30").isEmpty() and stored.cold().join(n, "case_id").isEmpty()
    stored.drop()
    assert not spark.catalog.tableExists(stored.name)


# -- sketches ------------------------------------------------------------------------------------


def test_sketches_of_days_are_merged_for_any_range(spark):
    events = spark.range(60_000).select(
        F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id % 30 as int))").alias("ts"),
        F.concat(F.lit("crop "), (F.col("id") % 3).cast("string")).alias("crop"), (F.col("id") * 7919 % 20_011).alias("user"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("call"),
    )
    daily = sketches.daily_sketches(events, ["user", "call"])
    assert daily.count() == 30 * 2
    own = events.where("day(ts) BETWEEN 5 AND 20 AND crop IN ('crop 1', 'crop 2')")
    for r in sketches.distinct_between(daily, "2024-01-05", "2024-01-20", ["crop 1", "crop 2"]).collect():
        exact = own.select(r["field"]).where(F.col(r["field"]).isNotNull())
        assert r["n"] == exact.count()
        assert abs(r["n_distinct"] / exact.distinct().count() - 1) < 4 * sketches.standard_error()
    assert sketches.distinct_between(daily, "2030-01-01").collect() == []
