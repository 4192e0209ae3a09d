import datetime as dt

import pytest
from pyspark.sql import functions as F

from casewise.operators import cases, dfg, event_log, variants, windows
from casewise.session import durable

SCHEMA = (
    "call_id bigint, district string, crop string, state string, season string, query_type string, "
    "question string, answer string, created_on timestamp_ntz"
)


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def calls(spark):
    data = [
        (1, "D1", "Banana", "K", "RABI", "Weather", "q", "a", at("2024-01-01 23:00")),
        (2, "D1", "Banana", "K", "KHARIF", "Plant Protection", "q", "a", at("2024-01-03 22:00")),
        (3, "D1", "Banana", "K", None, "Plant Protection", "q", "a", at("2024-01-03 22:00")),
        (4, "D1", "Banana", "K", None, "Weather", "q", "a", at("2024-01-05 22:59")),
        (5, "D2", "Banana", "K", "RABI", "Weather", "q", "a", at("2024-02-01 00:00")),
        (6, "D2", "Mango", "K", "RABI", "Nutrient, micro", "q", "a", at("2024-02-01 00:00")),
        (7, "D2", None, "K", "RABI", "Weather", "q", "a", at("2024-02-01 00:00")),
        (8, "D3", "Others", "K", "RABI", None, "q", "a", at("2024-02-01 00:00")),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def log(calls):
    return event_log.build_event_log(calls, activity_col="query_type")


def test_P8_others_dropped_but_null_kept(calls):
    assert event_log.drop_segment(calls, "crop").count() == 7
    assert event_log.drop_segment(calls, "crop", enabled=False).count() == 8


def test_P9_null_key_or_activity_is_no_event(calls, log, rows):
    assert log.count() == 6
    assert rows(event_log.event_log_rejects(calls, ["district", "crop", "query_type", "created_on"])) == [(6, 2)]


def test_A1_A2_loop_and_whole_days(log, rows):
    found = rows(cases.case_metrics(log), "case_id", "n_events", "n_repeats", "loop_rate", "duration_days")
    assert found == [("D1_Banana", 4, 2, 0.5, 3), ("D2_Banana", 1, 0, 0.0, 0), ("D2_Mango", 1, 0, 0.0, 0)]


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_N7_days_do_not_depend_on_the_session_zone(spark, rows, zone):
    data = [("c", "a", at("2024-03-09 02:30"), 1, "x", "y"), ("c", "b", at("2024-03-10 02:30"), 2, "z", "y"),
            ("d", "a", at("2024-11-02 12:00"), 3, "x", "y"), ("d", "a", at("2024-11-03 11:30"), 4, "x", "y")]
    log = spark.createDataFrame(data, "case_id string, activity string, ts timestamp_ntz, ord bigint, crop string, state string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = rows(cases.case_metrics(log), "case_id", "duration_days", "crop")
        assert found == [("c", 1, "x"), ("d", 0, "x")]
        gaps = event_log.sequence_events(log, {"s": 0.99})
        assert rows(gaps, "ord", "s") == [(1, 0), (2, 1), (3, 0), (4, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_A3_sequence_and_modal_season(log, rows):
    found = rows(variants.variant_analysis(log).join(variants.sequences(log), "case_id"), "case_id", "variant", "season")
    assert found[0] == ("D1_Banana", "Weather -> Plant Protection -> Plant Protection -> Weather", "KHARIF")


def test_A4_summary(log, rows):
    assert rows(cases.summarize_by_segment(cases.case_metrics(log))) == [("Banana", 0.25, 1.5, 2), ("Mango", 0.0, 0.0, 1)]


def test_A5_A6_edges_and_ends(log, rows):
    steps = dfg.transitions(event_log.plain_labels(log))
    assert rows(dfg.edge_counts(steps)) == [
        ("Plant Protection", "Plant Protection", 1),
        ("Plant Protection", "Weather", 1),
        ("Weather", "Plant Protection", 1),
    ]
    assert rows(dfg.activity_totals(steps), "activity", "n_start", "n_end") == [
        ("Nutrient - micro", 1, 1),
        ("Plant Protection", 0, 0),
        ("Weather", 2, 2),
    ]


def test_G1_activity_without_an_edge_disappears(log, rows):
    edges, nodes = dfg.discover_dfg(log)
    assert {r[0] for r in rows(nodes)} == {"Plant Protection", "Weather"}
    assert edges.count() == 3


def test_G4_footprint_relations(log, rows):
    relation = {(r[0], r[1]): r[2] for r in rows(dfg.footprint(dfg.transitions(log)), "src", "dst", "relation")}
    assert relation["Weather", "Plant Protection"] == "parallel"
    assert relation["Weather", "Weather"] == "none"
    assert len(relation) == 9


def test_P13_literal_other_merges_with_the_bucket(spark, rows):
    named = spark.createDataFrame([("a",)] * 3 + [("Other",)] * 2 + [("b",)], "activity string")
    bucketed = event_log.bucket_activities(named, 2)
    assert rows(bucketed.groupBy("activity").count()) == [("Other", 3), ("a", 3)]


def test_W3_seen_before(log, rows):
    found = rows(event_log.seen_before(log), "ord", "is_repeat")
    assert [o for o, again in found if again] == [3, 4]


@pytest.fixture(scope="module")
def long_log(spark):
    """One case with most of the events, with tied times, and small cases beside it."""
    return spark.range(600).select(
        F.when(F.col("id") % 5 < 3, "big").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("case_id"),
        F.element_at(F.array(*[F.lit(x) for x in "abc"]), (F.pmod(F.hash("id"), F.lit(3)) + 1).cast("int")).alias("activity"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / 4).cast("int") * F.when(F.col("id") > 300, 9).otherwise(5),
                        F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("id").alias("ord"),
        F.lit("x").alias("crop"), F.lit("y").alias("state"), F.concat(F.lit("s"), F.col("id") % 3).alias("season"),
    )


def test_hot_case_is_ordered_in_chunks(long_log, rows):
    gaps = {"s": 0.3}
    plain = event_log.sequence_events(long_log, gaps)
    chunked = event_log.sequence_events(long_log.repartition(7), gaps, hot_events=50)
    columns = ("case_id", "ord", "step", "prev_ts", "next_activity", "s")
    assert rows(plain, *columns) == rows(chunked, *columns)
    assert plain.agg(F.max("s")).first()[0] > 0


def test_a_low_bound_makes_no_more_chunks_than_tasks(spark, long_log, rows, monkeypatch):
    parts = []

    def counted(df):
        parts.append(df.rdd.getNumPartitions())
        return durable(df)

    monkeypatch.setattr(event_log, "durable", counted)
    columns = ("case_id", "ord", "step", "prev_ts", "next_activity")
    chunked = rows(event_log.sequence_events(long_log, hot_events=2), *columns)
    assert chunked == rows(event_log.sequence_events(long_log), *columns)
    assert parts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_chunks_grow_with_the_events_only_where_they_would_be_too_large():
    hot = event_log.HOT_CASE_EVENTS
    assert event_log._chunk_count(9_000_000, 50, 200) == 200
    assert event_log._chunk_count(900 * hot, 50, 200) == event_log._chunk_count(900 * hot, hot, 200) == 900
    assert event_log._chunk_count(hot + 1, hot, 200) == 2


def test_hot_pair_is_compared_with_its_first_event(long_log, rows):
    assert rows(event_log.seen_before(long_log), "ord", "is_repeat") == rows(
        event_log.seen_before(long_log, hot_events=50), "ord", "is_repeat"
    )


def test_hot_case_graph_and_windows(long_log, rows):
    assert rows(dfg.transitions(long_log)) == rows(dfg.transitions(long_log, hot_events=50))
    assert rows(windows.case_window_sensitivity(long_log, (1,))) == rows(
        windows.case_window_sensitivity(long_log, (1,), hot_events=50)
    )


def test_variants_do_not_depend_on_what_counts_as_hot(long_log, rows):
    plain = rows(variants.variant_analysis(long_log))
    assert plain == rows(variants.variant_analysis(long_log.repartition(5), hot_events=4))
    texts = rows(variants.sequences(long_log))
    assert texts == rows(variants.sequences(long_log, hot_events=4))
    opening = {r[0]: r[2] for r in plain}
    for case, text in texts:
        assert opening[case] == " -> ".join(text.split(" -> ")[:variants.OPENING_STEPS])
    assert len(opening["big"]) < len(dict(texts)["big"])


def test_variant_keys_tell_order_and_repeats_apart(spark, rows):
    log = spark.createDataFrame(
        [(case, activity, i) for case in ["ab", "ba", "aab", "abb", "ab!", "aa", "a"] for i, activity in enumerate(case.rstrip("!"))],
        "case_id string, activity string, ord int",
    ).select("case_id", "activity", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), "ord", *(F.lit("x").alias(c) for c in ("crop", "state", "season")))
    found = dict(rows(variants.variant_analysis(log), "case_id", "variant_key"))
    assert found["ab"] == found["ab!"] and len(set(found.values())) == 6


def test_no_window_over_all_rows_of_a_variant(spark, log):
    plan = variants.variant_counts(variants.variant_analysis(log))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_equal_hot_sequences_have_equal_digests(spark, rows):
    log = spark.range(200).select(
        F.concat(F.lit("c"), F.col("id") % 2).alias("case_id"),
        F.concat(F.lit("a"), F.floor(F.col("id") / 2) % 7).alias("activity"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / 2).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("id").alias("ord"), F.lit("x").alias("crop"), F.lit("y").alias("state"), F.lit("z").alias("season"),
    )
    found = rows(variants.variant_analysis(log, hot_events=30), "variant_key")
    assert len(found) == 2 and len(set(found)) == 1


def test_ranks_over_all_variants(long_log, rows):
    counts = variants.variant_counts(variants.variant_analysis(long_log))
    assert [r[0] for r in rows(variants.ranked_variants(counts), "rank")] == list(range(1, counts.count() + 1))


def test_properties_of_the_graph(long_log, rows):
    steps = dfg.transitions(long_log)
    metrics = cases.case_metrics(long_log)
    n_cases, n_events = metrics.count(), long_log.count()
    assert steps.agg(F.sum("n")).first()[0] == n_events
    assert dfg.edge_counts(steps).agg(F.sum("n")).first()[0] == n_events - n_cases
    totals = dfg.activity_totals(steps).agg(F.sum("n_start"), F.sum("n_end")).first()
    assert tuple(totals) == (n_cases, n_cases)
    assert metrics.where("loop_rate < 0 or loop_rate >= 1").count() == 0
    assert rows(steps) == rows(dfg.transitions(long_log.repartition(13).orderBy(F.desc("ord"))))


def test_variant_examples_and_share(spark, rows):
    table = spark.createDataFrame(
        [(i, "k1", "a -> b", 2, c) for i, c in enumerate(["z", "x", "y", "w", "x"])] + [(9, "k2", "a", 1, None)],
        "case_id int, variant_key string, opening string, n_steps long, crop string",
    )
    found = {r[0]: r for r in rows(variants.variant_counts(table))}
    assert found["k2"][1:4] == (1, "", 1)
    assert found["k1"][1:4] == (5, "w, x, y", 2)
    assert found["k1"][4] == pytest.approx(83.3333, abs=1e-3)
