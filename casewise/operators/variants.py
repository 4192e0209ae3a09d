"""Variants: the activity sequence of a case, its frequency and its coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.event_log import HOT_CASE_EVENTS, sequence_events
from casewise.operators.joins import split_join
from casewise.session import durable

ARROW = " -> "

#: Activities in the opening of a sequence, by which variants of equal frequency are ordered and shown.
OPENING_STEPS = 100


def variant_analysis(log: DataFrame, hot_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """A3: per case the key and the opening of its activity sequence, its steps, first crop and state, modal season.

    ``variant_key`` stands for the whole sequence: 128 bits that are equal for equal sequences.
    ``opening`` is its first ``OPENING_STEPS`` activities joined by an arrow; ``sequences`` and
    ``variant_parts`` give all of it. The key is a sum without order over hashes of (step,
    activity), so the events of a case of any size are added up by many tasks. The season
    ignores nulls and takes the lowest value on a tie. ``hot_events`` changes the plan only.
    """
    used = log.select("case_id", "activity", "ts", "ord", "crop", "state", "season")
    step = F.col("step").cast("long")
    opening = F.when(F.col("step") <= OPENING_STEPS, F.struct("step", "activity"))
    by_season = sequence_events(used, hot_events=hot_events).groupBy("case_id", "season").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(step, "activity")).alias("high"),
        F.bit_xor(F.xxhash64(F.lit("low"), "activity", step)).alias("low"),
        F.min(F.struct("ts", "ord", "crop", "state")).alias("first"),
        F.collect_list(opening).alias("opening"),
    )
    modal = F.when(F.col("season").isNotNull(), F.struct(-F.col("n"), "season"))
    whole = by_season.groupBy("case_id").agg(
        F.sum("n").alias("n_steps"),
        F.bit_xor("high").alias("high"),
        F.bit_xor("low").alias("low"),
        F.min("first").alias("first"),
        F.min_by("season", modal).alias("season"),
        F.sort_array(F.flatten(F.collect_list("opening"))).alias("opening"),
    )
    return whole.select(
        "case_id",
        F.lower(F.concat(*(F.lpad(F.hex(part), 16, "0") for part in ("high", "low")))).alias("variant_key"),
        F.array_join(F.col("opening.activity"), ARROW).alias("opening"),
        "n_steps",
        F.col("first.crop").alias("crop"),
        F.col("first.state").alias("state"),
        "season",
    )


def variant_parts(log: DataFrame, part_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """The whole sequence of every case in rows of at most ``part_events`` activities."""
    ordered = sequence_events(log.select("case_id", "activity", "ts", "ord"), hot_events=part_events)
    part = F.floor((F.col("step") - 1) / part_events).cast("long")
    return (
        ordered.groupBy("case_id", part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("step", "activity"))).alias("events"))
        .select(
            "case_id",
            "part",
            F.size("events").cast("long").alias("n_steps"),
            F.array_join(F.col("events.activity"), ARROW).alias("text"),
        )
    )


def sequences(log: DataFrame, hot_events: int = HOT_CASE_EVENTS) -> DataFrame:
    """The whole sequence of every case as one text: case_id, variant.

    For cases that are shown: a text is one value, which Spark bounds at 2 GB; longer sequences
    are read from ``variant_parts``.
    """
    parts = variant_parts(log, hot_events).groupBy("case_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts")
    )
    return parts.select("case_id", F.array_join(F.col("parts.text"), ARROW).alias("variant"))


def with_sequences(table: DataFrame, log: DataFrame, case_col: str = "example_case") -> DataFrame:
    """``table`` with ``variant``, the whole sequence of the case in ``case_col``; only these cases are read."""
    shown = table.select(F.col(case_col).alias("case_id")).distinct()
    texts = sequences(split_join(log, shown, ["case_id"], "left_semi"))
    return table.join(texts.withColumnRenamed("case_id", case_col), case_col)


def variant_counts(variants: DataFrame) -> DataFrame:
    """Per variant its cases, three example crops, steps, share of all cases, opening and an example case.

    Counts are partial aggregates, and a task passes on three crops of a variant at most, so a
    variant that very many cases share is no hot key. Reads ``variants`` three times: store it.
    """
    place = Window.partitionBy("variant_key").orderBy("crop")
    crops = variants.where(F.col("crop").isNotNull()).select("variant_key", "crop").distinct()
    examples = (
        crops.withColumn("place", F.row_number().over(place))
        .where("place <= 3")
        .groupBy("variant_key")
        .agg(F.array_join(F.sort_array(F.collect_list("crop")), ", ").alias("example_crops"))
    )
    counts = variants.groupBy("variant_key").agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.min("n_steps").alias("n_steps"),
        F.min("opening").alias("opening"),
        F.min("case_id").alias("example_case"),
    )
    total = variants.agg(F.count(F.lit(1))).scalar()
    return counts.join(examples, "variant_key", "left").select(
        "variant_key",
        "n_cases",
        F.coalesce("example_crops", F.lit("")).alias("example_crops"),
        "n_steps",
        (F.col("n_cases") * 100.0 / total).alias("pct_of_cases"),
        "opening",
        "example_case",
    )


def by_frequency() -> list[Column]:
    """Most frequent first, ties by the opening, then by the key."""
    return [F.desc("n_cases"), F.asc("opening"), F.asc("variant_key")]


def top_variants(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent variants with their rank; the rank is over ``k`` rows."""
    top = counts.orderBy(*by_frequency()).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*by_frequency())))


def ranked_variants(counts: DataFrame) -> DataFrame:
    """W5 over all variants: a global rank without a one-task window.

    The sorted rows are materialised once; each row's position in its partition plus the
    rows in the partitions before it is its rank. The offsets are one row per partition.
    """
    placed = durable(
        counts.orderBy(*by_frequency()).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("chunk", F.shiftright("place", 33))
    chunks = placed.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_chunk = F.col("place") - F.shiftleft("chunk", 33)
    return placed.join(F.broadcast(offsets), "chunk").select(
        *counts.columns, (F.col("offset") + in_chunk + 1).alias("rank")
    )


def filter_top_variants(log: DataFrame, variants: DataFrame, k: int) -> DataFrame:
    """The events of the cases that follow one of the ``k`` most frequent variants."""
    top = (
        variants.groupBy("variant_key").agg(F.count(F.lit(1)).alias("n_cases"), F.min("opening").alias("opening"))
        .orderBy(*by_frequency()).limit(k).select("variant_key")
    )
    cases = variants.join(F.broadcast(top), "variant_key", "left_semi").select("case_id")
    return split_join(log, cases, ["case_id"], "left_semi")


def variant_coverage(counts: DataFrame, k: int) -> DataFrame:
    """Share of the cases that the ``k`` most frequent variants account for."""
    top = counts.orderBy(F.desc("n_cases"), "variant_key").limit(k).agg(
        F.count(F.lit(1)).alias("n_variants"), F.sum("n_cases").alias("cases_kept")
    )
    total = counts.agg(F.sum("n_cases")).scalar()
    return top.select(
        "n_variants", "cases_kept", total.alias("cases_total"), (F.col("cases_kept") / total).alias("coverage")
    )
