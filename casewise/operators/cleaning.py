"""Cleaning and scoping of the call table.

Calls have the columns ``call_id, state, district, crop, category, query_type, question,
answer, created_on`` (``casewise.sources.tables`` maps other headers to them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.functions.text import has_script, strip
from casewise.operators.joins import lookup

TEXT_COLUMNS = ("question", "answer", "crop", "category", "query_type", "state", "district")
DEDUPE_KEYS = ("question", "answer", "district", "created_on")

# Results depend on them.
JUNK_ANSWERS = ("irrelevant call", "nan", "")
NON_ADVISORY = ("Government Schemes", "Training and Exposure Visits", "Crop Insurance")
DEVANAGARI = (0x0900, 0x097F)
MALAYALAM = (0x0D00, 0x0D7F)
MIN_TEXT = 3
RARE_ROWS = 5
RARE_LABEL = "Rare/Other"


def strip_columns(calls: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """P1."""
    return calls.withColumns({c: strip(F.col(c)) for c in columns})


def long_enough(column: str) -> Column:
    """More than three characters; null is not."""
    return F.coalesce(F.length(column) > MIN_TEXT, F.lit(False))


def real_answer(column: str = "answer") -> Column:
    """Not one of the junk answers; null is not."""
    return F.coalesce(~F.lower(column).isin(*JUNK_ANSWERS), F.lit(False))


def parse_date(calls: DataFrame, column: str = "created_on", formats: Sequence[str] = ()) -> DataFrame:
    """P4, DT1: text to timestamp, null where it cannot be read.

    ISO dates and times are understood; ``formats`` adds others, tried in order.
    """
    kind = calls.schema[column].dataType.simpleString()
    if kind.startswith("timestamp"):
        return calls
    readings = [F.try_to_timestamp(F.col(column), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return calls.withColumn(column, F.coalesce(F.col(column).try_cast("timestamp_ntz"), *readings))


def drop_duplicates(calls: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, ord_col: str = "call_id") -> DataFrame:
    """U4: the row with the lowest ``ord_col`` per key, nulls equal.

    ``row_number() = 1`` keeps one row per key and task before the shuffle, so a text that
    is repeated very often reaches its reducer as one row per task. The leading hash makes
    key comparisons cheap; the keys themselves decide.
    """
    order = Window.partitionBy("_key_hash", *keys).orderBy(ord_col)
    return (
        calls.withColumn("_key_hash", F.xxhash64(*keys))
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_key_hash", "_place")
    )


def basic_clean(calls: DataFrame, ord_col: str = "call_id", date_formats: Sequence[str] = ()) -> DataFrame:
    """P1-P4 and U4."""
    kept = strip_columns(calls).where(long_enough("question")).where(long_enough("answer")).where(real_answer())
    dated = parse_date(kept, formats=date_formats).where(F.col("created_on").isNotNull())
    return drop_duplicates(dated, ord_col=ord_col)


def advisory(column: str = "query_type", deny: Sequence[str] = NON_ADVISORY) -> Column:
    return ~F.coalesce(F.col(column).isin(*deny), F.lit(False))


def filter_to_advisory(calls: DataFrame, column: str = "query_type", deny: Sequence[str] = NON_ADVISORY) -> DataFrame:
    """P5: drop rows with a deny-listed label; rows without a label stay."""
    return calls.where(advisory(column, deny))


def readable(column: str = "answer", scripts: Sequence[tuple[int, int]] = (DEVANAGARI, MALAYALAM)) -> Column:
    if not scripts:
        return F.lit(True)
    return ~F.coalesce(has_script(F.col(column), scripts), F.lit(False))


def filter_scripts(
    calls: DataFrame, column: str = "answer", scripts: Sequence[tuple[int, int]] = (DEVANAGARI, MALAYALAM)
) -> DataFrame:
    """Drop rows whose text holds a character of the given scripts."""
    return calls.where(readable(column, scripts))


def in_scope(
    states: Sequence[str] | None = None,
    crops: Sequence[str] | None = None,
    districts: Sequence[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    columns: dict[str, str] | None = None,
) -> Column:
    """P7, DT2: all given filters; dates include both ends; an empty filter lets all pass."""
    names = {"state": "state", "crop": "crop", "district": "district", "date": "created_on"} | (columns or {})
    keep = F.lit(True)
    for key, values in (("state", states), ("crop", crops), ("district", districts)):
        if values:
            keep = keep & F.col(names[key]).isin(*values)
    if start_date:
        keep = keep & (F.col(names["date"]) >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        keep = keep & (F.col(names["date"]) <= F.lit(end_date).cast("timestamp_ntz"))
    return F.coalesce(keep, F.lit(False))


def scope(calls: DataFrame, **filters) -> DataFrame:
    """P7."""
    return calls.where(in_scope(**filters))


def merge_rare(
    df: DataFrame, column: str = "category", min_rows: int = RARE_ROWS, label: str = RARE_LABEL
) -> DataFrame:
    """Classes with fewer than ``min_rows`` rows become ``label``."""
    rare = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") < min_rows)
        .select(column, F.lit(True).alias("_rare"))
    )
    return (
        lookup(df, rare, [column])
        .withColumn(column, F.when(F.col("_rare"), label).otherwise(F.col(column)))
        .select(*df.columns)
    )


def cleaning_audit(
    calls: DataFrame,
    ord_col: str = "call_id",
    deny: Sequence[str] = NON_ADVISORY,
    scripts: Sequence[tuple[int, int]] = (DEVANAGARI, MALAYALAM),
    **scope_filters,
) -> DataFrame:
    """Rows in and out of each cleaning step, from one read of the table.

    Each row carries the number of the first text rule it fails. Rows that fail none are
    reduced to the first one per duplicate key, by a partial minimum rather than a sort,
    and only then tested for label, script and scope.
    """
    rows = parse_date(strip_columns(calls))
    failed = (
        F.when(~long_enough("question"), 1)
        .when(~long_enough("answer"), 2)
        .when(~real_answer(), 3)
        .when(F.col("created_on").isNull(), 4)
    )
    # two 64-bit hashes stand for the key texts, which need not travel to be counted
    whole = (F.xxhash64(*DEDUPE_KEYS), F.xxhash64(F.lit("second"), *DEDUPE_KEYS))
    keys = [F.when(failed.isNull(), h).alias(f"key{i}") for i, h in enumerate(whole)]
    flags = F.struct(
        F.col(ord_col).alias("ord"),
        advisory(deny=deny).alias("advisory"),
        readable(scripts=scripts).alias("readable"),
        in_scope(**scope_filters).alias("scoped"),
    )
    groups = rows.groupBy(failed.alias("failed"), *keys).agg(F.count(F.lit(1)).alias("n"), F.min(flags).alias("first"))
    ok = F.col("failed").isNull()
    upto = [F.sum(F.when(ok | (F.col("failed") > k), F.col("n")).otherwise(0)) for k in range(5)]
    after = [
        F.count_if(ok),
        F.count_if(ok & F.col("first.advisory")),
        F.count_if(ok & F.col("first.advisory") & F.col("first.readable")),
        F.count_if(ok & F.col("first.advisory") & F.col("first.readable") & F.col("first.scoped")),
    ]
    steps = ["question length", "answer length", "junk answer", "date", "duplicate", "advisory label", "script", "scope"]
    counts = [c.cast("long").alias(f"c{i}") for i, c in enumerate([*upto, *after])]
    out = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("step"),
                    F.lit(name).alias("rule"),
                    F.coalesce(f"c{i}", F.lit(0).cast("long")).alias("n_in"),
                    F.coalesce(f"c{i + 1}", F.lit(0).cast("long")).alias("n_out"),
                )
                for i, name in enumerate(steps)
            ]
        )
    )
    return groups.agg(*counts).select(out).withColumn(
        "pct_kept", F.when(F.col("n_in") > 0, F.col("n_out") * 100.0 / F.col("n_in"))
    )
