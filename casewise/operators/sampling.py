"""Deterministic sampling: by the hash of an id, so the same rows whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.joins import lookup
from casewise.session import durable

#: Spark keeps at most this many rows per group before a shuffle (windowGroupLimitThreshold)
GROUP_LIMIT = 1_000

GOLD_COLUMNS = ("state", "district", "crop", "season", "question", "answer", "category", "query_type")


def draw_key(id_col: str, seed: int) -> Column:
    """The order in which ids are drawn."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def take_by_hash(df: DataFrame, quotas: DataFrame, stratum: str, id_col: str, seed: int) -> DataFrame:
    """Add ``taken``: the ``quota`` rows per stratum whose draw key is lowest.

    A histogram over 65,536 hash ranges per stratum finds the range in which the quota ends.
    Rows below it are taken and rows above it are not, without any ordering; only the rows
    inside that one range are ranked. A stratum with a third of all rows needs no task to
    see more than its 65,536th part.
    """
    # a null stratum is a stratum like any other
    coded = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))
    quotas = quotas.select(coded.alias("_stratum"), "quota")
    keyed = df.withColumns({"_stratum": coded, "_draw": draw_key(id_col, seed)}).withColumn(
        "_range", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int")
    )
    upto = Window.partitionBy("_stratum").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        keyed.groupBy("_stratum", "_range").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .join(quotas, "_stratum")
        .where(F.col("upto") >= F.col("quota"))
        .groupBy("_stratum")
        .agg(
            F.min("_range").alias("_last"),
            F.min_by(F.col("quota") - (F.col("upto") - F.col("n")), "_range").alias("_need"),
        )
    )
    # a stratum with fewer rows than its quota has no last range: all its rows are taken
    marked = lookup(keyed, filled, ["_stratum"])
    inside = F.col("_range") == F.col("_last")
    sure = marked.where(~F.coalesce(inside, F.lit(False))).withColumn(
        "taken", F.coalesce(F.col("_range") < F.col("_last"), F.lit(True))
    )
    ranked = Window.partitionBy("_stratum", "_range").orderBy("_draw", id_col)
    edge = marked.where(inside).withColumn("taken", F.row_number().over(ranked) <= F.col("_need"))
    return sure.unionByName(edge).select(*df.columns, "taken")


def lowest_per_stratum(df: DataFrame, k: int, stratum: str, id_col: str, seed: int) -> DataFrame:
    """The ``k`` rows of each stratum that are drawn first, with ``_draw`` and ``_place``.

    Up to the optimizer's group limit, every task keeps its own ``k`` rows per stratum before
    the shuffle; a larger ``k`` is cut by the hash histogram first.
    """
    keyed = df.withColumn("_draw", draw_key(id_col, seed))
    if k > GROUP_LIMIT:
        quotas = df.groupBy(stratum).agg(F.lit(k).alias("quota"))
        keyed = take_by_hash(keyed, quotas, stratum, id_col, seed).where("taken").drop("taken")
        chunks = F.substring("_draw", 1, 4)
        before = Window.partitionBy(stratum).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = keyed.groupBy(stratum, chunks.alias("_chunk")).agg(F.count(F.lit(1)).alias("_n")).select(
            stratum, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )
        inside = Window.partitionBy(stratum, "_chunk").orderBy("_draw", id_col)
        ranked = keyed.withColumn("_chunk", chunks).withColumn("_place", F.row_number().over(inside))
        return ranked.join(offsets, [stratum, "_chunk"]).withColumn(
            "_place", F.col("_place") + F.col("_offset")
        ).drop("_chunk", "_offset")
    order = Window.partitionBy(stratum).orderBy("_draw", id_col)
    return keyed.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)


def sample_gold(
    calls: DataFrame,
    n: int = 100,
    seed: int = 42,
    id_col: str = "call_id",
    stratum: str = "category",
    columns: Sequence[str] = GOLD_COLUMNS,
    labels: Sequence[str] = ("category", "query_type"),
) -> DataFrame:
    """U6, U2, JN6: an equal number from each category, topped up from the rest to ``n``.

    With more categories than ``n`` the sample has one row of each and so exceeds ``n``.
    Labels are copied to ``*_verified`` as a starting point; signal and notes are empty.

    A stratum can give no more than its share and the whole top-up, so that many of its rows
    are enough to choose from, and the sample needs one read of the table.
    """
    named = calls.where(F.col(stratum).isNotNull())
    sizes = durable(named.groupBy(stratum).agg(F.count(F.lit(1)).alias("size")))
    per_stratum = max(1, n // max(1, sizes.count()))
    short = max(0, n - (sizes.agg(F.sum(F.least("size", F.lit(per_stratum)))).first()[0] or 0))
    drawn = durable(lowest_per_stratum(named, per_stratum + short, stratum, id_col, seed))
    sample = drawn.where(F.col("_place") <= per_stratum)
    if short > 0:
        # rows without a category belong to no stratum but can be drawn for the top-up
        unnamed = calls.where(F.col(stratum).isNull()).withColumns(
            {"_draw": draw_key(id_col, seed), "_place": F.lit(None).cast("int")}
        )
        rest = drawn.where(F.col("_place") > per_stratum).unionByName(unnamed)
        sample = sample.unionByName(rest.orderBy("_draw", id_col).limit(short))
    return sample.select(
        id_col,
        *columns,
        *[F.col(c).alias(f"{c}_verified") for c in labels],
        F.lit("").alias("resolution_signal_verified"),
        F.lit("").alias("notes"),
    )


def merge_gold(labelled: DataFrame) -> DataFrame:
    """Verified labels replace the noisy ones; notes are dropped."""
    verified = [c for c in labelled.columns if c.endswith("_verified")]
    names = {c: c.removesuffix("_verified") for c in verified}
    noisy = [c for c in labelled.columns if c in names.values()]
    return labelled.drop("notes", *noisy).withColumnsRenamed(names)


def blank_signals(labelled: DataFrame, column: str = "resolution_signal_verified") -> DataFrame:
    """One row with the number of rows and of rows whose signal is still blank."""
    blank = F.col(column).isNull() | (F.col(column) == "")
    return labelled.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_blank"))


def split_sizes(df: DataFrame, stratum: str, test_fraction: float = 0.2) -> DataFrame:
    """U8: per stratum its size, train and test rows.

    The test part has ``ceil(fraction * n)`` rows; the train rows are shared out by largest
    remainder, ties by stratum. The one-task window is over strata, not over rows.
    """
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    n_train = total - F.ceil(total * F.lit(test_fraction))
    share = sizes.withColumn("n_train_all", n_train).withColumn("n_all", total).withColumn(
        "whole", F.floor(F.col("n_train_all") * F.col("size") / F.col("n_all"))
    ).withColumn("left_over", F.col("n_train_all") * F.col("size") % F.col("n_all"))
    everything = Window.partitionBy(F.lit(1))
    ranked = share.withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("left_over"), stratum))
    ).withColumn("missing", F.col("n_train_all") - F.sum("whole").over(everything))
    train = F.col("whole") + F.when(F.col("place") <= F.col("missing"), 1).otherwise(0)
    return ranked.select(
        stratum, "size", train.alias("n_train"), (F.col("size") - train).alias("n_test")
    )


def stratified_split(
    df: DataFrame, stratum: str, id_col: str, test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """U8: (train, test) with the class shares of the whole."""
    quotas = split_sizes(df, stratum, test_fraction).select(stratum, F.col("n_test").alias("quota"))
    drawn = take_by_hash(df, quotas, stratum, id_col, seed)
    return drawn.where(~F.col("taken")).drop("taken"), drawn.where("taken").drop("taken")
