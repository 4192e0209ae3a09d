"""Classification quality, agreement of repeated runs and table alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts per (true, predicted) pair; every metric is computed from this table."""
    return df.groupBy(F.col(truth).alias("true_label"), F.col(predicted).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class(pairs: DataFrame) -> DataFrame:
    """M7: precision, recall, F1 and support per label; the labels are true or predicted ones.

    A zero denominator gives 0.
    """
    hit = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("true_label").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("n_pred"), hit.alias("tp")),
                F.struct(F.col("pred_label").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("n_pred"), F.lit(0).cast("long").alias("tp")),
            )
        )
    )
    totals = both.where(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("n_pred").alias("n_pred"), F.sum("tp").alias("tp")
    )

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp = F.col("tp")
    return totals.select(
        "label",
        ratio(tp, F.col("n_pred")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("n_pred") + F.col("support")).alias("f1"),
        "support",
        tp.alias("n_correct"),
    )


def scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row with accuracy, macro and weighted averages."""
    return summary(per_class(confusion(df, truth, predicted)))


def summary(report: DataFrame) -> DataFrame:
    """M7: the averages over a ``per_class`` report."""
    support = F.sum("support")

    def weighted(name):
        return (F.sum(F.col(name) * F.col("support")) / support).alias(f"weighted_{name}")

    return report.agg(
        support.alias("n"),
        (F.sum("n_correct") / support).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """L2: balanced weight per class, rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    total_rows, classes = totals.select("rows").scalar(), totals.select("classes").scalar()
    return sizes.select(label, "n", (total_rows / (classes * F.col("n"))).alias("weight"))


def vote_agreement(votes: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """M9: per field, the share of the most frequent value per record, averaged over records.

    ``votes`` holds one row per record and repeat.
    """
    long = votes.select(
        F.col(id_col).alias("record"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])),
    )
    return (
        long.groupBy("field", "record", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("field", "record")
        .agg((F.max("n") / F.sum("n")).alias("agreement"), F.sum("n").alias("n_repeats"))
        .groupBy("field")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.max("n_repeats").alias("n_repeats"),
            F.avg("agreement").alias("mean_agreement"),
        )
    )


def align(gold: DataFrame, extracted: DataFrame, id_col: str) -> DataFrame:
    """JN4: gold rows with an extraction of the same id, columns prefixed by their side."""
    left = gold.withColumnsRenamed({c: f"gold_{c}" for c in gold.columns if c != id_col})
    right = extracted.withColumnsRenamed({c: f"ext_{c}" for c in extracted.columns if c != id_col})
    return left.join(right, id_col, "inner")


def align_audit(gold: DataFrame, extracted: DataFrame, id_col: str) -> DataFrame:
    """JN4: rows on both sides, matched pairs, gold rows without a partner."""
    left = gold.groupBy(id_col).agg(F.count(F.lit(1)).alias("g"))
    right = extracted.groupBy(id_col).agg(F.count(F.lit(1)).alias("e"))
    g, e = F.coalesce("g", F.lit(0)), F.coalesce("e", F.lit(0))
    return left.join(right, id_col, "full").agg(
        F.sum(g).alias("n_gold"),
        F.sum(e).alias("n_extracted"),
        F.sum(g * e).alias("n_matched"),
        F.sum(F.when(e == 0, g).otherwise(0)).alias("n_dropped"),
    )


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JN5: one row with the number of nulls in each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JN5: the same DataFrame, or an error naming the columns that hold nulls."""
    blank = {c: n for c, n in missing_values(df, columns).first().asDict().items() if n}
    if blank:
        raise ValueError(f"blank values, fill in every row before scoring: {blank}")
    return df
