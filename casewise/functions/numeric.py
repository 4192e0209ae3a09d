"""Numeric expressions: margins to confidences, sparse and dense products, verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewise.functions.text import let


def softmax_at(scores: Column, place: Column) -> Column:
    """M2: softmax of an array, shifted by its maximum, at a zero-based place."""
    shifted = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return let(shifted, lambda e: F.get(e, place) / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))


def sigmoid(margin: Column) -> Column:
    """M3."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def dense_dot(a: Column, b: Column) -> Column:
    """M4: inner product of two arrays, summed in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def sparse_dot(ai: Column, aw: Column, bi: Column, bw: Column) -> Column:
    """M4: inner product of two sparse vectors given as index and weight arrays."""
    return F.aggregate(
        F.array_intersect(ai, bi),
        F.lit(0.0),
        lambda acc, t: acc
        + F.get(aw, (F.array_position(ai, t) - 1).cast("int")) * F.get(bw, (F.array_position(bi, t) - 1).cast("int")),
    )


def winner(a: Column, b: Column, a_name: str, b_name: str) -> Column:
    """M8: the name of the larger value, "Tie" when equal."""
    return F.when(a > b, a_name).when(a < b, b_name).otherwise("Tie")


def pearson(x: str, y: str) -> Column:
    """Correlation as an aggregate; null where a side does not vary, also in ANSI mode."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_verdict(corr: Column) -> Column:
    """Together, weak, opposite; undefined without a correlation."""
    return (
        F.when(corr.isNull() | F.isnan(corr), "undefined")
        .when(corr >= 0.3, "together")
        .when(corr <= -0.3, "opposite")
        .otherwise("weak")
    )
