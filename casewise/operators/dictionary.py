"""Vocabularies as tables: any number of terms, any number of vocabularies, none of them held by the driver.

A vocabulary is a *space*. Its terms are ranked by frequency; the rank is a dense number that comes from a range
partitioning and two levels of counts (place within the range, rows in the ranges before), so no task sees more than
its range. Terms are looked up by their 64-bit hash, in packed arrays sorted by hash, or by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.joins import lookup
from casewise.session import durable

_PLACE_BITS = 33  # of monotonically_increasing_id: the partition is above them


def numbered(df: DataFrame, *order: Column, name: str = "number") -> DataFrame:
    """Add the position of each row, from 0, in the given order, which must have no ties."""
    placed = durable(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _PLACE_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition, of which there are as many as the session has shuffle partitions
    offsets = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(F.broadcast(offsets.select("_part", "_before")), part == F.col("_part")).withColumn(
        name, F.col("_before") + place
    ).drop("_at", "_part", "_before")


def ranked_terms(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """The most frequent terms of each space, numbered by frequency, equal frequencies by term.

    ``stats`` is (space, term, cf, df), a stored table, as it is read twice; ``limits`` has one row for each space: n_docs,
    max_features, min_df. Result: space, term, hash, idx, cf, df, idf = ln((1+N)/(1+df)) + 1.
    """
    limits = durable(limits)
    kept = lookup(stats, limits, ["space"], "inner", stored=True).where(F.col("df") >= F.col("min_df"))
    # the frequency at which a space is full: terms below it need no rank
    higher = Window.partitionBy("space").orderBy(F.desc("cf"))
    full = kept.groupBy("space", "cf", "max_features").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "above", F.sum("n").over(higher) - F.col("n")
    ).where(F.col("above") < F.col("max_features")).groupBy("space").agg(F.min("cf").alias("least"))
    kept = durable(lookup(kept, full, ["space"], "inner").where(F.col("cf") >= F.col("least")).drop("least"))
    ranks = numbered(kept, F.asc("space"), F.desc("cf"), F.asc("term"))
    first = ranks.groupBy("space").agg(F.min("number").alias("first"))
    return lookup(ranks, first, ["space"], "inner").withColumn("idx", F.col("number") - F.col("first")).where(
        F.col("idx") < F.col("max_features")
    ).select(
        "space", "term", F.xxhash64("term").alias("hash"), F.col("idx").cast("int").alias("idx"), "cf", "df",
        (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"),
    )


def packed_terms(terms: DataFrame) -> DataFrame:
    """(space, hashes, idx, idf): the terms of each space in the order of their hashes; a space is bounded by its limit."""
    both = F.sort_array(F.collect_list(F.struct("hash", "idx", "idf")))
    return terms.groupBy("space").agg(both.alias("t")).select(
        "space", F.col("t.hash").alias("hashes"), F.col("t.idx").alias("idx"), F.col("t.idf").alias("idf")
    )


@dataclass
class Sparse:
    """Rows of unit length: how many terms each has, their numbers in order, and their weights."""

    counts: np.ndarray
    idx: np.ndarray
    weights: np.ndarray

    def rows(self, at: np.ndarray) -> Sparse:
        starts = np.cumsum(self.counts) - self.counts
        own = self.counts[at]
        flat = np.repeat(starts[at], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        return Sparse(own, self.idx[flat], self.weights[flat])


def weighted(flat: np.ndarray, counts: np.ndarray, hashes: np.ndarray, idx: np.ndarray, idf: np.ndarray) -> Sparse:
    """Rows of hashed terms as unit vectors of (1 + ln tf) * idf over the space's terms."""
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(hashes) or not len(flat):
        return Sparse(np.zeros(len(counts), np.int64), np.zeros(0, np.int64), np.zeros(0))
    place = np.minimum(np.searchsorted(hashes, flat), len(hashes) - 1)
    known = hashes[place] == flat
    cell, tf = np.unique(row[known] * np.int64(len(hashes)) + idx[place[known]], return_counts=True)
    row, term = cell // len(hashes), cell % len(hashes)
    by_idx = np.empty(len(hashes))
    by_idx[idx] = idf
    raw = (1 + np.log(tf)) * by_idx[term]
    length = np.sqrt(np.bincount(row, raw * raw, len(counts)))
    return Sparse(np.bincount(row, minlength=len(counts)), term, raw / length[row])
