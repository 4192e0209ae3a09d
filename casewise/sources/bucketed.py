"""Event logs stored by case: tables in buckets of the case id, sorted by (case, time, id).

What orders or groups the events of a case then reads buckets, without a shuffle. Cases too large for one task would make one
bucket large, so they are stored apart, not bucketed, and are ordered in chunks like any large case.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators.event_log import HOT_CASE_EVENTS
from casewise.operators.joins import split_join


@dataclass
class BucketedLog:
    """``name`` is the table of most cases; ``hot`` holds the events of the largest ones."""

    spark: SparkSession
    name: str
    folder: str
    hot_events: int
    has_hot: bool

    def cold(self) -> DataFrame:
        return self.spark.table(self.name)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.cold().schema).parquet(f"{self.folder}/hot")

    def each(self, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A function that works on whole cases, of all cases."""
        out = function(self.cold())
        return out.unionByName(function(self.hot())) if self.has_hot else out

    def drop(self) -> None:
        """The catalogue entry goes; the files stay in their folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def save_log(
    log: DataFrame, folder: str, n_buckets: int, hot_events: int = HOT_CASE_EVENTS, name: str | None = None
) -> BucketedLog:
    """Write ``log`` under ``folder`` and register it as ``name``.

    One task writes each bucket, so a bucket is one sorted file.
    """
    spark = log.sparkSession
    name = name or f"event_log_{uuid.uuid4().hex}"
    sizes = log.groupBy("case_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_events).select("case_id")
    sizes.write.mode("overwrite").parquet(f"{folder}/hot_cases")
    large = spark.read.schema(sizes.schema).parquet(f"{folder}/hot_cases")  # at most events / hot_events cases
    has_hot = not large.isEmpty()
    if has_hot:
        split_join(log, large, ["case_id"], "left_semi").select(*log.columns).write.mode("overwrite").parquet(f"{folder}/hot")
    cold = split_join(log, large, ["case_id"], "left_anti").select(*log.columns) if has_hot else log
    (
        cold.repartition(n_buckets, "case_id").sortWithinPartitions("case_id", "ts", "ord")
        .write.mode("overwrite").bucketBy(n_buckets, "case_id").sortBy("case_id", "ts", "ord")
        .option("path", f"{folder}/cold").saveAsTable(name)
    )
    return BucketedLog(spark, name, folder, hot_events, has_hot)
