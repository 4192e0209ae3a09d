"""Joining a large table with a lookup table of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.session import durable

#: Lookup tables up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def split_join(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """A shuffled join in which a key with a large part of the rows is shared out.

    AQE splits a hot partition only when both inputs of the join are plain shuffles, which an
    aggregated table on its own key is not. The hash of the key as a second join key makes
    Spark shuffle both sides for this join.
    """
    hashed = F.xxhash64(*on)
    left, right = df.withColumn("_on", hashed), table.withColumn("_on", hashed)
    return left.join(right, ["_on", *on], how).drop("_on")


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", max_rows: int = BROADCAST_ROWS, stored: bool = False
) -> DataFrame:
    """Join ``table`` to ``df``, broadcasting it only after counting it.

    The table is materialised once, so counting it costs no second computation; ``stored`` says that it already is.
    """
    table = table if stored else durable(table)
    if table.count() <= max_rows:
        return df.join(F.broadcast(table), list(on), how)
    return split_join(df, table, on, how)
