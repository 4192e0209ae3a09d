"""Exact top-k search by inner product over dense vectors, in blocks that the triangle inequality lets a search skip.

With one more component, sqrt(longest^2 - |x|^2), all rows have the same length, and a larger inner product with a query
(whose added component is zero) is a smaller distance. Each row belongs to its nearest pivot and knows its distance to it;
rows of a pivot in the order of that distance form blocks with a lowest and a highest distance. A query at distance d of
the pivot is at least max(lowest - d, d - highest) away from all rows of a block, which bounds their inner products from
above, so a block is scored only for the queries that it can still improve. The first k-th best similarity of each query
comes from the pivots' sample, whose rows are rows of the corpus.

Pivots and the sample are bounded; they decide how much is skipped, never what is found. Similarities are those of
``top_k``, rounded alike, with the lower id first among equal ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.operators.topk import DIGITS, MAX_QUERIES, _arrow, _best, _lists

#: Rows of the sample, pivots and rows of a block at most.
SAMPLE, PIVOTS, BLOCK = 4096, 256, 512
#: Room for rounding in distances, relative to the longest vector.
SLACK = 1e-7


def _matrix(column) -> np.ndarray:
    values, lengths = _lists(column)
    return values.astype(np.float64).reshape(len(lengths), -1) if len(lengths) else np.zeros((0, 0))


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    """Rows by pivots, the added component included."""
    squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T + (extra[:, None] - pivot_extra) ** 2
    return np.sqrt(np.maximum(squares, 0))


def _spread_out(sample: np.ndarray, extra: np.ndarray, n: int) -> np.ndarray:
    """Rows of the sample that are far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    far = _distances(sample, extra, sample[:1], extra[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(sample, extra, sample[chosen[-1:]], extra[chosen[-1:]])[:, 0])
    return np.array(chosen)


@dataclass
class PivotIndex:
    spark: SparkSession
    folder: str
    longest: float
    sample: np.ndarray
    pivots: np.ndarray
    pivot_extra: np.ndarray

    def _blocks(self) -> DataFrame:
        return self.spark.read.parquet(self.folder)

    def n_blocks(self) -> int:
        return self._blocks().count()

    def top_k(self, queries: DataFrame, k: int, most: int = MAX_QUERIES) -> DataFrame:
        """(query_id, id, similarity, rank) for queries (id, values)."""
        found = self._found(queries, k, most).drop("n_scored")
        order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
        return found.where("query_id IS NOT NULL").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def n_scored(self, queries: DataFrame, k: int) -> int:
        """How many pairs of a query and a block are scored: of all ``n_blocks() * queries``."""
        return self._found(queries, k, MAX_QUERIES).agg(F.sum("n_scored")).first()[0] or 0

    def _found(self, queries: DataFrame, k: int, most: int) -> DataFrame:
        queries = queries.select("id", "values").where(F.col("values").isNotNull())
        slices = max(1, math.ceil(queries.count() / most))
        parts = [self._part(queries.where(F.pmod(F.xxhash64("id"), F.lit(slices)) == i), k) for i in range(slices)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _part(self, queries: DataFrame, k: int) -> DataFrame:
        held = queries.toArrow()  # a slice of the queries of bounded size
        id_type = self._blocks().schema["ids"].dataType.elementType.simpleString()
        query_type = queries.schema["id"].dataType.simpleString()
        schema = pa.schema([("query_id", _arrow(query_type)), ("id", _arrow(id_type)), ("similarity", pa.float64()), ("n_scored", pa.int64())])
        asked = _matrix(held.column("values"))
        if not len(asked) or not len(self.sample):
            return self.spark.createDataFrame(schema.empty_table())
        first = np.round(asked @ self.sample.T, DIGITS)
        floor = np.partition(first, -k, axis=1)[:, -k] if first.shape[1] >= k else np.full(len(asked), -np.inf)
        shared = self.spark.sparkContext.broadcast((held.column("id").to_pandas(), asked, floor))
        longest, pivots, pivot_extra = self.longest, self.pivots, self.pivot_extra

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, asked, floor = shared.value
            floor, best, n_scored = floor.copy(), None, 0
            near = _distances(asked, np.zeros(len(asked)), pivots, pivot_extra)
            square = (asked * asked).sum(1) + longest**2
            for batch in batches:
                pivot, low, high = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "low", "high"))
                room = SLACK * (longest + np.sqrt(square).max())
                apart = np.maximum(low[None, :] - near[:, pivot], near[:, pivot] - high[None, :]) - room
                above = (square[:, None] - np.maximum(apart, 0) ** 2) / 2 + room  # no row of the block is more similar
                for b in np.argsort(-above.max(0)):
                    asks = np.flatnonzero(above[:, b] >= floor)
                    if not len(asks):
                        continue
                    n_scored += len(asks)
                    own = np.array(batch.column("ids")[int(b)].as_py(), object)
                    rows = np.frombuffer(batch.column("values")[int(b)].as_py(), np.float64).reshape(len(own), -1)
                    sims = np.round(rows @ asked[asks].T, DIGITS)
                    row, query = np.nonzero(sims >= floor[asks])
                    found = pd.DataFrame({
                        "query_id": ids.to_numpy()[asks[query]], "id": own[row], "similarity": sims[row, query], "_q": asks[query],
                    })
                    best = _best(found if best is None else pd.concat([best, found]), k)
                    full = best.groupby("_q")["similarity"].agg(["size", "min"])
                    full = full[full["size"] >= k]
                    at = full.index.to_numpy(dtype="int64")
                    floor[at] = np.maximum(floor[at], full["min"].to_numpy())
            if best is not None:
                yield pa.RecordBatch.from_pandas(best.drop(columns="_q").assign(n_scored=0), schema, preserve_index=False)
            yield pa.RecordBatch.from_pydict({"query_id": [None], "id": [None], "similarity": [None], "n_scored": [n_scored]}, schema)

        fields = f"query_id {query_type}, id {id_type}, similarity double, n_scored bigint"
        return self._blocks().mapInArrow(run, fields)


def build(corpus: DataFrame, folder: str, n_pivots: int = PIVOTS, block: int = BLOCK) -> PivotIndex:
    """Write the rows (id, values) as blocks of their nearest pivots; null vectors are left out, all others have one length."""
    spark = corpus.sparkSession
    rows = corpus.select("id", F.col("values").cast("array<double>").alias("values")).where(F.col("values").isNotNull())
    square = F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x * x)
    longest = math.sqrt(rows.agg(F.max(square)).first()[0] or 0.0)
    # any sample is right; this one is spread by a hash of the id
    sample = _matrix(rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("values").toArrow().column("values"))
    extra = np.sqrt(np.maximum(longest**2 - (sample * sample).sum(1), 0)) if len(sample) else np.zeros(0)
    chosen = _spread_out(sample, extra, n_pivots) if len(sample) else np.zeros(0, int)
    pivots, pivot_extra = sample[chosen], extra[chosen]
    shared = spark.sparkContext.broadcast((pivots, pivot_extra))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, pivot_extra = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("values"))
                own = _distances(x, np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0)), pivots, pivot_extra)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own.argmin(1), pa.int32()), pa.array(own.min(1))], ["id", "values", "pivot", "distance"]
                )

    id_type = rows.schema["id"].dataType.simpleString()
    placed = rows.mapInArrow(nearest, f"id {id_type}, values array<double>, pivot int, distance double")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # in the order of pivot and distance
            pivot = batch.column("pivot").to_numpy()
            cuts = np.flatnonzero(np.diff(pivot, prepend=-1))
            for low, high in zip(cuts, [*cuts[1:], len(pivot)]):
                for at in range(low, high, block):
                    part = batch.slice(at, min(block, high - at))
                    distance = part.column("distance").to_numpy()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([pivot[at]], pa.int32()), pa.array([distance.min()]), pa.array([distance.max()]),
                        pa.array([part.column("id").to_pylist()], pa.list_(_arrow(id_type))),
                        pa.array([np.ascontiguousarray(_matrix(part.column("values"))).tobytes()], pa.binary()),
                    ], ["pivot", "low", "high", "ids", "values"])

    # ranges of (pivot, distance): a pivot with many rows is shared out
    ordered = placed.repartitionByRange("pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
    ordered.mapInArrow(packed, f"pivot int, low double, high double, ids array<{id_type}>, values binary").write.mode("overwrite").parquet(folder)
    return PivotIndex(spark, folder, longest, sample, pivots, pivot_extra)
