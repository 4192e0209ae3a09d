"""Exact top-k by inner product, for sparse and dense vectors.

Queries up to ``MAX_QUERIES`` rows travel with the tasks: every task scores its part of the
corpus against all of them with numpy and hands on only its own k best per query, so the
shuffle carries k rows per query and task and no pair table ever exists. Beyond the bound
both sides are cut into blocks by hash, every pair of blocks is one group of fixed size,
and each group again emits only its k best.

Similarities are rounded to nine places before they are compared, so that equal vectors tie
exactly and the lower id wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_QUERIES = 5_000
BLOCK_ROWS = 20_000
MAX_TASKS = 10_000
DIGITS = 9
#: products held at a time while a batch is scored
WORK = 4_000_000


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """An arrow list column as (flat values, list lengths)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0)
    return column.flatten().to_numpy(zero_copy_only=False), lengths.to_numpy(zero_copy_only=False)


class SparseBlock:
    """Queries as postings: for every term the queries that have it."""

    def __init__(self, table: pa.Table):
        terms, lengths = _lists(table.column("indices"))
        weights, _ = _lists(table.column("weights"))
        self.ids = table.column("id").to_pandas()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(terms, kind="stable")
        self.owner, self.weights = owner[order], weights[order]
        self.terms, self.starts, self.counts = np.unique(terms[order], return_index=True, return_counts=True)

    def score(self, part) -> Iterator[tuple[int, np.ndarray]]:
        """Yield (first row, similarities rows x queries) for slices of an arrow batch."""
        terms, lengths = _lists(part.column("indices"))
        weights, _ = _lists(part.column("weights"))
        rows, width = len(lengths), len(self.ids)
        if not len(self.terms) or not len(terms):
            return
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[place] == terms
        fan_out = np.where(known, self.counts[place], 0)
        ends = np.cumsum(lengths)
        work = np.concatenate([[0], np.cumsum(fan_out)])[np.concatenate([[0], ends])]
        first = 0
        while first < rows:
            limit = max(1, WORK // max(width, 1))
            last = int(np.searchsorted(work, work[first] + WORK, side="right")) - 1
            last = min(max(last, first + 1), first + limit, rows)
            lo, hi = (ends[first - 1] if first else 0), ends[last - 1]
            n = fan_out[lo:hi]
            row = np.repeat(np.arange(last - first), lengths[first:last])
            at = np.repeat(self.starts[place[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            product = np.repeat(weights[lo:hi], n) * self.weights[at]
            flat = np.bincount(np.repeat(row, n) * width + self.owner[at], product, (last - first) * width)
            yield first, flat.reshape(last - first, width)
            first = last

    keep_zero = False


class DenseBlock:
    """Queries as one matrix."""

    def __init__(self, table: pa.Table):
        values, lengths = _lists(table.column("values"))
        self.ids = table.column("id").to_pandas()
        self.matrix = values.astype("float64").reshape(len(lengths), -1)

    def score(self, part) -> Iterator[tuple[int, np.ndarray]]:
        values, lengths = _lists(part.column("values"))
        if not len(lengths):
            return
        matrix = values.astype("float64").reshape(len(lengths), -1)
        step = max(1, WORK // max(len(self.ids), 1))
        for first in range(0, len(lengths), step):
            yield first, matrix[first : first + step] @ self.matrix.T

    keep_zero = True


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["query_id", "similarity", "id"], ascending=[True, False, True])
    return ordered.groupby("query_id", sort=False).head(k)


def _raised(floor: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """The least similarity that still counts, from the k-th best of each query among these rows; nan is no similarity."""
    open_ = np.flatnonzero(np.isneginf(floor))
    if len(sims) < k or not len(open_):
        return floor
    kth = -np.partition(-sims[:, open_], k - 1, axis=0)[k - 1]
    out = floor.copy()
    out[open_] = np.where(np.isnan(kth), -np.inf, np.round(kth, DIGITS))
    return out


def _k_best(block, parts, k: int, skip_self: bool) -> pd.DataFrame:
    """The k best rows per query over all ``parts``, holding only the best so far.

    Cells below a query's floor, in the first rows as in later ones, are dropped as numbers; only the others become rows.
    """
    best = None
    floor = np.full(len(block.ids), -np.inf)
    for part in parts:
        ids = part.column("id").to_pandas()
        for first, sims in block.score(part):
            # a row's own query is no match and must not raise the floor
            least = floor if skip_self else _raised(floor, sims, k)
            keep = sims >= least - 10.0**-DIGITS
            if not block.keep_zero:
                keep &= sims > 0
            row, query = np.nonzero(keep)
            similarity = np.round(sims[row, query], DIGITS)
            keep = similarity >= least[query]
            if not block.keep_zero:
                keep &= similarity > 0
            row, query = row[keep], query[keep]
            if best is not None and not len(row):
                continue
            found = pd.DataFrame(
                {
                    "query_id": block.ids.to_numpy()[query],
                    "id": ids.to_numpy()[first + row],
                    "similarity": similarity[keep],
                    "_q": query,
                }
            )
            if skip_self:
                found = found[found["query_id"] != found["id"]]
            best = _best(found if best is None else pd.concat([best, found]), k)
            full = best.groupby("_q")["similarity"].agg(["size", "min"])
            full = full[full["size"] >= k]
            floor[full.index.to_numpy(dtype="int64")] = full["min"].to_numpy()
    if best is None:
        return pd.DataFrame({"query_id": block.ids[:0], "id": block.ids[:0], "similarity": pd.Series(dtype="float64")})
    return best.drop(columns="_q")


def top_k(corpus: DataFrame, queries: DataFrame, k: int, dense: bool = False, skip_self: bool = False) -> DataFrame:
    """T8, JN10: (query_id, id, similarity, rank) of the k most similar corpus rows per query.

    Both sides have ``id`` and either ``indices`` and ``weights`` (sparse) or ``values``
    (dense). Sparse rows without a common term are no match.
    """
    columns = ["id", "values"] if dense else ["id", "indices", "weights"]
    make = DenseBlock if dense else SparseBlock
    corpus, queries = corpus.select(*columns), queries.select(*columns)
    id_type = corpus.schema["id"].dataType.simpleString()
    query_type = queries.schema["id"].dataType.simpleString()
    fields = f"query_id {query_type}, id {id_type}, similarity double"
    schema = pa.schema(
        [("query_id", _arrow(query_type)), ("id", _arrow(id_type)), ("similarity", pa.float64())]
    )

    held = queries.limit(MAX_QUERIES + 1).toArrow()
    if held.num_rows <= MAX_QUERIES:
        spark = corpus.sparkSession
        shared = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _k_best(make(shared.value), batches, k, skip_self)
            yield from pa.Table.from_pandas(found, schema, preserve_index=False).to_batches()

        # every task hands on k rows per query, so there should not be very many tasks
        local = corpus.coalesce(MAX_TASKS).mapInArrow(run, fields)
    else:
        n_queries, n_corpus = queries.count(), corpus.count()
        q_blocks = math.ceil(n_queries / MAX_QUERIES)
        c_blocks = math.ceil(n_corpus / BLOCK_ROWS)

        def blocked(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
            return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own))).withColumn(
                other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>"))
            )

        def pair(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return schema.empty_table()
            return pa.Table.from_pandas(_k_best(make(right), [left], k, skip_self), schema, preserve_index=False)

        left = blocked(corpus, "cb", c_blocks, "qb", q_blocks).groupBy("cb", "qb")
        right = blocked(queries, "qb", q_blocks, "cb", c_blocks).groupBy("cb", "qb")
        local = left.cogroup(right).applyInArrow(pair, fields)

    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]
