"""An inverted index whose lists are read from the top: exact top-k search with early termination.

The rows are cut into shards of bounded size, and each shard has its own lists: the rows of a term by falling weight. A list
is read in tiers of blocks, the first block alone, then two, four and so on. What has been read of a row adds up to a lower
bound of its similarity; what a list may still add is bounded by its next weight. Lists whose bounds together cannot lift a
row to a query's k-th best lower bound, in this shard or among those that the task has searched before, are read no further.
Rows that may still be among the first k are then scored from their whole vectors, or the lists left out are read to their
end where that is less work.

Building writes each row once, where it is, and a search reads the shards where they are: neither shuffles a list, and only
the k best rows per query and task are. Weights and similarities are those of ``top_k``, rounded alike, with the lower id
first among equal ones. Rows without a term, and rows and queries without an id, are no match.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.operators.topk import DIGITS, MAX_QUERIES, MAX_TASKS, WORK, _arrow, _best, _lists
from casewise.session import durable

#: Rows in a block, terms of rows in a shard, and shards in a file.
BLOCK, SHARD_TERMS, FILE_SHARDS = 128, 1 << 17, 8
#: Room for rounding: similarities are compared after nine places.
SLACK = 1e-8


def _flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start`` to ``start + size - 1`` of all runs, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, indices, weights) as shards: ids, terms of each row, their numbers and weights, and their places by list."""
    names = ["ids", "counts", "terms", "weights", "lists"]

    def shard(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        terms, counts = _lists(table.column("indices"))
        weights, _ = _lists(table.column("weights"))
        # equal weights in the order of the rows
        lists = np.lexsort((-weights, terms))
        ids = pa.concat_arrays(table.column("id").chunks)
        flat = [ids, *(pa.array(x.astype(kind)) for x, kind in zip((counts, terms, weights, lists), ("i4", "i4", "f8", "i4")))]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in flat], names)

    held, n = [], 0
    for batch in batches:
        batch = batch.filter(pa.array(_lists(batch.column("indices"))[1] > 0))
        upto, first = np.cumsum(_lists(batch.column("indices"))[1]), 0
        while first < batch.num_rows:
            done = upto[first - 1] if first else 0
            last = int(np.searchsorted(upto, done + SHARD_TERMS - n, "right"))
            if last <= first and not held:
                last = first + 1  # one row that is larger than a shard
            if last > first:
                held.append(batch.slice(first, last - first))
                n += upto[last - 1] - done
                first = last
            if first < batch.num_rows:
                yield shard(held)
                held, n = [], 0
    if held:
        yield shard(held)


def build(vectors: DataFrame, folder: str, block: int = BLOCK) -> InvertedIndex:
    """Write the index of (id, indices, weights) under ``folder``, one row for each shard."""
    id_type = vectors.schema["id"].dataType.simpleString()
    fields = f"ids array<{id_type}>, counts array<int>, terms array<int>, weights array<double>, lists array<int>"
    vectors.where("id IS NOT NULL").select("id", "indices", "weights").mapInArrow(_sharded, fields).write.mode("overwrite").option(
        "maxRecordsPerFile", FILE_SHARDS
    ).parquet(f"{folder}/shards")
    return InvertedIndex(vectors.sparkSession, folder, block)


class _Asked:
    """Queries as one list of (query, term, weight)."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id").to_pandas().to_numpy()
        self.terms, counts = _lists(table.column("indices"))
        self.weights, _ = _lists(table.column("weights"))
        self.ends = np.concatenate([[0], np.cumsum(counts)])
        self.query = np.repeat(np.arange(len(counts)), counts)


class _Shard:
    """A shard of the index as a task searches it."""

    def __init__(self, columns: dict[str, pa.Array]):
        self.ids = columns["ids"].to_pandas().to_numpy()
        self.counts, terms, self.weights, self.lists = (
            columns[name].to_numpy(zero_copy_only=False) for name in ("counts", "terms", "weights", "lists")
        )
        self.starts = np.cumsum(self.counts) - self.counts
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        ordered = terms[self.lists]
        self.first = np.flatnonzero(np.diff(ordered, prepend=-1))
        self.names, self.size = ordered[self.first], np.diff(np.append(self.first, len(ordered)))

    @functools.cached_property
    def term(self) -> np.ndarray:
        """For each term of a row, the place of its list."""
        out = np.empty(len(self.lists), np.int64)
        out[self.lists] = np.repeat(np.arange(len(self.names)), self.size)
        return out

    def search(self, asked: _Asked, low: int, high: int, floor: np.ndarray, k: int, block: int):
        """(queries, rows, similarities, postings read) of the rows that may be among the k best of queries low to high - 1.

        ``floor`` has for each of these queries the least similarity that still counts.
        """
        n_queries, n_rows, n_read = high - low, len(self.ids), 0
        own = slice(asked.ends[low], asked.ends[high])
        place = np.minimum(np.searchsorted(self.names, asked.terms[own]), len(self.names) - 1)
        known = self.names[place] == asked.terms[own]
        place, query, factor = place[known], asked.query[own][known] - low, asked.weights[own][known]
        first, size, done = self.first[place], self.size[place], np.zeros(len(place), np.int64)
        scores, left_out, least = np.zeros(n_queries * n_rows), np.zeros(n_queries), floor
        is_open, tier = np.ones(len(place), bool), 0

        def read(lists: np.ndarray, upto: np.ndarray) -> int:
            n = upto - done[lists]
            for some in np.split(np.arange(len(lists)), np.flatnonzero(np.diff(np.cumsum(n) // WORK)) + 1):
                at = self.lists[_flat((first + done)[lists[some]], n[some])]
                cell = np.repeat(query[lists[some]] * n_rows, n[some]) + self.row[at]
                scores[:] += np.bincount(cell, np.repeat(factor[lists[some]], n[some]) * self.weights[at], len(scores))
            done[lists] = upto
            return int(n.sum())

        while len(goes := np.flatnonzero(is_open & (done < size))):
            # A row that is in no part that was read has at most what the left out lists may add. So lists are left out, the
            # least promising first, as long as all left out lists together stay below the query's k-th best lower bound.
            most = factor[goes] * self.weights[self.lists[first[goes] + done[goes]]]
            order = np.lexsort((most, query[goes]))
            goes, most = goes[order], most[order]
            whose, total = query[goes], np.cumsum(most)
            begins = np.flatnonzero(np.diff(whose, prepend=-1))
            before = np.repeat(total[begins] - most[begins], np.diff(np.append(begins, len(whose))))
            dropped = total - before + left_out[whose] + SLACK < least[whose]
            left_out += np.bincount(whose[dropped], most[dropped], n_queries)
            is_open[goes[dropped]] = False
            goes = goes[~dropped]
            n_read += read(goes, np.minimum(size[goes], block * (2 ** (tier + 1) - 1)))
            if n_rows >= k:
                kth = -np.partition(-scores.reshape(n_queries, n_rows), k - 1, axis=1)[:, k - 1]
                least = np.maximum(floor, kth)
            tier += 1

        def near() -> tuple[np.ndarray, np.ndarray]:
            table = scores.reshape(n_queries, n_rows)
            return np.nonzero((table > 0) & (table + (left_out + SLACK - least)[:, None] >= 0))

        rest = np.flatnonzero(~is_open)
        q, row = near()
        whole = np.bincount(q, self.counts[row], n_queries)  # what scoring the rows of a query reads
        by_list = np.bincount(query[rest], (size - done)[rest], n_queries) <= whole
        rest = rest[by_list[query[rest]]]
        if len(rest):
            n_read += read(rest, size[rest])
            left_out[by_list] = 0.0
            q, row = near()
        similarity = scores[q * n_rows + row]
        late = np.flatnonzero(left_out[q] > 0)
        if len(late):
            scored, n = np.unique(q[late], return_inverse=True)
            weight = np.zeros((len(scored), len(self.names)))
            mine = np.flatnonzero(np.isin(query, scored))
            weight[np.searchsorted(scored, query[mine]), place[mine]] = factor[mine]
            sizes = self.counts[row[late]]
            for some in np.split(np.arange(len(late)), np.flatnonzero(np.diff(np.cumsum(sizes) // WORK)) + 1):
                at = _flat(self.starts[row[late[some]]], sizes[some])
                product = weight[np.repeat(n[some], sizes[some]), self.term[at]] * self.weights[at]
                similarity[late[some]] = np.bincount(np.repeat(np.arange(len(some)), sizes[some]), product, len(some))
        return q, row, np.round(similarity, DIGITS), n_read


def _searched(shards: Iterator[_Shard], asked: _Asked, k: int, block: int) -> tuple[pd.DataFrame, int]:
    """The k best rows per query over the shards, and the postings read for them."""
    best, n_read, floor = None, 0, np.full(len(asked.ids), -np.inf)
    for shard in shards:
        if not len(shard.names):
            continue
        step = max(1, WORK // max(len(shard.ids), len(shard.names)))
        for low in range(0, len(asked.ids), step):
            high = min(low + step, len(asked.ids))
            query, row, similarity, n = shard.search(asked, low, high, floor[low:high], k, block)
            n_read += n
            keep = (similarity > 0) & (similarity >= floor[low + query])
            if not keep.any():
                continue
            query = low + query[keep]
            found = pd.DataFrame(
                {"query_id": asked.ids[query], "id": shard.ids[row[keep]], "similarity": similarity[keep], "_q": query}
            )
            best = _best(found if best is None else pd.concat([best, found]), k)
            full = best.groupby("_q")["similarity"].agg(["size", "min"])
            full = full[full["size"] >= k]
            floor[full.index.to_numpy(dtype="int64")] = full["min"].to_numpy()
    if best is None:
        best = pd.DataFrame({"query_id": asked.ids[:0], "id": [], "similarity": []})
    return best, n_read


@dataclass
class InvertedIndex:
    spark: SparkSession
    folder: str
    block: int = BLOCK
    #: postings that the last search has read
    n_read: int = field(default=0)

    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/shards")

    def n_postings(self) -> int:
        return self.shards().agg(F.sum(F.size("lists").cast("long"))).first()[0] or 0

    def top_k(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, id, similarity, rank) for queries (id, indices, weights); rows without a common term are no match.

        Up to ``MAX_QUERIES`` queries at a time travel with the tasks, each of which searches its shards for them.
        """
        asked = durable(queries.where("id IS NOT NULL").select("id", "indices", "weights", F.monotonically_increasing_id().alias("_at")))
        blocks = max(1, math.ceil(asked.count() / MAX_QUERIES))
        found = []
        for i in range(blocks):
            some = asked.where(F.pmod(F.xxhash64("_at"), F.lit(blocks)) == i).select("id", "indices", "weights")
            found.append(durable(self._best(some, k)))
        best = functools.reduce(DataFrame.unionByName, found)
        self.n_read = best.agg(F.sum("n_read")).first()[0] or 0
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
        best = best.where("query_id IS NOT NULL").drop("n_read")
        return best.withColumn("rank", rank).where(F.col("rank") <= k)

    def _best(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, id, similarity) of the k best rows per query and task; a row without ids has the task's ``n_read``."""
        shards, block = self.shards(), self.block
        query_type = queries.schema["id"].dataType.simpleString()
        id_type = shards.schema["ids"].dataType.elementType.simpleString()
        schema = pa.schema(
            [("query_id", _arrow(query_type)), ("id", _arrow(id_type)), ("similarity", pa.float64()), ("n_read", pa.int64())]
        )
        shared = self.spark.sparkContext.broadcast(queries.toArrow())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = ((batch, i) for batch in batches for i in range(batch.num_rows))
            own = (_Shard({name: batch.column(name)[i].values for name in batch.schema.names}) for batch, i in rows)
            best, n_read = _searched(own, _Asked(shared.value), k, block)
            columns = [pa.array(best[name].tolist(), schema.field(name).type) for name in ("query_id", "id", "similarity")]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(best), pa.int64())], schema=schema)
            yield pa.RecordBatch.from_pylist([{"n_read": n_read}], schema)

        # every task hands on k rows per query, so there should not be very many tasks
        return shards.coalesce(MAX_TASKS).mapInArrow(run, f"query_id {query_type}, id {id_type}, similarity double, n_read bigint")
