"""Linear support vector machines with squared hinge loss, all of them in the same passes over the rows.

A space (a vocabulary with its classes) has one problem for each class against the rest, or a single one for two
classes, and one for each value of C. Rows are packed blocks of one space. A space with little work is solved by one
task from its blocks, all such spaces in one job. For the others, a pass sends the weights of all open problems to the
tasks, each task adds up losses and gradients of its blocks, and the sums come back: as many passes as the slowest
problem needs, whatever the number of classes, spaces and values of C. Weights that do not fit in one broadcast are
solved in rounds of spaces, and a space with very many classes in slices of classes. Both ways take the same steps.

The objective of a problem is |w|^2 / 2 + sum of cost * max(0, 1 - y * margin)^2, with the intercept as one more weight
of a feature that is always 1. Against the rest, a class costs C times its balanced weight and the rest C; of two
classes both cost C times their balanced weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators.dictionary import Sparse
from casewise.operators.joins import lookup
from casewise.session import durable, shared_folder

#: Weights solved together, and the most numbers in a block as a dense matrix.
ROUND_WEIGHTS, DENSE = 1 << 20, 1 << 21
#: Products (stored weights times problems) of a pass over a space up to which one task solves it, and bytes that it holds.
OWN_WORK, OWN_BYTES = 1 << 24, 64 << 20
#: Rows of a block, and steps that a problem remembers.
BLOCK_ROWS, MEMORY = 512, 12
#: Sums of a pass up to this size are added up by the driver, larger ones by tasks first.
DIRECT_BYTES = 32 << 20
#: Numbers in one piece of a sum.
PIECE = 1 << 17
TOLERANCE = 1e-3

WEIGHTS = "space string, place int, c int, weights array<double>, intercept double"
BLOCKS = "space string, n int, places binary, counts binary, columns binary, at binary, weights binary"


# -- blocks -----------------------------------------------------------------------------------


def _blocks_of(places: np.ndarray, rows: Sparse) -> Iterator[tuple]:
    columns, at = np.unique(rows.idx, return_inverse=True)
    if len(places) > 1 and (len(places) > BLOCK_ROWS or len(places) * len(columns) > DENSE):
        half = np.arange(min(BLOCK_ROWS, max(1, len(places) // 2)))
        yield from _blocks_of(places[half], rows.rows(half))
        rest = np.arange(len(half), len(places))
        yield from _blocks_of(places[rest], rows.rows(rest))
    elif len(places):
        yield places, rows.counts, columns, at, rows.weights


def packed_blocks(space: str, places: np.ndarray, rows: Sparse) -> Iterator[pa.RecordBatch]:
    """The rows of a space, with the places of their classes, as rows of the table ``BLOCKS``."""
    for own in _blocks_of(places, rows):
        kinds = (np.int32, np.int32, np.int32, np.int32, np.float64)
        blobs = [pa.array([np.ascontiguousarray(x, k).tobytes()], pa.binary()) for x, k in zip(own, kinds)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([space]), pa.array([len(own[0])], pa.int32()), *blobs], [c.split()[0] for c in BLOCKS.split(", ")]
        )


class Block:
    """The rows of a block over the columns that it has, as a matrix where many problems share it."""

    def __init__(self, row: dict, problems: int):
        self.places, counts, self.columns, self.at = (np.frombuffer(row[c], np.int32) for c in ("places", "counts", "columns", "at"))
        self.row, self.weights = np.repeat(np.arange(len(counts)), counts), np.frombuffer(row["weights"], np.float64)
        self.matrix = None
        if len(self.at) * problems > len(counts) * len(self.columns):
            self.matrix = np.zeros((len(counts), len(self.columns)))
            self.matrix[self.row, self.at] = self.weights

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Rows by problems, for weights of the block's columns."""
        if self.matrix is not None:
            return self.matrix @ weights.T
        n = len(self.places)
        return np.stack([np.bincount(self.row, self.weights * w[self.at], n) for w in weights], 1)

    def sums(self, slopes: np.ndarray, power: int = 1) -> np.ndarray:
        """Problems by columns: slopes times (squared) weights."""
        if self.matrix is not None:
            return slopes.T @ self.matrix**power
        own = self.weights**power
        return np.stack([np.bincount(self.at, own * s[self.row], len(self.columns)) for s in slopes.T])


# -- problems ---------------------------------------------------------------------------------


@dataclass
class Slice:
    """Some problems of a space: classes ``first`` to ``last`` against the rest, for each C."""

    space: str
    width: int  # terms of the space
    sizes: np.ndarray  # rows of each class
    first: int
    last: int
    C: Sequence[float]

    @property
    def two(self) -> bool:
        return len(self.sizes) == 2

    @property
    def n(self) -> int:
        return (self.last - self.first) * len(self.C)

    def costs(self) -> np.ndarray:
        """Balanced weight of each class."""
        return self.sizes.sum() / (len(self.sizes) * self.sizes)

    def signs_and_costs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(y, cost without C) for rows by classes."""
        own = places[:, None] == np.arange(self.first, self.last)[None, :]
        cost = np.where(own | self.two, self.costs()[places][:, None], 1.0)
        return np.where(own, 1.0, -1.0), cost

    def losses(self, block: Block, weights: np.ndarray, out: list[np.ndarray], curvature: bool) -> None:
        """Add loss, gradient and (at zero weights) curvature of a block to ``out``; none has C in it."""
        columns = block.columns
        y, cost = (np.tile(a, (1, len(self.C))) for a in self.signs_and_costs(block.places))
        margin = block.margins(weights[:, columns]) + weights[:, -1]
        short = np.maximum(0.0, 1.0 - y * margin)
        out[0] += (cost * short * short).sum(0)
        slope = -2.0 * cost * y * short
        out[1][:, columns] += block.sums(slope)
        out[1][:, -1] += slope.sum(0)
        if curvature:
            out[2][:, columns] += 2.0 * block.sums(cost, 2)
            out[2][:, -1] += 2.0 * cost.sum(0)


class Descent:
    """L-BFGS for several problems side by side: each has its own step, and all are evaluated together."""

    def __init__(self, C: np.ndarray, tolerance: float, max_iter: int):
        self.C, self.tolerance, self.max_iter = C[:, None], tolerance, max_iter
        self.x = self.trial = None
        self.past: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.steps = np.zeros(len(C), int)
        self.done = np.zeros(len(C), bool)

    def start(self, width: int) -> np.ndarray:
        self.trial = np.zeros((len(self.C), width))
        return self.trial

    def tell(self, loss: np.ndarray, gradient: np.ndarray, curvature: np.ndarray | None) -> bool:
        """Sums at ``trial``; sets the next ``trial`` and says whether all problems are solved."""
        f = 0.5 * (self.trial**2).sum(1) + self.C[:, 0] * loss
        g = self.trial + self.C * gradient
        if self.x is None:
            self.scale = 1.0 + self.C * curvature
            self.x, self.f, self.g = self.trial, f, g
            self.least = self.tolerance * np.sqrt((g * g / self.scale).sum(1))
            self._head(np.ones(len(f), bool))
        else:
            good = ~self.done & (f <= self.f + 1e-4 * self.t * self.slope + 1e-13 * np.abs(self.f))
            s, y = self.trial - self.x, g - self.g
            curved = (s * y).sum(1)
            kept = good & (curved > 1e-14 * (y * y).sum(1))
            self.past = [*self.past[-MEMORY + 1 :], (s, y, np.where(kept, 1.0 / np.where(kept, curved, 1.0), 0.0))]
            over = f - self.f - self.slope * self.t
            bent = np.where(over > 0, -self.slope * self.t**2 / np.where(over > 0, 2 * over, 1.0), 0.5 * self.t)
            shorter = np.clip(bent, 0.1 * self.t, 0.5 * self.t)
            at = good[:, None]
            self.x, self.g = np.where(at, self.trial, self.x), np.where(at, g, self.g)
            self.f = np.where(good, f, self.f)
            self.steps += good
            self.t = np.where(good, self.t, shorter)
            self.done |= ~good & (self.t < 1e-8)
            self._head(good)
        small = np.sqrt((self.g * self.g / self.scale).sum(1)) <= self.least
        self.done |= small | (self.steps >= self.max_iter)
        self.trial = np.where(self.done[:, None], self.x, self.x + self.t[:, None] * self.d)
        return bool(self.done.all())

    def _head(self, new: np.ndarray) -> None:
        """New directions for the problems that have moved."""
        q, alphas = self.g.copy(), []
        last = np.ones(len(q))
        for s, y, rho in reversed(self.past):
            a = rho * (s * q).sum(1)
            q -= a[:, None] * y
            alphas.append(a)
        for s, y, rho in self.past:
            bend = (y * y / self.scale).sum(1)
            last = np.where(rho > 0, 1.0 / np.where(rho > 0, rho * np.where(bend > 0, bend, 1.0), 1.0), last)
        q *= last[:, None] / self.scale
        for (s, y, rho), a in zip(self.past, reversed(alphas)):
            q += (a - rho * (y * q).sum(1))[:, None] * s
        slope = -(self.g * q).sum(1)
        if not self.past:
            self.d, self.t, self.slope = -q, np.ones(len(q)), slope
            return
        self.d = np.where(new[:, None], -q, self.d)
        self.slope = np.where(new, slope, self.slope)
        self.t = np.where(new, 1.0, self.t)


# -- passes -----------------------------------------------------------------------------------


def _partial(shared):
    """Sums of one task: (slice, sums) for the slices that it has rows of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, weights, curvature = shared.value
        of_space: dict[str, list[int]] = {}
        for i, s in slices.items():
            of_space.setdefault(s.space, []).append(i)
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column(0)[at].as_py() not in of_space:
                    continue
                row = batch.slice(at, 1).to_pylist()[0]
                for i in of_space[row["space"]]:
                    if i not in sums:
                        sums[i] = [np.zeros(len(weights[i])), *(np.zeros(weights[i].shape) for _ in range(1 + curvature))]
                    slices[i].losses(Block(row, slices[i].n), weights[i], sums[i], curvature)
        for i, parts in sums.items():
            flat = np.concatenate([p.ravel() for p in parts])
            for at in range(0, len(flat), PIECE):
                yield _sum_row(i, at, flat[at : at + PIECE])

    return run


def _sum_row(i: int, at: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i], pa.int32()), pa.array([at], pa.int64()), pa.array([sums.tobytes()], pa.binary())], ["slice", "at", "sums"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for *key, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = np.frombuffer(raw)
            total[tuple(key)] = total[tuple(key)] + own if tuple(key) in total else own
    for (i, at), sums in total.items():
        yield _sum_row(i, at, sums)


def _pass(blocks: DataFrame, tasks: int, slices: dict[int, Slice], weights: dict[int, np.ndarray], first: bool) -> dict[int, np.ndarray]:
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast((slices, weights, first))
    schema = "slice int, at bigint, sums binary"
    sums = blocks.mapInArrow(_partial(shared), schema)
    if tasks * sum(w.nbytes for w in weights.values()) * (1 + first) > DIRECT_BYTES:
        sums = sums.repartition("slice", "at").mapInArrow(_added, schema)
    total: dict[int, np.ndarray] = {}
    for row in sums.collect():  # once the weights of a round, or a bounded multiple
        i, at, own = row["slice"], row["at"], np.frombuffer(row["sums"])
        if i not in total:
            total[i] = np.zeros(len(weights[i]) + weights[i].size * (1 + first))
        total[i][at : at + len(own)] += own
    shared.destroy()
    return total


def _slices(space: str, width: int, sizes: Sequence[int], C: Sequence[float], most_weights: int) -> Iterator[Slice]:
    first, last = (1, 2) if len(sizes) == 2 else (0, len(sizes))
    step = max(1, most_weights // ((width + 1) * len(C)))
    for k in range(first, last, step):
        yield Slice(space, width, np.asarray(sizes, float), k, min(last, k + step), list(C))


def _found(s: Slice, x: np.ndarray) -> pa.RecordBatch:
    classes = s.last - s.first
    return pa.RecordBatch.from_arrays([
        pa.array([s.space] * s.n), pa.array(np.tile(np.arange(s.first, s.last), len(s.C)), pa.int32()),
        pa.array(np.repeat(np.arange(len(s.C)), classes), pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.arange(s.n + 1) * s.width, pa.int32()), pa.array(x[:, :-1].ravel())), pa.array(x[:, -1]),
    ], [c.split()[0] for c in WEIGHTS.split(", ")])


def _descent(s: Slice, tolerance: float, max_iter: int) -> Descent:
    return Descent(np.repeat(np.array(s.C, float), s.last - s.first), tolerance, max_iter)


def _in_one_task(C: Sequence[float], tolerance: float, max_iter: int, most_weights: int):
    """Blocks by space, each with the width and class sizes of its space -> the weights of the space."""
    def solved(held: list[dict]) -> Iterator[pa.RecordBatch]:
        one = held[0]
        for s in _slices(one["space"], one["width"], one["sizes"], C, most_weights):
            blocks = [Block(b, s.n) for b in held]
            descent, first, done = _descent(s, tolerance, max_iter), True, False
            descent.start(s.width + 1)
            while not done:
                w = descent.trial
                sums = [np.zeros(len(w)), *(np.zeros(w.shape) for _ in range(1 + first))]
                for block in blocks:
                    s.losses(block, w, sums, first)
                done = descent.tell(*sums, *([None] if not first else []))
                first = False
            yield _found(s, descent.x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if held and row["space"] != held[0]["space"]:
                    yield from solved(held)
                    held = []
                held.append(row)
        if held:
            yield from solved(held)

    return run


def solve(
    blocks: DataFrame, spaces: DataFrame, C: Sequence[float] = (1.0,), tolerance: float = TOLERANCE, max_iter: int = 100,
    most_weights: int = ROUND_WEIGHTS, own_work: int = OWN_WORK,
) -> DataFrame:
    """(space, place of the class, place of the C, weights, intercept) of every problem, a stored table.

    ``blocks`` is a stored table of ``BLOCKS``; ``spaces`` has space, width (its number of terms) and sizes (rows of each
    class, in order). Two classes have one problem, whose positive side is the second one.
    """
    spark = blocks.sparkSession
    held = blocks.groupBy("space").agg(F.sum(F.octet_length("weights") / 8).alias("stored"))
    problems = F.when(F.size("sizes") == 2, 1).otherwise(F.size("sizes")) * len(C)
    alone = (F.col("stored") * problems <= own_work) & (F.col("stored") * 20 <= OWN_BYTES)
    spaces = durable(spaces.join(held, "space", "left").withColumn("alone", F.coalesce(alone, F.lit(True))))
    path = f"{shared_folder(spark)}/weights-{uuid.uuid4().hex}"

    small = lookup(blocks, spaces.where("alone").select("space", "width", "sizes"), ["space"], "inner", stored=True)
    small.repartition("space").sortWithinPartitions("space").mapInArrow(
        _in_one_task(list(C), tolerance, max_iter, most_weights), WEIGHTS
    ).write.parquet(path)

    def write(own: list[Slice]) -> None:
        found = [_found(s, x) for s, x in zip(own, _solved(blocks, own, tolerance, max_iter))]
        spark.createDataFrame(pa.Table.from_batches(found)).write.mode("append").parquet(path)

    own: list[Slice] = []
    weights = 0
    for row in spaces.where(~F.col("alone")).orderBy("space").toLocalIterator():
        for s in _slices(row["space"], row["width"], row["sizes"], C, most_weights):
            if own and weights + s.n * (s.width + 1) > most_weights:
                write(own)
                own, weights = [], 0
            own.append(s)
            weights += s.n * (s.width + 1)
    if own:
        write(own)
    return spark.read.schema(WEIGHTS).parquet(path)


def _solved(blocks: DataFrame, own: list[Slice], tolerance: float, max_iter: int) -> list[np.ndarray]:
    """The weights of some slices, by passes over all their blocks."""
    names = {s.space for s in own}
    rows = blocks.where(F.col("space").isin(list(names))) if len(names) <= 1000 else blocks
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # a lost part is read again from the table
    tasks = rows.select(F.spark_partition_id().alias("task")).distinct().count()
    descents = {i: _descent(s, tolerance, max_iter) for i, s in enumerate(own)}
    trials = {i: d.start(own[i].width + 1) for i, d in descents.items()}
    first = True
    try:
        while trials:
            still = {own[i].space for i in trials}  # blocks of solved spaces do not leave the cache
            needed = rows.where(F.col("space").isin(list(still))) if len(still) < len(names) and len(still) <= 1000 else rows
            sums = _pass(needed, tasks, {i: own[i] for i in trials}, trials, first)
            for i in list(trials):
                n, shape = own[i].n, trials[i].shape
                got = sums.get(i, np.zeros(n + shape[0] * shape[1] * (1 + first)))
                gradient, *more = got[n:].reshape(-1, *shape)
                done = descents[i].tell(got[:n], gradient, more[0] if more else None)
                trials[i] = descents[i].trial
                if done:
                    del trials[i]
            first = False
    finally:
        rows.unpersist()
    return [descents[i].x for i in range(len(own))]
