"""Hard-negative mining: for anchors and their best positives, the best rows of other labels within a band of scores.

A score is the inner product of whole-number vectors. Every anchor is compared with all rows, in cells of a grid: a group of
anchors meets a group of packed row blocks, each cell keeps the few best, and the cells are merged by windows with a limit.

Rows are coded once. A vector is rotated (one fixed orthogonal matrix for each dimension) and replaced by the signs of its
components, one bit each, with its alignment, which is its inner product with the code vector of length one; what the code
leaves is coded again, ``CODES`` times in all, and the length of the last rest is kept. An anchor is rotated too and its
components are rounded to ``PLANES`` bits. Then the score is estimated from population counts of codes and bit planes, and

    |score - estimate| <= |what the codes build| |what the rounding leaves| + |last rest| |anchor beside the last code vector|

by Cauchy and Schwarz, as the last rest is at right angles to the last code vector. The interval is certain, so a row whose
interval lies outside the band, or below the k-th best score so far, is out; all others are scored in whole numbers.

Higher scores come first, ties by the smaller id, null ids last. Rows with a null label or vector, or a component that is null
or not finite, take no part. Shorter vectors count as filled up with zeros. Anchors with a null id are none. Rows with an
anchor's own id are not its positives, and repeated rows count as often as they are there (a repeated anchor as well). Labels
and ids are whole numbers. An empty table gives no rows. If a score might not fit in 56 bits, the job ends in an error. Other
columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import Tables, blob, partitions

#: One-bit codes of a vector, and bits of a rounded component of an anchor.
CODES, PLANES = 6, 6
#: Rows in a block, rows that a cell has at most on average, and least rows worth a cell of their own.
BLOCK, CELL_ROWS, LEAST_ROWS = 4096, 1 << 18, 4096
#: Anchors in a cell, and anchors compared with a block at once.
CELL_ANCHORS, TOGETHER = 1 << 15, 64
#: Rows of the first slices of a cell, which find good scores to compare the others with.
FIRST = (256, 1024)

_NONE = np.iinfo(np.int64).min
_PACKED = "kind int, cell int, n int, ids binary, lost binary, labels binary, ints binary, codes binary, alignment binary, lengths binary, slots binary"


# -- codes -------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=2)
def rotation(width: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(11).standard_normal((width, width)))[0]


def _width(dim: int) -> int:
    return 64 * max(1, -(-dim // 64))


def _rotated(ints: np.ndarray) -> np.ndarray:
    width = _width(ints.shape[1])
    return ints.astype(np.float64) @ rotation(width)[: ints.shape[1]]


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits (..., width) as 64-bit words (..., width / 64)."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def coded(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes (n, CODES, words), alignments (n, CODES), (n, 2): length of what the codes build, length of the last rest)."""
    rest = _rotated(ints)
    whole, width = rest.copy(), rest.shape[1]
    codes = np.zeros((len(ints), CODES, width // 64), np.uint64)
    alignment = np.zeros((len(ints), CODES))
    for k in range(CODES):
        signs = rest >= 0
        codes[:, k] = _words(signs)
        alignment[:, k] = np.abs(rest).sum(1) / math.sqrt(width)
        rest -= np.where(signs, 1.0, -1.0) * (alignment[:, k] / math.sqrt(width))[:, None]
    return codes, alignment, np.stack([np.linalg.norm(whole - rest, axis=1), np.linalg.norm(rest, axis=1)], 1)


class Anchors:
    """A group of anchors, by label: rotated, rounded, and as bit planes."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, labels: np.ndarray, ints: np.ndarray):
        self.number, self.ids, self.labels, self.ints = number, ids, labels, ints
        turned = _rotated(ints)
        self.width = turned.shape[1]
        low, high = turned.min(1), turned.max(1)
        self.low, self.step = low, np.where(high > low, (high - low) / ((1 << PLANES) - 1), 1.0)
        levels = np.rint((turned - low[:, None]) / self.step[:, None]).astype(np.int64)
        self.off = np.linalg.norm(turned - (low[:, None] + self.step[:, None] * levels), axis=1)
        self.length = np.linalg.norm(turned, axis=1)
        self.total = levels.sum(1)
        self.planes = np.stack([_words((levels >> j & 1).astype(bool)) for j in range(PLANES)], 1)

    def interval(self, at: slice, codes: np.ndarray, alignment: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest possible score), anchors by rows."""
        low, step, off = (a[at, None] for a in (self.low, self.step, self.off))
        planes, root = self.planes[at], math.sqrt(self.width)
        estimate = np.zeros((len(low), len(codes)))
        product = estimate
        for k in range(codes.shape[1]):
            ones = np.zeros(estimate.shape, np.int32)
            for w in range(codes.shape[2]):
                word = np.ascontiguousarray(codes[:, k, w])
                for j in range(PLANES):
                    ones += np.left_shift(np.bitwise_count(word & planes[:, j, w, None]), j, dtype=np.int32)
            set_ = np.bitwise_count(codes[:, k]).sum(1, dtype=np.int64)
            product = (low * (2 * set_ - self.width) + step * (2 * ones - self.total[at, None])) / root
            estimate += product * alignment[:, k]
        along = np.maximum(np.abs(product) - off, 0)
        beside = np.sqrt(np.maximum(self.length[at, None] ** 2 - along**2, 0))
        wide = lengths[:, 0] * off + lengths[:, 1] * beside + 1e-6 + 1e-9 * self.length[at, None] * (lengths[:, 0] + lengths[:, 1])
        return estimate - wide, estimate + wide


def _largest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def scores(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of rows ``i`` of ``a`` with rows ``j`` of ``b``."""
    most = _largest(a) * _largest(b) * max(1, a.shape[1])
    if most >= 1 << 56:
        raise ValueError("a score might not fit in 56 bits")
    kind = np.float64 if most < 1 << 53 else np.int64
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 1 << 14):
        own = slice(at, at + (1 << 14))
        out[own] = np.einsum("ij,ij->i", a[i[own]].astype(kind), b[j[own]].astype(kind)).astype(np.int64)
    return out


# -- the best of each slot -----------------------------------------------------------------------


class Best:
    """The first k of each slot by score, then id, null ids last."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), _NONE)
        self.id = np.zeros((slots, k), np.int64)
        self.lost = np.zeros((slots, k), bool)

    def least(self, at=slice(None)) -> np.ndarray:
        """A score that a further row must reach."""
        return self.score[at, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, lost: np.ndarray) -> None:
        touched = np.unique(slot)
        if not len(touched):
            return
        held = self.score[touched] != _NONE
        slot = np.concatenate([np.repeat(touched, held.sum(1)), slot])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([self.id[touched][held], ids])
        lost = np.concatenate([self.lost[touched][held], lost])
        order = np.lexsort((ids, lost, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        kept = rank < self.k
        at = slot[kept], rank[kept]
        for own, values in ((self.score, score), (self.id, ids), (self.lost, lost)):
            own[at] = values[order][kept]

    def rows(self, names: list[np.ndarray]) -> pa.RecordBatch:
        slot, _ = np.nonzero(self.score != _NONE)
        own = self.score != _NONE
        return pa.RecordBatch.from_arrays(
            [*(pa.array(n[slot]) for n in names), pa.array(self.score[own]), pa.array(self.id[own], pa.int64(), mask=self.lost[own])],
            ["number", "place", "score", "id"][: len(names)] + ["score", "id"],
        )


class Positives:
    """The best rows of an anchor's own label."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors, self.best, self.scored, self.seen = anchors, Best(len(anchors.ids), k), 0, 0

    def meet(self, block: dict) -> None:
        order = np.argsort(block["labels"], kind="stable")
        block = {k: v[order] for k, v in block.items()}
        own = self.anchors.labels
        for label in np.unique(block["labels"]):
            (low, high), rows = ((np.searchsorted(x, label, "left"), np.searchsorted(x, label, "right")) for x in (own, block["labels"]))
            part = {k: v[slice(*rows)] for k, v in block.items()}
            for at in range(low, high, TOGETHER):
                self._compare(slice(at, min(high, at + TOGETHER)), part)

    def _compare(self, at: slice, rows: dict) -> None:
        least, most = self.anchors.interval(at, rows["codes"], rows["alignment"], rows["lengths"])
        itself = (self.anchors.ids[at, None] == rows["ids"]) & ~rows["lost"]
        self.seen += least.size
        floor = self.best.least(at).astype(np.float64)
        k = self.best.k
        if least.shape[1] > k:  # k other rows are certain to have as much
            floor = np.maximum(floor, np.partition(np.where(itself, -np.inf, least), -k, axis=1)[:, -k])
        i, j = np.nonzero((most >= floor[:, None]) & ~itself)
        i = i + at.start
        self.scored += len(i)
        self.best.add(i, scores(self.anchors.ints, i, rows["ints"], j), rows["ids"][j], rows["lost"][j])

    def rows(self) -> pa.RecordBatch:
        return self.best.rows([self.anchors.number])


class Negatives:
    """The best rows of other labels for each slot: an anchor with the scores (lowest, highest) of one of its bands."""

    def __init__(self, anchors: Anchors, slots: np.ndarray, k: int):
        """``slots``: anchor, place, lowest, highest; by anchor."""
        self.anchors, self.slots, self.best, self.scored, self.seen = anchors, slots, Best(len(slots), k), 0, 0
        self.first = np.searchsorted(slots[:, 0], np.arange(len(anchors.ids) + 1))

    def meet(self, block: dict) -> None:
        for at in range(0, len(self.anchors.ids), TOGETHER):
            self._compare(slice(at, min(len(self.anchors.ids), at + TOGETHER)), block)

    def _compare(self, at: slice, rows: dict) -> None:
        own = slice(self.first[at.start], self.first[at.stop])
        slots = self.slots[own]
        if not len(slots):
            return
        place = slots[:, 0] - at.start
        floor = np.maximum(slots[:, 2], self.best.least(own))
        lowest, highest = np.full(at.stop - at.start, np.inf), np.full(at.stop - at.start, -np.inf)
        np.minimum.at(lowest, place, floor.astype(np.float64))
        np.maximum.at(highest, place, slots[:, 3].astype(np.float64))
        least, most = self.anchors.interval(at, rows["codes"], rows["alignment"], rows["lengths"])
        self.seen += least.size
        other = self.anchors.labels[at, None] != rows["labels"]
        i, j = np.nonzero((most >= lowest[:, None]) & (least <= highest[:, None]) & other)
        found = scores(self.anchors.ints, i + at.start, rows["ints"], j)
        self.scored += len(i)
        # each slot of the anchor takes what lies in its band
        count = np.diff(self.first[at.start : at.stop + 1])
        pair = np.repeat(np.arange(len(i)), count[i])
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(count[i]) - count[i], count[i])
        slot = self.first[at.start + i[pair]] + inner
        score = found[pair]
        kept = (score >= self.slots[slot, 2]) & (score <= self.slots[slot, 3]) & (score >= self.best.least()[slot])
        j = j[pair][kept]
        self.best.add(slot[kept], score[kept], rows["ids"][j], rows["lost"][j])

    def rows(self) -> pa.RecordBatch:
        return self.best.rows([self.anchors.number[self.slots[:, 0]], self.slots[:, 1].astype(np.int32)])


# -- packed blocks ----------------------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``dim``, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _narrow(ints: np.ndarray) -> np.ndarray:
    most = _largest(ints)
    return ints.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _packed(kind: int, n: int, parts: list[np.ndarray | None]) -> list[pa.Array]:
    return [pa.array([kind], pa.int32()), pa.array([0], pa.int32()), pa.array([n], pa.int32()), *(
        pa.array([None if p is None else blob(p)], pa.binary()) for p in parts
    )]


_NAMES = [c.split()[0] for c in _PACKED.split(", ")]


def _row_blocks(dim: int):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                ids = batch.column(0)
                ints = _matrix(batch.column(2), dim)
                codes, alignment, lengths = coded(ints)
                yield pa.RecordBatch.from_arrays(_packed(1, batch.num_rows, [
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(),
                    _narrow(ints), codes, alignment, lengths, None,
                ]), _NAMES)

    return run


def _anchor_blocks(dim: int, groups: int):
    """Anchors (number, id, label, ints, bands) in packed form for each group; the cell is the group's number."""
    def run(batches):
        for batch in batches:
            number = batch.column(0).to_numpy()
            group = number % groups
            ints = _matrix(batch.column(3), dim)
            bands = batch.column(4).to_pylist()
            for g in np.unique(group):
                own = np.flatnonzero(group == g)
                slots = [(n, b["place"], b["low"], b["high"]) for n, i in enumerate(own) for b in bands[i] or ()]
                packed = _packed(0, len(own), [
                    batch.column(1).to_numpy()[own], number[own], batch.column(2).to_numpy()[own], ints[own], None, None, None,
                    np.array(slots, np.int64).reshape(-1, 4),
                ])
                packed[1] = pa.array([g], pa.int32())
                yield pa.RecordBatch.from_arrays(packed, _NAMES)

    return run


def _block(row: dict, dim: int) -> dict:
    n, width = row["n"], _width(dim) // 64
    raw = row["ints"]
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // (n * dim)]
    return {
        "ids": np.frombuffer(row["ids"], np.int64), "lost": np.frombuffer(row["lost"], bool),
        "labels": np.frombuffer(row["labels"], np.int64), "ints": np.frombuffer(raw, kind).reshape(n, dim).astype(np.int64),
        "codes": np.frombuffer(row["codes"], np.uint64).reshape(n, CODES, width),
        "alignment": np.frombuffer(row["alignment"], np.float64).reshape(n, CODES),
        "lengths": np.frombuffer(row["lengths"], np.float64).reshape(n, 2),
    }


def _group(rows: list[dict], dim: int) -> tuple[Anchors, np.ndarray]:
    """The anchors by label, and their slots."""
    start = np.cumsum([0, *(r["n"] for r in rows)])
    slots = [np.frombuffer(r["slots"], np.int64).reshape(-1, 4) + np.array([at, 0, 0, 0]) for r, at in zip(rows, start)]
    ids, number, labels = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("ids", "lost", "labels"))
    ints = np.concatenate([np.frombuffer(r["ints"], np.int64).reshape(-1, dim) for r in rows])
    order = np.argsort(labels, kind="stable")
    slots = np.concatenate(slots)
    slots[:, 0] = np.argsort(order)[slots[:, 0]]
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    return Anchors(number[order], ids[order], labels[order], ints[order]), slots


def _cell(dim: int, k: int, bands: bool):
    """One cell: the anchors come first, then row blocks one by one."""
    def run(batches):
        held, search = [], None

        def meet(row):
            block, at = _block(row, dim), 0
            for size in (*(FIRST if not search.seen else ()), BLOCK):
                part = {name: values[at : at + size] for name, values in block.items()}
                if len(part["ids"]):
                    search.meet(part)
                at += size

        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["kind"] == 0:
                    held.append(row)
                    continue
                if search is None:
                    if not held:
                        continue
                    anchors, slots = _group(held, dim)
                    search = Negatives(anchors, slots, k) if bands else Positives(anchors, k)
                    held.clear()
                meet(row)
        if search:
            yield search.rows()

    return run


# -- the operator --------------------------------------------------------------------------------------


def _met(rows: DataFrame, anchors: DataFrame, dim: int, groups: int, cells: int, k: int, bands: bool) -> DataFrame:
    """Each group of anchors with each part of the rows."""
    packed = anchors.mapInArrow(_anchor_blocks(dim, groups), _PACKED)
    packed = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).withColumn("cell", (F.col("cell") * cells + F.col("part")).cast("int"))
    part = F.pmod(F.xxhash64("ids", "labels", "ints"), F.lit(cells)).cast("int")
    dealt = rows.withColumn("part", part).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn(
        "cell", (F.col("cell") * cells + F.col("part")).cast("int")
    )
    schema = "number bigint, place int, score bigint, id bigint" if bands else "number bigint, score bigint, id bigint"
    return (
        packed.drop("part").unionByName(dealt.drop("part")).repartitionById(groups * cells, F.col("cell"))
        .sortWithinPartitions("kind").mapInArrow(_cell(dim, k, bands), schema)
    )


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "id", label_col: str = "label", vector_col: str = "vector", positives: int = 5,
    negatives: int = 3, band: tuple[int, int] = (50, 95), cell_anchors: int = CELL_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vector_col`` holds whole numbers; ``anchor`` is a condition on the table. For each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels whose score is between the two
    percentages of the positive's.
    """
    spark = vectors.sparkSession
    tables, kept = Tables(spark), Tables(spark)
    numbers = F.col(vector_col).cast("array<bigint>")
    valid = vectors.where(
        F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(F.exists(vector_col, lambda x: x.isNull()), F.lit(True))
    ).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), numbers.alias("ints"),
        (F.coalesce(anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("asks"),
    )
    seen = valid.agg(F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("dim"), F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asks")).first()
    dim, groups = max(1, seen["dim"]), max(1, -(-seen["asks"] // cell_anchors))
    worth = min(partitions(spark), -(-seen["n"] // LEAST_ROWS))
    cells = max(1, -(-seen["n"] // CELL_ROWS), -(-worth // groups))
    rows = tables.store(valid.select("id", "label", "ints").mapInArrow(_row_blocks(dim), _PACKED), "rows")
    asking = valid.where("asks").select(F.monotonically_increasing_id().alias("number"), "id", "label", "ints")
    asking = tables.store(asking, "anchors")

    first = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    bands = "array<struct<place:int,low:bigint,high:bigint>>"
    found = _met(rows, asking.withColumn("bands", F.lit(None).cast(bands)), dim, groups, cells, positives, False)
    best = tables.store(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")
    # least and most whole scores with low% of the positive's <= score <= high% of it
    floored = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")
    low, high = floored(f"(score * {band[0]} + 99)"), floored(f"(score * {band[1]})")
    limits = best.groupBy("number").agg(
        F.collect_list(F.struct("place", low.alias("low"), high.alias("high"))).alias("bands")
    ).withColumn("bands", F.filter("bands", lambda b: b.low <= b.high))
    again = asking.join(limits, "number").where(F.size("bands") > 0).select("number", "id", "label", "ints", "bands")
    found = _met(rows, again, dim, groups, cells, negatives, True)
    order = Window.partitionBy("number", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    chosen = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    out = kept.store(
        chosen.select("number", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(best.select("number", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["number", "place"])
        .join(asking.select("number", F.col("id").alias("anchor_id")), "number")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
        "out",
    )
    tables.drop()
    return out
