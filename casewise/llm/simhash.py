"""Near duplicates by SimHash fingerprints and multi-index hashing.

1. Words are what lies between white space after lower-casing A-Z. A text's shingles are all runs of n words, repeats
   included, joined by one space; a text with fewer words is one shingle, and a text without words (or null) has none. Each
   shingle is hashed by XXH64 with seed 42. A bit of the fingerprint is 1 if it is 1 in more than half of the hashes, so
   without shingles the fingerprint is zero, which is linked like any other.
2. Equal fingerprints are one class. Fingerprints that differ in three bits or fewer differ in one bit at most in one of
   their two halves. So each is filed under each half, and is looked up under all values in the ball of radius one around
   each half; of two that differ there only the one with a 0 asks. What is found is verified over all 64 bits.
3. A table of ``CELLS`` counters, of the same size for any input, says how many fingerprints are filed under the keys of
   each cell. Questions to empty cells are not sent. Keys in crowded cells are left to the next level, in which the other
   half is split into two quarters and these again into two eighths, with balls of radius one each time, so a key that
   holds a large part of all fingerprints is dealt out again by more of its bits. The last level's keys have 56 bits, so
   256 fingerprints at most are filed under one of them, and nothing is ever left out.
4. Tasks gather the keys of their range as packed arrays and give back a spanning forest of the links they verified, never
   the pairs. The components of the forests come from alternating large and small stars.

A component is known by its smallest id; null ids are passed over, and a row whose component has none gets null. Repeated
rows are linked with each other. An empty table gives no rows. Other columns, also of the names used here, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import Tables, blob, lower, mixed, partitions, pieces, words
from casewise.llm.jaccard import components
from casewise.operators.joins import split_join

SEED, RADIUS = 42, 3
#: Cells of the table of counts, and slices in which it is added up.
CELLS, SLICES = 1 << 22, 16
#: A cell is crowded with more fingerprints than this and four times the mean of all cells.
CROWDED = 1024
#: Shingles hashed, fingerprints expanded, keys gathered before they are sent, and pairs verified at once.
SHINGLES, EXPANDED, HELD, PAIRS = 1 << 17, 1 << 13, 1 << 21, 1 << 21

#: Widths of the segments that each level adds to the key.
WIDTHS = (32, 16, 8)


# -- fingerprints ------------------------------------------------------------------------------


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between neighbours, and where each starts and ends."""
    kept = np.zeros(len(data) + 1, bool)
    turns = np.zeros(len(data) + 2, np.int8)
    turns[start] = 1
    turns[end] -= 1
    kept[:] = np.cumsum(turns[:-1], dtype=np.int8) > 0
    kept[end] = True  # one separator; at the end of all texts a byte of its own
    out = np.append(data, np.uint8(32))
    out[end] = 32
    length = end - start
    new = np.cumsum(length + 1) - length - 1
    return out[kept].tobytes(), new, new + length


def fingerprint_array(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The fingerprints of a run of texts, which are given in lower case."""
    rows = len(offsets) - 1
    out = np.zeros(rows, np.uint64)
    start, end, row = words(data, offsets)
    if not len(start):
        return out
    # words of neighbouring texts may touch, so each text is cut apart first
    touching = np.flatnonzero((start[1:] == end[:-1])) + 1
    if len(touching):
        at = start[touching]
        data = np.insert(data, at, 32)
        start = start + np.searchsorted(at, start, "right")
        end = end + np.searchsorted(at, end, "left")
    text, start, end = _joined(data, start, end)
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    shingles = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    total = int(shingles.sum())
    owner = np.repeat(np.arange(rows), shingles)
    place = np.arange(total) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[owner]
    last = np.minimum(place + n, first[owner] + count[owner]) - 1
    low, high = start[place], end[last]
    ones = np.zeros((rows, 64), np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, total, SHINGLES):
        to = min(total, at + SHINGLES)
        h = np.fromiter((hashed(text[a:b], SEED) for a, b in zip(low[at:to].tolist(), high[at:to].tolist())), np.uint64, to - at)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[at:to]
        new = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int32)
    bits = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint_rows(n: int):
    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                found = fingerprint_array(lower(data), offsets, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(found.view(np.int64))], ["doc_id", "fp"]
                )

    return run


def fingerprints(docs: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp (the fingerprint's 64 bits as a signed number)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_fingerprint_rows(n), "doc_id bigint, fp bigint")


# -- keys ----------------------------------------------------------------------------------------


def _paths(level: int) -> list[tuple[tuple[int, int], ...]]:
    """The segments (lowest bit, width) that make up a key, for each way of choosing one half at each level."""
    found = [((), 0, 64)]
    for width in WIDTHS[: level + 1]:
        found = [
            ((*chosen, (low + width * side, width)), low + width * (1 - side), width)
            for chosen, low, _ in found for side in (0, 1)
        ]
    return [chosen for chosen, _, _ in found]


def _mask(path) -> np.uint64:
    return np.uint64(sum(((1 << width) - 1) << low for low, width in path))


def _salt(path) -> np.uint64:
    """Keys of different paths differ, as far as hashes do."""
    return mixed(np.array([sum((low + 1) * 131 ** i for i, (low, _) in enumerate(path))], np.uint64))[0]


def _keys(fps: np.ndarray, path) -> np.ndarray:
    return mixed((fps & _mask(path)) ^ _salt(path))


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(42)).astype(np.int64)


def _balls(fps: np.ndarray, path, crowded: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, flipped bits, highest of these): each looked up under ``path`` after one flip at most in each segment.

    ``crowded`` tells for each level above which cells are left to the next one.
    """
    x, flips, top = fps, np.zeros(len(fps), np.uint64), np.zeros(len(fps), np.uint64)
    for level, (low, width) in enumerate(path):
        bits = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(low, low + width, dtype=np.uint64)])
        if radius < 2:  # one half is equal then
            bits = bits[:1]
        x, flips, top = (np.repeat(a, len(bits)) for a in (x, flips, top))
        flip = np.tile(bits, len(x) // len(bits))
        flips, top = flips | flip, np.maximum(top, flip)
        if level < len(path) - 1:
            deeper = crowded[level][_cell(_keys(x ^ flips, path[: level + 1]))]
            x, flips, top = x[deeper], flips[deeper], top[deeper]
    return x, flips, top


def _filed(fps: np.ndarray, path, crowded: list[np.ndarray]) -> np.ndarray:
    """The fingerprints filed under ``path``: those whose keys of all levels above are crowded."""
    for level in range(len(path) - 1):
        fps = fps[crowded[level][_cell(_keys(fps, path[: level + 1]))]]
    return fps


def _counted(level: int, above):
    """How many fingerprints are filed in each cell: (slice, cells, counts) in packed form."""
    def run(batches):
        crowded = above.value if above else []
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            keys = [_keys(_filed(fps, path, crowded), path) for path in _paths(level)]
            cells, counts = np.unique(_cell(np.concatenate(keys)), return_counts=True)
            cut = np.searchsorted(cells, np.arange(SLICES + 1) * (CELLS // SLICES))
            held = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays([
                pa.array(held, pa.int32()),
                pa.array([blob((cells[cut[i] : cut[i + 1]] - i * (CELLS // SLICES)).astype(np.uint32)) for i in held], pa.binary()),
                pa.array([blob(counts[cut[i] : cut[i + 1]].astype(np.uint32)) for i in held], pa.binary()),
            ], ["slice", "cells", "counts"])

    return run


def _added_up(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, cells, counts in zip(*(batch.column(c).to_pylist() for c in range(3))):
            own = total.setdefault(i, np.zeros(CELLS // SLICES, np.uint32))
            own[np.frombuffer(cells, np.uint32)] += np.frombuffer(counts, np.uint32)
    for i, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blob(counts)], pa.binary())], ["slice", "counts"])


def _cell_table(fps: DataFrame, level: int, above) -> np.ndarray:
    """The counts of all cells, which have one size for any input."""
    sent = fps.mapInArrow(_counted(level, above), "slice int, cells binary, counts binary")
    table = np.zeros((SLICES, CELLS // SLICES), np.uint32)
    for row in sent.repartitionById(SLICES, F.col("slice")).mapInArrow(_added_up, "slice int, counts binary").collect():
        table[row["slice"]] = np.frombuffer(row["counts"], np.uint32)
    return table.ravel()


# -- links -----------------------------------------------------------------------------------------


def _sent(level: int, parts: int, tables, radius: int):
    """What is filed and asked under the keys of one level: (part, number filed, keys, fingerprints) in packed form."""
    def of_block(fps, used, crowded):
        filed, asked = [], []
        for path in _paths(level):
            own = _filed(fps, path, crowded)
            key = _keys(own, path)
            at = used[_cell(key)]
            filed.append((key[at], own[at]))
            x, flips, top = _balls(fps, path, crowded, radius)
            asks = (top > 0) & ((x & top) == 0)
            x, flips = x[asks], flips[asks]
            key = _keys(x ^ flips, path)
            at = used[_cell(key)]
            asked.append((key[at], x[at]))
        return filed, asked

    def packed(filed, asked):
        sides = []
        for side in (filed, asked):
            keys, fps = (np.concatenate(c) for c in zip(*side))
            part = ((keys & np.uint64(0x3FFFFFFF)) * np.uint64(parts) >> np.uint64(30)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            # the part and 32 other bits are enough: what is found is verified
            keys = (keys >> np.uint64(30)).astype(np.uint32)[order]
            sides.append((keys, fps[order], np.searchsorted(part[order], np.arange(parts + 1))))
        held = np.flatnonzero(sum(np.diff(cut) for _, _, cut in sides))
        both = lambda c, p: np.concatenate([s[c][s[2][p] : s[2][p + 1]] for s in sides])
        return pa.RecordBatch.from_arrays([
            pa.array(held, pa.int32()), pa.array(np.diff(sides[0][2])[held], pa.int32()),
            pa.array([blob(both(0, p)) for p in held], pa.binary()), pa.array([blob(both(1, p)) for p in held], pa.binary()),
        ], ["part", "n_filed", "keys", "fps"])

    def run(batches):
        used, *crowded = tables.value
        filed, asked, size = [], [], 0
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), EXPANDED):
                more = of_block(fps[at : at + EXPANDED], used, crowded)
                filed += more[0]
                asked += more[1]
                size += sum(len(keys) for side in more for keys, _ in side)
                if size > HELD:
                    yield packed(filed, asked)
                    filed, asked, size = [], [], 0
        if filed:
            yield packed(filed, asked)

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the graph with the edges (a, b), for nodes other than the roots."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[u], parent[v]), np.maximum(parent[u], parent[v])
        open_ = low != high
        if not open_.any():
            break
        u, v, low, high = u[open_], v[open_], low[open_], high[open_]
        np.minimum.at(parent, high, low)
        while True:
            higher = parent[parent]
            if (higher == parent).all():
                break
            parent = higher
    own = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[own], nodes[parent[own]]


def _pairs(filed: np.ndarray, keys: np.ndarray, first: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place among ``keys``, place among the sorted keys ``filed``) of equal keys, ``PAIRS`` at once."""
    low = np.searchsorted(filed, keys, "left") if first is None else first
    count = np.searchsorted(filed, keys, "right") - low
    held = np.flatnonzero(count > 0)
    low, count = low[held], count[held]
    ends = np.cumsum(count)
    at = 0
    while at < len(held):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        own = count[at:to]
        inner = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        yield np.repeat(held[at:to], own), np.repeat(low[at:to], own) + inner
        at = to


def _linked(radius: int):
    def run(batches):
        filed, asked = [], []
        for batch in batches:
            for n, keys, fps in zip(*(batch.column(c).to_pylist() for c in range(1, 4))):
                keys, fps = np.frombuffer(keys, np.uint32), np.frombuffer(fps, np.uint64)
                filed.append((keys[:n], fps[:n]))
                asked.append((keys[n:], fps[n:]))
        if not filed:
            return
        (keys, fps), (ask_keys, ask_fps) = ([np.concatenate(c) for c in zip(*side)] for side in (filed, asked))
        filed.clear()
        asked.clear()
        order = np.argsort(keys, kind="stable")
        keys, fps = keys[order], fps[order]
        a, b, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
        # filed together: each with those after it; and each question with what is filed under its key
        for ask, own, first in ((keys, fps, np.arange(1, len(keys) + 1)), (ask_keys, ask_fps, None)):
            for i, j in _pairs(keys, ask, first):
                x, y = own[i], fps[j]
                near = np.bitwise_count(x ^ y) <= radius
                a.append(x[near])
                b.append(y[near])
                size += int(near.sum())
                if size > PAIRS:
                    low, high = forest(np.concatenate(a), np.concatenate(b))
                    a, b, size = [low], [high], 0
        low, high = forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, tables: Tables | None = None, crowded_at: int = CROWDED) -> DataFrame:
    """(a, b): links between distinct fingerprints (one bigint column), enough of them to connect every component."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"fingerprints can be linked at {RADIUS} differing bits at most")
    spark = fps.sparkSession
    tables = tables or Tables(spark)
    parts = partitions(spark)
    crowded: list[np.ndarray] = []
    found = None
    for level in range(len(WIDTHS)):
        last = level == len(WIDTHS) - 1
        above = spark.sparkContext.broadcast(crowded) if crowded else None
        counts = _cell_table(fps, level, above)
        full = counts > crowded_at + 4 * counts.mean()
        if last:
            full[:] = False
        shared = spark.sparkContext.broadcast([(counts > 0) & ~full, *crowded])
        sent = fps.mapInArrow(_sent(level, parts, shared, radius), "part int, n_filed int, keys binary, fps binary")
        near = sent.repartitionById(parts, F.col("part")).mapInArrow(_linked(radius), "a bigint, b bigint")
        near = tables.store(near, f"links-{level}")
        found = near if found is None else found.union(near)
        if not full.any():
            break
        crowded.append(full)
    return found


def near_duplicates(
    docs: DataFrame, n: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    crowded_at: int = CROWDED,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    tables, kept = Tables(docs.sparkSession), Tables(docs.sparkSession)
    rows = kept.store(fingerprints(docs, n, id_col, text_col), "rows")
    classes = tables.store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fp"), radius, tables, crowded_at), tables)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = kept.store(split_join(named, smallest, ["root"], "inner").select("fp", "component_id"), "answer")
    tables.drop()
    return split_join(rows, answer, ["fp"], "inner").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
