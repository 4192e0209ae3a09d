"""Similarity join of texts on the Jaccard similarity of their word n-gram sets, by rare-first prefix filtering.

1. Texts become sets of hashed n-grams; equal sets are one class, known by a 64-bit hash of the set.
2. A set that is linked shares at least a certain number of its lowest n-grams (in hash order) with its partner. Classes
   that do not share so many with any other set are out. N-grams meet in packed arrays, each task telling the n-grams
   that occur twice within itself apart, so one that is everywhere is sent once by each task.
3. The n-grams of the remaining sets are put in rare-first order. Any order of n-grams is right as long as all sets use
   it, so the counts come from a table of ``CELLS`` cells, a bound that does not depend on the input. Two linked sets share
   an n-gram among their first n - ceil(t n) + 1.
4. Sets meet in these n-grams. First all meet the most central set of each n-gram (the one with the fewest rarer ones);
   afterwards only pairs of sets that are not yet known to be connected are looked at, so groups of near copies do not
   give all their pairs. Pairs pass the length filter and the positional filter, each pair once.
5. Each pair is verified once with the whole sets, after a suffix filter: the sets are cut at fixed hashes, and the
   differences between the sizes of the cuts bound the overlap.
6. Components of the links are found by alternating large and small stars.

Words are what lies between white space after lower-casing A-Z. A text with fewer words than n is one n-gram; a text
without words (or null) has an empty set, which is linked with nothing. A component is known by its smallest id; null ids
are passed over, and a row whose class and component have none gets null. Repeated rows are linked with each other. An
empty table gives no rows. Hashes of n-grams and of sets have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import Tables, blob, chained, lower, mixed, partitions, pieces, span_hashes, words
from casewise.operators.joins import split_join

#: Cells of the table of n-gram counts, and slices in which tasks send it.
CELLS, SLICES = 1 << 20, 16
#: N-grams that a task gathers before it sends them.
HELD = 1_000_000
#: Ids (8 bytes each, and 8 of their class) that are broadcast.
CHOSEN = 500_000
#: Rounds in which sets meet only a central one.
ROUNDS = 2
#: Fixed hashes at which the suffix filter cuts sets.
_CUTS = (np.arange(1, 16, dtype=np.uint64) << np.uint64(60))


# -- sets -----------------------------------------------------------------------------------


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-gram hashes, in order within each text; number of them for each text)."""
    start, end, row = words(data, offsets)
    rows = len(offsets) - 1
    hashes = span_hashes(data, start, end)
    per_row = np.bincount(row, minlength=rows)
    full = max(0, len(hashes) - n + 1)
    grams = chained(*(hashes[i : i + full] for i in range(n))) if full else np.zeros(0, np.uint64)
    inside = row[:full] == row[n - 1 : n - 1 + full] if full else np.zeros(0, bool)
    owner, grams = row[:full][inside], grams[inside]
    first = np.cumsum(per_row) - per_row
    for size in range(1, n):  # texts with fewer words
        short = np.flatnonzero(per_row == size)
        if len(short):
            owner = np.concatenate([owner, short])
            grams = np.concatenate([grams, chained(*(hashes[first[short] + i] for i in range(size)))])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.bincount(owner[new], minlength=rows)


def class_keys(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for empty ones."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams), dtype=np.uint64)])
        ends = np.cumsum(counts)
        sums = total[ends] - total[ends - counts]
        keys = mixed(sums + mixed(counts.astype(np.uint64)))
    return np.where(counts > 0, np.where(keys == 0, 1, keys), 0).view(np.int64)


def needed(n, t: tuple[int, int]):
    """Least overlap of a set of n with a linked one: ceil(t n)."""
    return -(-n * t[0] // t[1])


def extra(n, t: tuple[int, int]):
    """How many shared n-grams the filter of step 2 looks for in a set of n; it does not fall with n."""
    return np.maximum(1, n - needed(n, t))


def _set_rows(n: int):
    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                grams, counts = ngram_sets(lower(data), offsets, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(class_keys(grams, counts)), pa.array(counts, pa.int64())],
                    ["doc_id", "key", "n_shingles"],
                )

    return run


# -- which classes share enough ----------------------------------------------------------------


def _dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash range."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _meeting(n: int, t: tuple[int, int], parts: int):
    columns = ["part", "grams", "owner", "keys", "known"]

    def flush(held):
        grams, keys, sizes = (np.concatenate(x) for x in zip(*held))
        held.clear()
        _, first = np.unique(keys, return_index=True)  # a class once
        keep = np.zeros(len(keys), bool)
        keep[first] = True
        grams, owner = grams[np.repeat(keep, sizes)], np.repeat(np.arange(keep.sum()), sizes[keep])
        keys = keys[keep]
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(grams)))
        twice = np.repeat(count > 1, count)
        known = np.bincount(owner[twice], minlength=len(keys))
        # one entry for each n-gram: its owner, or nobody if several are known to share it
        sent = np.where(count > 1, -1, owner[at]).astype(np.int32)
        grams = grams[at]
        # the n-grams are the lowest ones of their sets, so their own high bits would fill the first parts only
        part = _dealt(mixed(grams), parts)
        order = np.argsort(part, kind="stable")
        grams, sent, part = grams[order], sent[order], part[order]
        cut = np.searchsorted(part, np.arange(parts + 1))
        rows = [i for i in range(parts) if cut[i] < cut[i + 1]]
        blobs = [[], [], []]
        for i in rows:
            own = sent[cut[i] : cut[i + 1]]
            distinct, place = np.unique(own, return_inverse=True)
            blobs[0].append(blob(grams[cut[i] : cut[i + 1]]))
            blobs[1].append(blob(place.astype(np.uint16 if len(distinct) < 1 << 16 else np.uint32)))
            blobs[2].append(blob(np.where(distinct < 0, 0, keys[np.maximum(distinct, 0)])))
        filled = np.flatnonzero(known)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs), pa.nulls(len(rows), pa.binary())], columns
        )
        spread = int(keys[0]) % parts
        yield pa.RecordBatch.from_arrays([
            pa.array([spread], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
            pa.array([blob(keys[filled])], pa.binary()), pa.array([blob(known[filled].astype(np.int64))], pa.binary()),
        ], columns)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                grams, counts = ngram_sets(lower(data), offsets, n)
                own = counts - needed(counts, t) + extra(counts, t)
                place = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
                low = grams[place < np.repeat(own, counts)]
                sizes = np.minimum(own, counts)
                filled = counts > 0
                if filled.any():
                    held.append((low, class_keys(grams, counts)[filled], sizes[filled]))
                    size += len(low)
                if size > HELD:
                    full, held, size = held, [], 0
                    yield from flush(full)
        if held:
            yield from flush(held)

    return run


def _sharing(parts: int):
    """n-grams of one part of the hash range -> how many n-grams of each class are shared, packed by parts of the classes."""
    def run(batches):
        grams, owners, counted = [], [], ([], [])
        for batch in batches:
            for own, place, keys, known in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                keys = np.frombuffer(keys, np.int64)
                if known is not None:
                    counted[0].append(keys)
                    counted[1].append(np.frombuffer(known, np.int64))
                    continue
                own = np.frombuffer(own, np.uint64)
                place = np.frombuffer(place, np.uint16 if len(place) == 2 * len(own) else np.uint32)
                grams.append(own)
                owners.append(keys[place])
        if grams:
            grams, owners = np.concatenate(grams), np.concatenate(owners)
            _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
            keys, shared = np.unique(owners[(count[inverse] > 1) & (owners != 0)], return_counts=True)
            counted[0].append(keys)
            counted[1].append(shared.astype(np.int64))
        if counted[0]:
            keys, shared = _tallied(*counted)
            part = _dealt(mixed(keys.view(np.uint64)), parts)
            order = np.argsort(part, kind="stable")
            keys, shared = keys[order], shared[order]
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            rows = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int32()), pa.array([blob(keys[cut[i] : cut[i + 1]]) for i in rows], pa.binary()),
                pa.array([blob(shared[cut[i] : cut[i + 1]]) for i in rows], pa.binary()),
            ], ["part", "keys", "shared"])

    return run


def _tallied(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)


def _added(batches):
    """One row for each class of a part."""
    counted = ([], [])
    for batch in batches:
        for keys, shared in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            counted[0].append(np.frombuffer(keys, np.int64))
            counted[1].append(np.frombuffer(shared, np.int64))
    if counted[0]:
        keys, shared = _tallied(*counted)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(shared)], ["key", "shared"])


# -- rare-first prefixes ------------------------------------------------------------------------


def _cell_counts(batches):
    total = np.zeros(CELLS, np.uint32)
    for batch in batches:
        for grams in batch.column(0).to_pylist():
            np.add.at(total, (np.frombuffer(grams, np.uint64) >> np.uint64(44)).astype(np.int64), 1)
    for i, part in enumerate(np.split(total, SLICES)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blob(part)], pa.binary())], ["slice", "counts"])


def _add_cells(batches):
    total = {}
    for batch in batches:
        for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(counts, np.uint32)
    for i, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blob(counts)], pa.binary())], ["slice", "counts"])


def _prefixes(shared, t):
    def run(batches):
        cells = shared.value
        for batch in batches:
            out = [[], [], [], []]
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = np.frombuffer(raw, np.uint64)
                count = cells[(grams >> np.uint64(44)).astype(np.int64)]
                order = np.lexsort((grams, count))[: len(grams) - needed(len(grams), t) + 1]
                met = np.flatnonzero(count[order] > 1)  # a cell of one is a set of its own
                for column, values in zip(out, (grams[order[met]].view(np.int64), np.full(len(met), key), np.full(len(met), len(grams)), met)):
                    column.append(values)
            flat = [np.concatenate([np.zeros(0, np.int64), *c]) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in flat], ["gram", "key", "n", "at"])

    return run


def _passes(t: tuple[int, int], n1: Column, at1: Column, n2: Column, at2: Column) -> Column:
    """Length filter and positional filter."""
    overlap = F.least(n1 - at1, n2 - at2)
    return (F.least(n1, n2) * t[1] >= F.greatest(n1, n2) * t[0]) & (overlap * (t[0] + t[1]) >= (n1 + n2) * t[0])


def _verified(pairs: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that are linked."""
    side = lambda name: sets.select(F.col("key").alias(name), F.col("grams").alias(f"grams_{name}"))
    both = split_join(split_join(pairs, side("b"), ["b"], "inner"), side("a"), ["a"], "inner").select("a", "b", "grams_a", "grams_b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n = len(x) + len(y)
                least = -(-n * t[0] // (t[0] + t[1]))
                parts = np.diff(np.searchsorted(x, _CUTS), prepend=0, append=len(x)), np.diff(np.searchsorted(y, _CUTS), prepend=0, append=len(y))
                keep.append(np.minimum(*parts).sum() >= least and len(np.intersect1d(x, y, assume_unique=True)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


# -- components -----------------------------------------------------------------------------------


def components(links: DataFrame, tables: Tables, name: str = "star") -> DataFrame:
    """(a, b) -> (node, root): the smallest node of each component, for nodes other than the root."""
    edges = tables.store(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, turn = None, 0
    while True:
        # large star: all larger neighbours of a node go to the smallest one
        around = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = around.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = split_join(around, least, ["u"], "inner").where("v > u AND v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # small star: a node and its smaller neighbours go to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = split_join(large, low, ["u"], "inner")
        pairs = small.select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u").alias("u"), F.col("low").alias("v"))
        ))).where("u != v").distinct()
        turn += 1
        edges = tables.store(pairs, f"{name}-{turn}")
        found = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(found) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(found)


# -- the join ---------------------------------------------------------------------------------------


def _links(docs: DataFrame, classes: DataFrame, n: int, t: tuple[int, int], tables: Tables) -> DataFrame:
    """(a, b): linked classes, enough of them to connect every component."""
    spark = docs.sparkSession
    parts = partitions(spark)
    met = docs.select("text").mapInArrow(_meeting(n, t, parts), "part int, grams binary, owner binary, keys binary, known binary")
    packed = met.repartitionById(parts, F.col("part")).mapInArrow(_sharing(parts), "part int, keys binary, shared binary")
    shared = packed.repartitionById(parts, F.col("part")).mapInArrow(_added, "key bigint, shared bigint")
    # the partner of a set of n may be as small as ceil(t n), so that many n-grams less are certain
    smaller = F.ceil(F.col("n") * t[0] / t[1])
    certain = F.greatest(F.lit(1), smaller - F.ceil(smaller * t[0] / t[1]))
    chosen = tables.store(
        split_join(classes, shared, ["key"], "inner").where(F.col("shared") >= certain).select("key", F.col("first_id").alias("id")), "chosen"
    )

    def whole(batches):
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                grams, counts = ngram_sets(lower(data), offsets, n)
                ends = np.cumsum(counts)
                keys = class_keys(grams, counts)
                # a class once; a text of another class has the same id, and a text without an id has no class yet
                asked = batch.column(0).slice(low, high - low).fill_null(0).to_numpy()
                own = np.flatnonzero((keys != 0) & ((asked == 0) | (keys == asked)))
                own = own[np.unique(keys[own], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[own]), pa.array([blob(grams[ends[i] - counts[i] : ends[i]]) for i in own], pa.binary()),
                ], ["key", "grams"])

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    named, unnamed = chosen.where("id IS NOT NULL"), chosen.where("id IS NULL").select("key")
    # the texts stay where they are while the ids of the chosen classes are few enough to be sent to them
    few = named.count() <= CHOSEN
    found = texts.join(F.broadcast(named) if few else named.hint("merge"), "id").select("key", "text")
    found = found.mapInArrow(whole, "key bigint, grams binary")
    if not unnamed.isEmpty():
        lost = texts.where("id IS NULL").select(F.lit(None).cast("bigint").alias("key"), "text").mapInArrow(whole, "key bigint, grams binary")
        found = found.unionByName(lost.join(unnamed, "key", "left_semi"))
    sets = tables.store(found.dropDuplicates(["key"]), "sets")
    cells = sets.select("grams").mapInArrow(_cell_counts, "slice int, counts binary")
    table = np.zeros(CELLS, np.uint32)
    for row in cells.repartitionById(SLICES, F.col("slice")).mapInArrow(_add_cells, "slice int, counts binary").collect():
        table[row["slice"] * (CELLS // SLICES) : (row["slice"] + 1) * (CELLS // SLICES)] = np.frombuffer(row.counts, np.uint32)
    cells = spark.sparkContext.broadcast(table)
    prefixes = tables.store(sets.mapInArrow(_prefixes(cells, t), "gram bigint, key bigint, n bigint, at bigint"), "prefixes")

    def ordered(left: str, right: str) -> list[Column]:
        return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]

    members = prefixes.withColumn("root", F.col("key"))
    looked, links = None, None
    for turn in range(ROUNDS + 1):
        # the most central set of each n-gram, and the sets not known to be connected with it
        hubs = members.groupBy("gram").agg(
            F.min(F.struct("at", "n", "key", "root")).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high")
        ).where("low != high").select("gram", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.at").alias("hub_at"), F.col("hub.root").alias("hub_root"))
        outside = split_join(members, hubs, ["gram"], "inner").where("root != hub_root")
        if turn < ROUNDS:
            found = outside.where(_passes(t, F.col("n"), F.col("at"), F.col("hub_n"), F.col("hub_at"))).select(*ordered("key", "hub"))
        else:
            # whatever is left: each set outside with the sets of other components
            out = tables.store(outside.select("gram", "key", "n", "at", "root", "hub_root"), "outside")
            other = members.select("gram", *(F.col(c).alias(f"{c}2") for c in ("key", "n", "at", "root")))
            near = split_join(out, other, ["gram"], "inner").where(
                (F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("hub_root")) | (F.col("key") < F.col("key2")))
                & _passes(t, F.col("n"), F.col("at"), F.col("n2"), F.col("at2"))
            )
            found = near.select(*ordered("key", "key2"))
        pairs = found.distinct()
        if looked is not None:
            pairs = pairs.join(looked, ["a", "b"], "left_anti")
        pairs = tables.store(pairs, f"pairs-{turn}")
        good = tables.store(_verified(pairs, sets, t), f"links-{turn}")
        looked = pairs if looked is None else looked.union(pairs)
        links = good if links is None else links.union(good)
        if turn < ROUNDS:
            roots = components(links, tables, f"round-{turn}").withColumnRenamed("node", "key").withColumnRenamed("root", "found")
            members = tables.store(
                prefixes.join(roots, "key", "left").withColumn("root", F.coalesce("found", "key")).drop("found"), f"members-{turn}"
            )
    return links


def joined(
    docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    tables = Tables(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = tables.store(texts.mapInArrow(_set_rows(n), "doc_id bigint, key bigint, n_shingles bigint"), "rows")
    classes = rows.where("key != 0").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    links = _links(texts, classes, n, threshold, tables)
    roots = components(links, tables)
    named = classes.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = named.join(smallest, "root").select("key", "component_id")
    return split_join(rows, answer, ["key"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("key") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; rows without an id stay."""
    found = joined(docs, n, threshold, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    with_id = docs.where(F.col(id_col).isNotNull())
    kept = with_id.join(found, with_id[id_col] == found.kept_id, "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
