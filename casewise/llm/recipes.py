"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last bytes takes certain values, so equal stretches are cut alike wherever they
stand. The distinct chunks are gathered once, each task sending a chunk once however many documents hold it, and each
gets a verified identifier: its hash, and a number that tells apart different chunks of equal hash. A document is then the
ordered list of its identifiers, and documents are equal if and only if their lists are. Whole texts are never shuffled.

Texts are compared after lower-casing A-Z. Null counts as empty, and all empty texts are equal. Of equal texts the row
with the largest id stays; rows that share this id as well are all marked as kept, because nothing tells them apart. Rows
with a null id count in their group but never stay, unless all ids of the group are null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import Tables, added, lower, pieces
from casewise.operators.joins import split_join

#: A cut where the lowest bits of the rolling hash are zero gives chunks of about 1,000 bytes.
MASK_BITS = 10
#: Bytes that the rolling hash sees.
WINDOW = 32
#: Chunks have at least and at most so many bytes, the last of a text may have fewer.
LEAST, MOST = 256, 8192

_GEAR = np.random.default_rng(41).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last ``WINDOW`` bytes allows a cut."""
    value, step = _GEAR[data], 1
    while step < WINDOW:
        moved = np.zeros_like(value)
        moved[step:] = value[:-step] << np.uint32(step)
        value, step = value + moved, step * 2
    return np.flatnonzero((value >> np.uint32(32 - MASK_BITS)) == 0) + 1


def chunk_ends(length: int, cuts: np.ndarray) -> list[int]:
    """Ends of the chunks of one text; ``cuts`` are its allowed cuts in order."""
    ends, at = [], 0
    for cut in cuts.tolist():
        while cut - at > MOST:
            at += MOST
            ends.append(at)
        if cut - at >= LEAST and cut < length:
            ends.append(cut)
            at = cut
    while length - at > MOST:
        at += MOST
        ends.append(at)
    if length > at:
        ends.append(length)
    return ends


def _pieces(column: pa.Array) -> Iterator[list[bytes]]:
    """Normalised texts, a run of rows at a time."""
    for _, _, data, offsets in pieces(column):
        whole, raw = lower(data).tobytes(), offsets.tolist()
        yield [whole[a:b] for a, b in zip(raw, raw[1:])]


def _texts(column: pa.Array) -> Iterator[bytes]:
    for texts in _pieces(column):
        yield from texts


def _chunks(text: bytes) -> Iterator[bytes]:
    start = 0
    for end in chunk_ends(len(text), cut_points(np.frombuffer(text, np.uint8))):
        yield text[start:end]
        start = end


def _identity(chunk: bytes, bits: int) -> int:
    value = xxhash.xxh3_64_intdigest(chunk) >> (64 - bits)
    return value - (1 << 64) if value >> 63 else value


def _chunk_rows(bits: int):
    """Each chunk once for each run of rows; equal ones of other runs are merged before the shuffle."""
    def run(batches):
        for batch in batches:
            for texts in _pieces(batch.column(0)):
                found = {chunk: None for text in texts for chunk in _chunks(text)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_identity(c, bits) for c in found], pa.int64()), pa.array(list(found), pa.binary())], ["hash", "chunk"]
                )

    return run


def _recipe_rows(bits: int):
    def run(batches):
        for batch in batches:
            ids, counts, digests = [], [], []
            for text in _texts(batch.column(1)):
                own = [_identity(c, bits) for c in _chunks(text)]
                ids += own
                counts.append(len(own))
                digests.append(hashlib.sha256(text).hexdigest())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            recipes = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), recipes, pa.array(digests)], ["doc_id", "recipe", "text_sha256"])

    return run


def collisions(store: DataFrame) -> DataFrame:
    """(hash, chunk) -> (hash, chunk, number) of the chunks that share their hash with another chunk."""
    twice = store.groupBy("hash").count().where("count > 1").select("hash")
    return store.join(twice, "hash").withColumn("number", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))


def _told_apart(docs: DataFrame, recipes: DataFrame, clashing: DataFrame, bits: int) -> DataFrame:
    """Recipes in which chunks of clashing hashes carry their number; only their documents are read again.

    A text's digest is the key here, so equal rows need no number of their own.
    """
    def numbered(batches):
        for batch in batches:
            out = [[], [], [], []]
            for text in _texts(batch.column(0)):
                digest = hashlib.sha256(text).hexdigest()
                for place, chunk in enumerate(_chunks(text)):
                    for column, value in zip(out, (digest, place, _identity(chunk, bits), chunk)):
                        column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["text_sha256", "place", "hash", "chunk"]
            )

    used = docs.mapInArrow(numbered, "text_sha256 string, place int, hash bigint, chunk binary")
    found = (
        used.join(clashing, ["hash", "chunk"])
        .select("text_sha256", "place", "number").distinct()
        .groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
    )
    return recipes.join(found, "text_sha256", "left")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, recipe.

    text_sha256 is the digest of the normalised text; recipe lists the identifiers of its chunks, hashes of ``bits`` bits (the
    result is the same for any number; with few, chunks clash and are told apart). Recipes are stored once, in the shared folder.
    """
    tables, checked = Tables(docs.sparkSession), Tables(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    store = texts.mapInArrow(_chunk_rows(bits), "hash bigint, chunk binary").distinct()
    clashing = checked.store(collisions(store), "collisions")
    recipes = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _recipe_rows(bits), "doc_id bigint, recipe array<bigint>, text_sha256 string"
    )
    rows = tables.store(recipes, "recipes")
    if clashing.isEmpty():
        checked.drop()
        rows = rows.withColumn("numbers", F.lit(None).cast("array<struct<place:int,number:int>>"))
    else:
        rows = _told_apart(texts, rows, clashing, bits)
    rows = rows.withColumn("numbers", F.coalesce("numbers", F.array().cast("array<struct<place:int,number:int>>")))
    list_of = ["recipe", "numbers"]
    groups = rows.groupBy(*list_of).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return split_join(rows, groups, list_of, "inner").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "recipe"
    )


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, found by their id; rows equal in id and text stay once."""
    key, place = added(docs, "recipe_key", "recipe_place")
    coded = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("null"))
    stays = duplicates(docs, id_col, text_col).where("kept").select(coded("doc_id").alias(key)).distinct()
    first = Window.partitionBy(key, F.xxhash64(text_col)).orderBy(text_col)
    return (
        docs.withColumn(key, coded(id_col))
        .join(stays, key, "left_semi")
        .withColumn(place, F.row_number().over(first))
        .where(F.col(place) == 1)
        .select(*docs.columns)
    )
