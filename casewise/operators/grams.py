"""Words and pairs of neighbouring words of texts, counted and looked up as numbers in Arrow batches.

The words are those of ``functions.text.words``: runs of two or more letters, digits and underscores of the lower-cased
text, without stop words; a pair is two words of a text that follow each other then. A task gives each distinct word of its
batch a number, so a text is a row of numbers and no string is built for a pair unless it is shown.

A pair occurs no more often than either of its words. So only words that are as frequent as the last of the wanted number of
words can be part of a pair among the most frequent terms, and the pairs of all other words are left out before they
are counted; the terms found, their counts and their order are those of a full count.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.session import durable

#: A character of a word, and the text that is cut into words at a time.
PART, SLICE_BYTES = r"[\p{L}\p{N}_]", 8 << 20
#: Words that a task holds to tell which pairs may be wanted.
HELD_WORDS = 1 << 20
COUNTS = "term string, cf bigint, df bigint"


def lowered(text: Column) -> Column:
    """A text as the functions below take it."""
    return F.lower(F.coalesce(text, F.lit("")))


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) in pieces of bounded size, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield first, texts.slice(first, last - first)
        first = last


@dataclass
class Words:
    """The distinct words of some texts, the words of all texts as places in them, and how many each text has."""

    names: pa.Array
    codes: np.ndarray
    counts: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def pairs(self, ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """(a * base + b for neighbours that both have a number, how many of them each text has); -1 is no number."""
        row, own = self.row, ids[self.codes]
        near = (row[1:] == row[:-1]) & (own[1:] >= 0) & (own[:-1] >= 0)
        return own[:-1][near] * np.int64(base) + own[1:][near], np.bincount(row[1:][near], minlength=len(self.counts))


def _letters() -> np.ndarray:
    """For each code point, whether it is part of a word."""
    points = np.delete(np.arange(0x110000), np.arange(0xD800, 0xE000))
    held = np.zeros(0x110000, bool)
    names = pa.array([*points.astype("<u4").tobytes().decode("utf-32-le")])
    held[points] = pc.match_substring_regex(names, PART).to_numpy(zero_copy_only=False)
    return held


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(bytes of words below 128, code points of words), made once in a process."""
    letters = _letters()
    return np.concatenate([letters[:128], np.zeros(128, bool)]), letters


def _in_words(text: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 texts, whether its character is part of a word."""
    low, letters = _tables()
    held = low[text]
    lead = np.flatnonzero(text >= 0xC0)
    if len(lead):
        size = 2 + (text[lead] >= 0xE0) + (text[lead] >= 0xF0)
        point = text[lead].astype(np.int64) & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | text[lead[more] + k] & 0x3F
        known = letters[point]
        for k in range(4):
            held[lead[known & (size > k)] + k] = True
    return held


def words_of(texts: pa.Array, stop_words: Sequence[str] = ()) -> Words:
    """The words of lower-cased texts without nulls."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    text = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(texts) else np.zeros(0, np.uint8)
    ends = ends - ends[0] if len(texts) else np.zeros(1, np.int64)
    held = _in_words(text)
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    at = ends[:-1][ends[:-1] < ends[1:]]  # a word ends with its text
    begins[at] = held[at]
    begins = np.flatnonzero(begins)
    letters = text[held]
    offsets = np.append((np.cumsum(held) - 1)[begins], len(letters)).astype(np.int64)
    flat = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = flat.dictionary_encode()
    names = coded.dictionary.cast(pa.string())
    wanted = pc.greater(pc.utf8_length(names), 1)
    if len(stop_words):
        wanted = pc.and_not(wanted, pc.is_in(names, pa.array(list(stop_words), pa.string())))
    keep = wanted.to_numpy(zero_copy_only=False)
    place = np.where(keep, np.cumsum(keep) - 1, -1)
    codes = place[coded.indices.to_numpy(zero_copy_only=False)] if len(begins) else np.zeros(0, np.int64)
    known = codes >= 0
    return Words(names.filter(wanted), codes[known], np.diff(np.searchsorted(begins[known], ends)))


def in_rows(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each row in order, and which of them are the first of their value in the row."""
    own, ends = numbers.copy(), np.cumsum(counts)
    for low, high in zip((ends - counts).tolist(), ends.tolist()):
        own[low:high].sort()
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    first[(ends - counts)[counts > 0]] = True
    return own, first


def _frequencies(codes: np.ndarray, counts: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """How often each number below ``n`` occurs, and in how many rows."""
    own, first = in_rows(codes.astype(np.int32), counts)
    return pa.array(np.bincount(own, minlength=n)), pa.array(np.bincount(own[first], minlength=n))


def _words_counted(stop_words: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                found = words_of(texts, stop_words)
                cf, df = _frequencies(found.codes, found.counts, len(found.names))
                yield pa.RecordBatch.from_arrays([found.names, cf, df], ["term", "cf", "df"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([0]), pa.array([batch.num_rows])], ["term", "cf", "df"])

    return run


def _pairs_counted(stop_words: Sequence[str], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                found = words_of(texts, stop_words)
                pairs, counts = found.pairs(ids_of(found.names, held), len(held))
                coded = pa.array(pairs).dictionary_encode()
                cf, df = _frequencies(coded.indices.to_numpy(zero_copy_only=False), counts, len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([coded.dictionary, cf, df], ["pair", "cf", "df"])

    return run


def ids_of(names: pa.Array, held: pa.Array) -> np.ndarray:
    """The place of each name among the held ones, or -1."""
    return pc.index_in(names, held).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _named(shared):
    """The texts of pairs, in place of the column ``pair``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            sides = np.divmod(batch.column("pair").to_numpy(zero_copy_only=False), max(1, len(held)))
            terms = pc.binary_join_element_wise(*(held.take(pa.array(side)) for side in sides), " ")
            columns = [terms if name == "pair" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, ["term" if name == "pair" else name for name in batch.schema.names])

    return run


def _least(words: DataFrame, n: int) -> int:
    """The frequency of the n-th word, 0 if there are fewer; different frequencies are few."""
    above = 0
    for row in words.groupBy("cf").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("cf")).toLocalIterator():
        above += row["n"]
        if above >= n:
            return row["cf"]
    return 0


def frequent_terms(docs: DataFrame, text: str, max_features: int, min_df: int, stop_words: Sequence[str] = ()) -> DataFrame | None:
    """(term, cf, df) of all terms that can be among the ``max_features`` most frequent ones that ``min_df`` texts have.

    The row with a null term counts the texts. None where the words that may be in such a pair are more than tasks hold.
    """
    texts, stop_words = docs.select(lowered(F.col(text)).alias("text")), tuple(stop_words)
    sums = [F.sum(c).alias(c) for c in ("cf", "df")]
    words = durable(texts.mapInArrow(_words_counted(stop_words), COUNTS).groupBy("term").agg(*sums))
    common = words.where(F.col("term").isNotNull() & (F.col("df") >= min_df))
    least = _least(common, max_features)
    common = common.where(F.col("cf") >= least)
    if common.count() > HELD_WORDS:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(common.select("term").toArrow().column(0).combine_chunks())
    pairs = texts.mapInArrow(_pairs_counted(stop_words, shared), "pair bigint, cf bigint, df bigint").groupBy("pair").agg(*sums)
    pairs = pairs.where((F.col("cf") >= least) & (F.col("df") >= min_df)).mapInArrow(_named(shared), COUNTS)
    return common.unionByName(words.where("term IS NULL")).unionByName(pairs)


# -- one vocabulary for each group of texts and one for all ---------------------------------------

GROUP = "category string, kept boolean"


def _by_group(batch: pa.RecordBatch, first: int, codes: np.ndarray, counts: np.ndarray, names: pa.Array) -> list[pa.Array]:
    """category, kept, name, cf, df of the numbered names in rows of a batch."""
    categories = batch.column("category").dictionary_encode()
    kept = batch.column("kept").to_numpy(zero_copy_only=False)
    group = (categories.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + kept)[first : first + len(counts)]
    own, new = in_rows(codes.astype(np.int64), counts)
    cells = pa.array(np.repeat(group, counts) * max(1, len(names)) + own).dictionary_encode()
    at = cells.indices.to_numpy(zero_copy_only=False)
    group, name = np.divmod(cells.dictionary.to_numpy(zero_copy_only=False), max(1, len(names)))
    n = len(group)
    return [
        categories.dictionary.take(pa.array(group // 2)), pa.array(group % 2 == 1), names.take(pa.array(name)),
        pa.array(np.bincount(at, minlength=n)), pa.array(np.bincount(at[new], minlength=n)),
    ]


def _group_words_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in slices(batch.column("text")):
            found = words_of(texts)
            yield pa.RecordBatch.from_arrays(
                _by_group(batch, first, found.codes, found.counts, found.names), ["category", "kept", "term", "cf", "df"]
            )


def _group_pairs_counted(shared, wanted):
    """Pairs of words that are both frequent in all rows, or in the kept rows of their category."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (everywhere, categories, within) = shared.value, wanted.value
        for batch in batches:
            known = ids_of(batch.column("category"), categories)
            known[~batch.column("kept").to_numpy(zero_copy_only=False)] = -1
            for first, texts in slices(batch.column("text")):
                found = words_of(texts)
                pairs, counts = found.pairs(ids_of(found.names, held), len(held))
                row = np.repeat(np.arange(len(counts)), counts)
                sides, category = np.divmod(pairs, max(1, len(held))), known[first:][row]
                good = everywhere[sides[0]] & everywhere[sides[1]]
                rest = np.flatnonzero(~good & (category >= 0)) if len(within) else np.zeros(0, np.int64)
                for side in sides if len(rest) else ():
                    cell = category[rest] * len(held) + side[rest]
                    rest = rest[within[np.minimum(np.searchsorted(within, cell), len(within) - 1)] == cell]
                good[rest] = True
                coded = pa.array(pairs[good]).dictionary_encode()
                counts = np.bincount(row[good], minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    _by_group(batch, first, coded.indices.to_numpy(zero_copy_only=False), counts, coded.dictionary),
                    ["category", "kept", "pair", "cf", "df"],
                )

    return run


def group_terms(docs: DataFrame, limits: DataFrame, top: str, within) -> DataFrame | None:
    """(space, term, cf, df) of all terms that the vocabularies ``limits`` (space, max_features, min_df) can need.

    ``docs`` has category, kept, and text, lower-cased and not null. The space ``top`` has the terms of all rows, that of a category,
    ``within(category)``, those of its kept rows. None where the words that may be in such a pair are more than tasks hold.
    """
    sums = [F.sum(c).alias(c) for c in ("cf", "df")]

    def spaces(counted: DataFrame) -> DataFrame:
        own = counted.where("kept").select(within(F.col("category")).alias("space"), "category", "term", "cf", "df")
        return counted.groupBy("term").agg(*sums).select(
            F.lit(top).alias("space"), F.lit(None).cast("string").alias("category"), "term", "cf", "df"
        ).unionByName(own)

    docs = docs.select("category", "kept", "text")
    keys = ["category", "kept"]
    words = docs.mapInArrow(_group_words_counted, f"{GROUP}, {COUNTS}").groupBy(*keys, "term").agg(*sums)
    bounds = F.broadcast(limits.select("space", "max_features", "min_df"))
    words = durable(spaces(durable(words)).join(bounds, "space").where(F.col("df") >= F.col("min_df")))
    # the frequency at which a space is full of words: words below it are in no pair that it needs
    above = Window.partitionBy("space").orderBy(F.desc("cf"))
    least = words.groupBy("space", "max_features", "cf").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(above)).where(
        F.col("upto") >= F.col("max_features")
    ).groupBy("space").agg(F.max("cf").alias("least"))
    words = durable(words.join(F.broadcast(least), "space", "left").where(F.col("cf") >= F.coalesce("least", F.lit(0))))
    if words.count() > HELD_WORDS:
        return None
    held = words.select("space", "category", "term").toArrow().combine_chunks()
    names, is_top = pc.unique(held.column("term")), pc.is_null(held.column("category")).to_numpy()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    place = ids_of(held.column("term"), names)
    everywhere = np.zeros(len(names), bool)
    everywhere[place[is_top]] = True
    categories = pc.unique(held.column("category").drop_null())
    categories = categories.combine_chunks() if isinstance(categories, pa.ChunkedArray) else categories
    own = np.sort(ids_of(held.column("category"), categories)[~is_top] * np.int64(len(names)) + place[~is_top])
    context = docs.sparkSession.sparkContext
    shared, wanted = context.broadcast(names), context.broadcast((everywhere, categories, own))
    counted = docs.mapInArrow(_group_pairs_counted(shared, wanted), f"{GROUP}, pair bigint, cf bigint, df bigint").groupBy(*keys, "pair").agg(*sums)
    pairs = spaces(durable(counted.mapInArrow(_named(shared), f"{GROUP}, {COUNTS}")))
    columns = ["space", "term", "cf", "df"]
    return durable(words.select(*columns).unionByName(pairs.select(*columns)))


# -- looking terms up -----------------------------------------------------------------------------


class HeldTerms:
    """A vocabulary of words and pairs as a task looks it up."""

    def __init__(self, terms: pa.Array, stop_words: Sequence[str]):
        sides = pc.split_pattern(terms, " ", max_splits=1)
        two = pc.equal(pc.list_value_length(sides), 2).to_numpy(zero_copy_only=False)
        self.stop_words = tuple(stop_words)
        self.held = pc.unique(sides.flatten())
        place = np.arange(len(terms))
        self.word = np.full(len(self.held), -1, np.int64)
        self.word[ids_of(terms.filter(pa.array(~two)), self.held)] = place[~two]
        both = ids_of(sides.filter(pa.array(two)).flatten(), self.held).reshape(-1, 2)
        keys = both[:, 0] * np.int64(len(self.held)) + both[:, 1]
        order = np.argsort(keys)
        self.keys, self.pair = keys[order], place[two][order]

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(places of the known terms of each text, how many each text has); words first, then pairs."""
        own = words_of(texts, self.stop_words)
        ids = ids_of(own.names, self.held)
        single = np.where(ids >= 0, self.word[ids], -1)[own.codes] if len(self.held) else np.full(len(own.codes), -1)
        n_single = np.bincount(own.row[single >= 0], minlength=len(texts))
        single = single[single >= 0]
        pairs, n_pairs = own.pairs(ids, len(self.held))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            known = self.keys[at] == pairs
            row = np.repeat(np.arange(len(texts)), n_pairs)
            pairs, n_pairs = self.pair[at[known]], np.bincount(row[known], minlength=len(texts))
        else:
            pairs, n_pairs = np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        counts = n_single + n_pairs
        starts = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.int64)
        out[np.repeat(starts - (np.cumsum(n_single) - n_single), n_single) + np.arange(len(single))] = single
        out[np.repeat(starts + n_single - (np.cumsum(n_pairs) - n_pairs), n_pairs) + np.arange(len(pairs))] = pairs
        return out, counts

    def weighted(self, texts: pa.Array, idf: np.ndarray, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the different terms of each text in order, their unit-length weights, how many each text has)."""
        places, counts = self.found(texts)
        own, first = in_rows(places, counts)
        row = np.repeat(np.arange(len(texts)), counts)[first]
        at = np.flatnonzero(first)
        tf = np.diff(np.append(at, len(own)))
        raw = (1 + np.log(tf) if sublinear else tf) * idf[own[at]]
        length = np.sqrt(np.bincount(row, raw * raw, len(texts)))
        return own[at], raw / length[row], np.bincount(row, minlength=len(texts))


def known_hashes(terms: DataFrame, text: Column) -> Column | None:
    """The 64-bit hashes of the terms of a text that a table of terms has; None where tasks cannot hold the table."""
    terms = durable(terms.select("term", F.xxhash64("term").alias("hash")).distinct())
    if terms.count() > HELD_WORDS:
        return None
    own = terms.toArrow().combine_chunks()
    names = pa.concat_arrays(own.column("term").chunks or [pa.array([], pa.string())])
    shared = terms.sparkSession.sparkContext.broadcast((HeldTerms(names, ()), own.column("hash").to_numpy()))

    @F.arrow_udf("array<bigint>")
    def hashes(texts: pa.Array) -> pa.Array:
        held, own = shared.value
        parts = [held.found(some) for _, some in slices(texts)]
        flat, counts = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(2))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(own[flat]))

    return hashes(lowered(text))
