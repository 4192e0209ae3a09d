"""Language identification with a string kernel.

A text is the set of its byte n-grams, in lower case, of 1 to ``LONGEST`` bytes (a blended spectrum by presence), and the kernel of two
texts is the size of the intersection of their sets over the geometric mean of the sizes. Some labelled texts are
landmarks (Nyström): the kernel is projected on them, and one ridge regression for each language, that language against
the rest, is fitted in their space. N-grams are hashed to ``FEATURES`` places.

A bounded sample is fitted, ``SAMPLE`` labelled texts of each language at most, those with the smallest hash of their id
and text; the landmarks are the first of them, in equal numbers for each language: ``LANDMARKS`` in all, and more from the
language on that would leave one with less than ``LEAST_MARKS``. All texts are scored whole. As each score is a sum over the
landmarks of products with presence, the landmarks' weights are multiplied out once, and a block of texts is scored by one
matrix product of presence and n-gram weights.

Null texts and texts without a letter are ``und`` with score 0. Null labels are not learned from. With no labelled text
all texts are ``und``, those with a letter with a null score; with one language all others get it. Ties go to the language
first in code point order. An empty table gives no rows. Other columns are kept; new columns that would clash get underscores
in front.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casewise.llm.common import added, lower, mixed, pieces

FEATURES, LONGEST = 1 << 15, 3
SAMPLE, LANDMARKS, LEAST_MARKS = 400, 64, 4
#: Weight of the ridge, and how steeply scores follow the margin between the languages.
RIDGE, SLOPE = 0.1, 4.0
#: Texts in one matrix product.
ROWS = 128

_SALT = mixed(np.arange(1, LONGEST * 256 + 1, dtype=np.uint64)).reshape(LONGEST, 256)


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = lower(data)
    capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[capital] += 0x20
    return out


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text: 1 for each hashed n-gram that it has."""
    rows = len(offsets) - 1
    found = np.zeros(rows * FEATURES, np.float32)
    row = np.repeat(np.arange(rows, dtype=np.int64) * FEATURES, np.diff(offsets))
    sums = np.zeros(len(data), np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))  # bytes up to the end of the text
    with np.errstate(over="ignore"):
        for n in range(min(LONGEST, len(data))):
            sums = sums[: len(data) - n] * np.uint64(0x100000001B3) + _SALT[n, data[n:]]
            place = (sums >> np.uint64(40)).astype(np.int64) * 0x9E37 >> 5 & (FEATURES - 1)
            whole = end[: len(data) - n] > n
            found[row[: len(data) - n][whole] + place[whole]] = 1
    return found.reshape(rows, FEATURES)


def _blocks(column: pa.Array):
    for low, high, data, offsets in pieces(column):
        data = folded(data)
        for first in range(0, high - low, ROWS):
            last = min(first + ROWS, high - low)
            yield low + first, low + last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def _packed(batches):
    for batch in batches:
        bits = [
            row.tobytes()
            for _, _, data, offsets in _blocks(batch.column(1))
            for row in np.packbits(presence(data, offsets) > 0, axis=1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["label", "bits"])


def sample(labelled: DataFrame, label_col: str, text_col: str, id_col: str, most: int = SAMPLE) -> DataFrame:
    """``most`` texts of each label: label, text, place. Ids and labels are looked at first, then the texts of these ids."""
    narrow = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("key"), F.col(label_col).alias("label"), F.col(text_col).alias("text")
    ).withColumn("place", F.xxhash64(F.lit(5), "key"))
    first = Window.partitionBy("label").orderBy("place", "key")
    chosen = narrow.select("key", "label", "place").withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)
    texts = narrow.join(F.broadcast(chosen.select("key", "label").distinct()), ["key", "label"], "left_semi")
    again = Window.partitionBy("label").orderBy("place", "key", F.xxhash64("text"))
    return texts.withColumn("n", F.row_number().over(again)).where(F.col("n") <= most).select("label", "text", "n")


def normed(sets: np.ndarray) -> np.ndarray:
    return sets / np.sqrt(np.maximum(sets.sum(1, keepdims=True), 1))


def fit(
    labelled: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
    most: int = SAMPLE, landmarks: int = LANDMARKS,
) -> tuple[list[str], np.ndarray]:
    """(labels, weight of each n-gram for each label, the last row being the constant)."""
    rows = (
        sample(labelled, label_col, text_col, id_col, most)
        .select("label", "text").mapInArrow(_packed, "label string, bits binary").orderBy("label", F.xxhash64("bits")).collect()
    )
    labels = sorted({row.label for row in rows})
    if not rows:
        return [], np.zeros((FEATURES + 1, 0), np.float32)
    # presence stays packed; blocks of texts are unpacked one at a time
    packed = np.array([np.frombuffer(row.bits, np.uint8) for row in rows])
    number = {label: i for i, label in enumerate(labels)}
    own = np.array([number[row.label] for row in rows])

    def unpacked(part: np.ndarray) -> np.ndarray:
        return normed(np.unpackbits(part, axis=1)[:, :FEATURES].astype(np.float32))

    # landmarks: the first texts of each label, in equal numbers; rows are in the order of their labels
    rank = np.arange(len(own)) - np.searchsorted(own, own)
    marks = unpacked(packed[np.argsort(rank, kind="stable")[: max(landmarks, LEAST_MARKS * len(labels))]])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > values.max() * 1e-6
    root = vectors[:, kept] / np.sqrt(values[kept])
    kernel = np.vstack([unpacked(packed[i : i + ROWS]) @ marks.T for i in range(0, len(packed), ROWS)])
    z = kernel @ root
    z = np.hstack([z, np.ones((len(z), 1))])
    wanted = np.where(own[:, None] == np.arange(len(labels)), 1.0, -1.0)
    share = 1 / np.bincount(own, minlength=len(labels))[own]
    weighted = z * share[:, None]
    solved = np.linalg.solve(z.T @ weighted + RIDGE * np.eye(z.shape[1]) / len(z) * share.sum(), weighted.T @ wanted)
    return labels, np.vstack([marks.T @ (root @ solved[:-1]), solved[-1:]]).astype(np.float32)


def predicted(docs: DataFrame, labels: Sequence[str], weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with lang_pred and score (0 to 1; null where a text has letters, but no label was learned)."""
    name, score_name = added(docs, "lang_pred", "score")
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((np.array(["und", *labels], object), np.asarray(weights)))

    def run(batches):
        labels, weights = shared.value
        for batch in batches:
            column = batch.column(place)
            letters = pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
            best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
            if len(labels) > 1:
                for low, high, data, offsets in _blocks(column):
                    values = (normed(presence(data, offsets)) @ weights[:-1] + weights[-1]).astype(np.float64)
                    best[low:high] = values.argmax(1) + 1
                    power = np.exp(SLOPE * (values - values.max(1, keepdims=True)))
                    score[low:high] = 1 / power.sum(1)
            best[~letters], score[~letters] = 0, 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[best], pa.string()), pa.array(score, mask=letters & (len(labels) == 1))],
                schema=pa.schema([*batch.schema, pa.field(name, pa.string()), pa.field(score_name, pa.float64())]),
            )

    return docs.mapInArrow(run, StructType.fromJson(docs.schema.jsonValue()).add(name, "string").add(score_name, "double"))


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the id's decimal digits leaves ``part`` modulo ``parts``; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))
