"""TF-IDF: smooth idf, optional sublinear tf, unit length rows, a vocabulary of any size.

The vocabulary is found by one partially aggregated count of the terms. Up to ``HELD_TERMS``
terms travel with the tasks, and weighting a text needs no shuffle: a row goes in and its
sparse vector comes out, in the JVM. A larger vocabulary stays a table that is ranked by
ranges and joined by term, with the same results.

The column that is fitted and weighted holds lists of terms, or, where stop words are given (none of them is an empty
list), texts: their words and pairs of words are counted and weighted as numbers (``grams``), and only those that may
belong to the vocabulary are counted at all.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.functions.text import let, term_counts, without, word_ngrams, words
from casewise.operators import grams
from casewise.operators.dictionary import ranked_terms
from casewise.operators.joins import split_join
from casewise.session import durable

#: A vocabulary of up to so many terms is held by every task.
HELD_TERMS = 100_000


def english_stop_words() -> list[str]:
    """Spark's own English list; pass another list where results must match another tool."""
    return StopWordsRemover.loadDefaultStopWords("english")


def text_terms(text: Column, stop_words: Sequence[str] = (), max_n: int = 2) -> Column:
    """Stop words go before the n-grams are built, so "rust on leaf" has "rust leaf"."""
    return word_ngrams(without(words(F.coalesce(text, F.lit(""))), stop_words), max_n)


def term_statistics(docs: DataFrame, terms: str = "terms") -> DataFrame:
    """Per term its corpus frequency ``cf`` and document frequency ``df``.

    The row with a null term counts the documents. Terms are counted inside each row first,
    so a term reaches the shuffle once per document at most, and once per task after the
    partial aggregation.
    """
    marker = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf")))
    return (
        docs.select(F.inline(F.concat(marker, term_counts(F.col(terms)))))
        .groupBy("term")
        .agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    )


def _statistics(docs: DataFrame, max_features: int, min_df: int, terms: str, stop_words: Sequence[str] | None) -> DataFrame:
    """Term statistics of a column of terms or texts, of texts only those that a vocabulary of this size needs."""
    if stop_words is None:
        return term_statistics(docs, terms)
    found = grams.frequent_terms(docs, terms, max_features, min_df, stop_words)
    return term_statistics(docs.select(text_terms(F.col(terms), stop_words).alias(terms)), terms) if found is None else found


def vocabulary(
    docs: DataFrame, max_features: int, min_df: int = 1, terms: str = "terms", stop_words: Sequence[str] | None = None
) -> DataFrame:
    """The most frequent terms with ``cf``, ``df`` and idf = ln((1+N)/(1+df)) + 1."""
    if max_features > HELD_TERMS:
        return _term_table(docs, max_features, min_df, terms, stop_words).select("term", "cf", "df", "idf")
    stats = _statistics(docs, max_features, min_df, terms, stop_words)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()  # counts rows without reading their terms
    return (
        stats.where(F.col("term").isNotNull() & (F.col("df") >= min_df))
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
        .select("term", "cf", "df", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))
    )


def _term_table(docs: DataFrame, max_features: int, min_df: int, terms: str, stop_words: Sequence[str] | None) -> DataFrame:
    """term, hash, idx, cf, df, idf of a vocabulary that the plan does not hold."""
    stats = durable(_statistics(docs, max_features, min_df, terms, stop_words))
    space = F.lit("all").alias("space")
    limits = stats.where("term IS NULL").select(
        space, F.col("df").alias("n_docs"), F.lit(max_features).alias("max_features"), F.lit(min_df).alias("min_df")
    )
    return ranked_terms(stats.where("term IS NOT NULL").select(space, "term", "cf", "df"), limits).drop("space")


def literal_doubles(values: Sequence[float]) -> Column:
    """A constant array; parsed once when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def idf(n_docs: int, df: int) -> float:
    """The smooth idf of one term."""
    return math.log((1 + n_docs) / (1 + df)) + 1


def _text_weights(df: DataFrame, text: str, out: str, held: grams.HeldTerms, idf: Sequence[float], sublinear: bool) -> DataFrame:
    """Add ``out`` for a column of texts and a vocabulary that the tasks hold."""
    shared = df.sparkSession.sparkContext.broadcast((held, np.array(idf, np.float64)))

    @F.arrow_udf("struct<indices: array<int>, weights: array<double>>")
    def vectors(texts: pa.Array) -> pa.Array:
        held, idf = shared.value
        parts = [held.weighted(own, idf, sublinear) for _, own in grams.slices(texts)]
        indices, weights, counts = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (indices.astype(np.int32), weights.astype(np.float64))]
        return pa.StructArray.from_arrays(lists, ["indices", "weights"])

    return df.withColumn(out, vectors(grams.lowered(F.col(text))))


def _text_table(df: DataFrame, id_col: str, text: str, held: grams.HeldTerms, terms: pa.Array, idf: Sequence[float], sublinear: bool) -> DataFrame:
    """X4 as rows (id, term, tfidf) for a column of texts and a vocabulary that the tasks hold."""
    shared = df.sparkSession.sparkContext.broadcast((held, terms, np.array(idf, np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, terms, idf = shared.value
        for batch in batches:
            for first, texts in grams.slices(batch.column(1)):
                places, weights, counts = held.weighted(texts, idf, sublinear)
                ids = batch.column(0).take(pa.array(first + np.repeat(np.arange(len(texts)), counts)))
                yield pa.RecordBatch.from_arrays([ids, terms.take(pa.array(places)), pa.array(weights)], [id_col, "term", "tfidf"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, grams.lowered(F.col(text)).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, term string, tfidf double")


@dataclass
class TfidfModel:
    """A fitted vocabulary: terms in index order, their idf, the tf scaling, and the stop words if it is one of texts."""

    terms: list[str]
    idf: list[float]
    sublinear: bool = False
    stop_words: Sequence[str] | None = None

    def weights(self, df: DataFrame, terms: str = "terms", out: str = "vec") -> DataFrame:
        """Add ``out``: struct of sorted ``indices`` and unit-length ``weights``."""
        if self.terms and self.stop_words is not None:
            held = grams.HeldTerms(pa.array(self.terms), self.stop_words)
            return _text_weights(df, terms, out, held, self.idf, self.sublinear)
        if not self.terms:
            empty = F.struct(
                F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("weights")
            )
            return df.withColumn(out, empty)
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol=terms, outputCol="_counts")
        counted = counter.transform(df).withColumn("_counts", F.unwrap_udt("_counts"))
        idf = literal_doubles(self.idf)

        def weight(i: Column, tf: Column) -> Column:
            return (1 + F.log(tf) if self.sublinear else tf) * F.get(idf, i)

        def unit(raw: Column) -> Column:
            norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda acc, x: acc + x * x))
            return let(norm, lambda length: F.transform(raw, lambda x: x / length))

        raw = F.zip_with("_counts.indices", "_counts.values", weight)
        return counted.withColumn(
            out, F.struct(F.col("_counts.indices").alias("indices"), let(raw, unit).alias("weights"))
        ).drop("_counts")

    def long_table(self, df: DataFrame, id_col: str, terms: str = "terms") -> DataFrame:
        """X4 as rows (id, term, tfidf)."""
        if self.terms and self.stop_words is not None:
            names = pa.array(self.terms)
            return _text_table(df, id_col, terms, grams.HeldTerms(names, self.stop_words), names, self.idf, self.sublinear)
        weighted = self.weights(df.select(id_col, terms), terms)
        names = F.from_json(F.lit(json.dumps(self.terms)), "array<string>")
        pairs = F.arrays_zip("vec.indices", "vec.weights")
        return weighted.select(id_col, F.inline(pairs)).select(
            id_col, F.get(names, F.col("indices")).alias("term"), F.col("weights").alias("tfidf")
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")


@dataclass
class TermTable:
    """A fitted vocabulary as a stored table: term, idx, idf, the tf scaling, and the stop words if it is one of texts.

    One of texts with up to ``grams.HELD_WORDS`` terms travels with the tasks in arrays, others are joined.
    """

    table: DataFrame
    sublinear: bool = False
    stop_words: Sequence[str] | None = None

    def _held(self) -> pa.Table | None:
        """The terms by their place, if tasks hold them."""
        if self.stop_words is None or not 0 < self.table.count() <= grams.HELD_WORDS:
            return None
        return self.table.select("term", "idx", "idf").toArrow().sort_by("idx").combine_chunks()

    def _listed(self, df: DataFrame, terms: str) -> DataFrame:
        return df if self.stop_words is None else df.withColumn(terms, text_terms(F.col(terms), self.stop_words))

    def _postings(self, rows: DataFrame, keys: Sequence[str], terms: str) -> DataFrame:
        """(keys, term, idx, raw): the known terms of each row; a term that most rows have is split by the join."""
        found = split_join(rows.select(*keys, F.inline(term_counts(F.col(terms)))), self.table.select("term", "idx", "idf"), ["term"], "inner")
        tf = 1 + F.log("tf") if self.sublinear else F.col("tf")
        return found.select(*keys, "term", "idx", (tf * F.col("idf")).alias("raw"))

    def weights(self, df: DataFrame, terms: str = "terms", out: str = "vec") -> DataFrame:
        """Add ``out``: struct of sorted ``indices`` and unit-length ``weights``."""
        if (own := self._held()) is not None:
            names, idf = own.column("term").combine_chunks(), own.column("idf").to_numpy()
            return _text_weights(df, terms, out, grams.HeldTerms(names, self.stop_words), idf, self.sublinear)
        rows = durable(df.withColumn("_row", F.monotonically_increasing_id()))
        pairs = F.sort_array(F.collect_list(F.struct("idx", "raw")))
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
        listed = self._listed(rows, terms)
        vectors = self._postings(listed, ["_row"], terms).groupBy("_row").agg(pairs.alias("_p"), length.alias("_length")).select(
            "_row",
            F.struct(
                F.transform("_p", lambda p: p.idx).alias("indices"), F.transform("_p", lambda p: p.raw / F.col("_length")).alias("weights")
            ).alias(out),
        )
        empty = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("weights"))
        return rows.join(vectors, "_row", "left").withColumn(out, F.coalesce(out, empty)).drop("_row")

    def long_table(self, df: DataFrame, id_col: str, terms: str = "terms") -> DataFrame:
        """X4 as rows (id, term, tfidf)."""
        if (own := self._held()) is not None:
            names, idf = own.column("term").combine_chunks(), own.column("idf").to_numpy()
            return _text_table(df, id_col, terms, grams.HeldTerms(names, self.stop_words), names, idf, self.sublinear)
        rows = self._listed(df, terms).select(id_col, terms).withColumn("_row", F.monotonically_increasing_id())
        pairs = F.collect_list(F.struct("term", "raw"))
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
        vectors = self._postings(rows, ["_row", id_col], terms).groupBy("_row", id_col).agg(pairs.alias("_p"), length.alias("_length"))
        return vectors.select(id_col, F.inline(F.transform("_p", lambda p: F.struct(p.term.alias("term"), (p.raw / F.col("_length")).alias("tfidf")))))


def fit(
    docs: DataFrame, max_features: int, min_df: int = 1, sublinear: bool = False, terms: str = "terms", stop_words: Sequence[str] | None = None
) -> TfidfModel | TermTable:
    """Fit on a column of terms, or of texts where ``stop_words`` are given."""
    if max_features > HELD_TERMS:
        return TermTable(
            durable(_term_table(docs, max_features, min_df, terms, stop_words).select("term", "idx", "idf")), sublinear, stop_words
        )
    stats = _statistics(docs, max_features, min_df, terms, stop_words)
    # the document count sorts first, so one job brings it with at most max_features terms
    rows = (
        stats.where(F.col("term").isNull() | (F.col("df") >= min_df))
        .orderBy(F.col("term").isNotNull(), F.desc("cf"), "term")
        .limit(max_features + 1)
        .collect()
    )
    n_docs = rows[0]["df"] if rows else 0
    kept = sorted((r["term"], r["df"]) for r in rows[1:])
    return TfidfModel([t for t, _ in kept], [idf(n_docs, df) for _, df in kept], sublinear, stop_words)
