"""Similar past questions: by TF-IDF cosine or by embedding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators import inverted, pivots, tfidf
from casewise.operators.joins import BROADCAST_ROWS
from casewise.operators.topk import top_k
from casewise.session import durable

MAX_FEATURES = 8000
PAYLOAD = ("question", "answer", "crop", "category")


def _with_payload(best: DataFrame, corpus: DataFrame, id_col: str, payload: Sequence[str]) -> DataFrame:
    """Look the shown columns up for the found rows only, broadcasting those if they are few."""
    found = best.withColumnRenamed("id", id_col)
    if not payload:
        return found
    found = durable(found)
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return corpus.select(id_col, *payload).join(found, id_col).select(
        "query_id", id_col, *payload, "similarity", "rank"
    )


class TfidfRetriever:
    """Fit on a corpus once, then answer any number of queries."""

    def __init__(self, max_features: int = MAX_FEATURES, stop_words: Sequence[str] | None = None):
        self.max_features = max_features
        self.stop_words = tfidf.english_stop_words() if stop_words is None else list(stop_words)

    def fit(self, corpus: DataFrame, text_col: str = "question", id_col: str = "call_id") -> TfidfRetriever:
        self.corpus, self.text_col, self.id_col = corpus, text_col, id_col
        docs = corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.model = tfidf.fit(docs, self.max_features, terms="text", stop_words=self.stop_words)
        self.index, self.lists = self._vectors(docs), None
        return self

    def _vectors(self, docs: DataFrame) -> DataFrame:
        return self.model.weights(docs, "text").select("id", "vec.indices", "vec.weights")

    def save_index(self, path: str) -> TfidfRetriever:
        """Keep the weighted corpus, so that later queries read vectors instead of texts."""
        self.index.write.mode("overwrite").parquet(path)
        self.index = self.index.sparkSession.read.parquet(path)
        return self

    def save_lists(self, path: str) -> TfidfRetriever:
        """Keep an inverted index as well: queries then read the tops of the lists of their terms."""
        self.lists = inverted.build(self.index, path)
        return self

    def query(
        self, queries: DataFrame, k: int = 5, text_col: str = "text", query_id: str = "query_id",
        payload: Sequence[str] = PAYLOAD,
    ) -> DataFrame:
        """Per query the k most similar rows; terms the corpus does not have are ignored."""
        asked = self._vectors(queries.select(F.col(query_id).alias("id"), F.col(text_col).alias("text")))
        best = self.lists.top_k(asked, k) if self.lists else top_k(self.index, asked, k)
        return _with_payload(best, self.corpus, self.id_col, payload)


class EmbeddingRetriever:
    """Exact inner product over a column of unit-length embeddings."""

    def fit(self, corpus: DataFrame, vector_col: str = "embedding", id_col: str = "call_id") -> EmbeddingRetriever:
        self.corpus, self.id_col = corpus, id_col
        named = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("values"))
        self.index, self.blocks = named.where(F.col("values").isNotNull()), None
        return self

    def save_blocks(self, path: str) -> EmbeddingRetriever:
        """Keep the vectors in blocks around pivots: queries then skip blocks that are too far away."""
        self.blocks = pivots.build(self.index, path)
        return self

    def query(
        self, queries: DataFrame, k: int = 5, vector_col: str = "embedding", query_id: str = "query_id",
        payload: Sequence[str] = PAYLOAD,
    ) -> DataFrame:
        asked = queries.select(F.col(query_id).alias("id"), F.col(vector_col).alias("values")).where(F.col("values").isNotNull())
        best = self.blocks.top_k(asked, k) if self.blocks else top_k(self.index, asked, k, dense=True)
        return _with_payload(best, self.corpus, self.id_col, payload)


def build_retriever(corpus: DataFrame, backend: str = "tfidf", **options) -> TfidfRetriever | EmbeddingRetriever:
    """X8."""
    if backend == "tfidf":
        return TfidfRetriever().fit(corpus, **options)
    if backend == "embedding":
        return EmbeddingRetriever().fit(corpus, **options)
    raise ValueError(f"unknown backend: {backend}")


def above(found: DataFrame, floor: float = 0.03) -> DataFrame:
    """Drop matches that are hardly similar."""
    return found.where(F.col("similarity") > floor)
