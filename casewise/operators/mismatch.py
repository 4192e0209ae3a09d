"""Does the answer address the question? Scores, threshold and the worst cases."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewise.functions.numeric import sparse_dot
from casewise.functions.text import fill
from casewise.operators import tfidf

MAX_FEATURES = 5000
THRESHOLD = 0.5
# Fixed value: scores depend on the wording.
HYPOTHESIS = "This response addresses the farmer's concern: {question}"


def lexical_scores(
    calls: DataFrame,
    question: str = "question",
    answer: str = "answer",
    stop_words: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Add ``mismatch_score`` = 1 - cosine of question and answer.

    The vocabulary is fitted on questions and answers together (U1), so a corpus of n rows
    has 2n texts. Scoring is per row and needs no row id and no shuffle.
    """
    stop = tfidf.english_stop_words() if stop_words is None else list(stop_words)
    rows = calls.withColumns(
        {"_q": tfidf.text_terms(F.col(question), stop), "_a": tfidf.text_terms(F.col(answer), stop)}
    )
    texts = rows.select(F.explode(F.array("_q", "_a")).alias("terms"))
    model = tfidf.fit(texts, max_features)
    vectors = model.weights(model.weights(rows, "_q", "_qv"), "_a", "_av")
    cosine = sparse_dot(
        F.col("_qv.indices"), F.col("_qv.weights"), F.col("_av.indices"), F.col("_av.weights")
    )
    return vectors.withColumn("mismatch_score", 1 - cosine).drop("_q", "_a", "_qv", "_av")


def entailment_scores(
    calls: DataFrame,
    scorer: Callable[[list[str], list[str]], list[float]],
    question: str = "question",
    answer: str = "answer",
    hypothesis: str = HYPOTHESIS,
    batch: int = 16,
) -> DataFrame:
    """Add ``mismatch_score`` = 1 - P(the answer entails the hypothesis).

    ``scorer(premises, hypotheses)`` is supplied by the user and runs in the executors on
    batches; it returns the entailment probability of each pair.
    """
    pairs = calls.withColumns(
        {"_premise": F.coalesce(F.col(answer), F.lit("")), "_hypothesis": fill(hypothesis, question=F.col(question))}
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores: list[float] = []
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                entail = scorer(part["_premise"].tolist(), part["_hypothesis"].tolist())
                scores += [1.0 - float(p) for p in entail]
            yield frame.assign(mismatch_score=scores)

    schema = T.StructType([*pairs.schema.fields, T.StructField("mismatch_score", T.DoubleType())])
    return pairs.mapInPandas(run, schema).drop("_premise", "_hypothesis")


def flag(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """M6: a score at the threshold counts as a mismatch; scores are compared to nine places, like similarities."""
    return scored.withColumn("is_mismatch", F.round("mismatch_score", 9) >= threshold)


def find_mismatches(calls: DataFrame, backend: str = "lexical", threshold: float = THRESHOLD, **options) -> DataFrame:
    """``mismatch_score`` and ``is_mismatch`` by the chosen backend."""
    backends = {"lexical": lexical_scores, "nli": entailment_scores}
    if backend not in backends:
        raise ValueError(f"unknown backend: {backend}")
    return flag(backends[backend](calls, **options), threshold)


def worst(scored: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """The rows with the highest score, ties by id."""
    return scored.orderBy(F.desc("mismatch_score"), id_col).limit(n)


def mismatch_by_segment(scored: DataFrame, segment: str) -> DataFrame:
    """Share of mismatches and number of calls per segment."""
    return scored.groupBy(segment).agg(
        F.avg(F.col("is_mismatch").cast("double")).alias("mismatch_rate"),
        F.count("is_mismatch").alias("n_calls"),
    )


def loop_and_mismatch(cases: DataFrame, scored: DataFrame, segment: str = "crop", min_calls: int = 5) -> DataFrame:
    """JN3, P11: per segment with enough calls, its loop rate next to its mismatch rate.

    ``cases`` has one row per case.
    """
    loops = cases.groupBy(segment).agg(
        F.avg("loop_rate").alias("loop_rate"), F.count("case_id").alias("n_cases")
    )
    return loops.join(mismatch_by_segment(scored, segment), segment).where(F.col("n_calls") >= min_calls)
