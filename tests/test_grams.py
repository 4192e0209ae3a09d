import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casewise.operators import grams, hierarchy, tfidf
from casewise.operators.hierarchy import HierarchicalClassifier

rng = random.Random(3)
TEXTS = [None, "", "a", "Éa éA b_1 x 𝒜𝒜 नमस्ते, éa"] + [
    " ".join(rng.choice(["rust", "leaf", "The", "wheat", "spray", f"rare{i}", "x"]) for _ in range(rng.randint(1, 30))) for i in range(40)
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_words_in_batches_are_those_of_the_column_function(spark, docs):
    texts = [r[0] for r in docs.select(grams.lowered(F.col("text"))).collect()]
    found = grams.words_of(pa.array(["zz", *texts]).slice(1), ("rust",))
    flat = found.names.take(pa.array(found.codes)).to_pylist()
    expected = [r[0] for r in docs.select(tfidf.text_terms(F.col("text"), ["rust"], 1)).collect()]
    assert found.counts.tolist() == [len(x) for x in expected] and flat == [w for x in expected for w in x]


@pytest.mark.parametrize("n, min_df, sublinear", [(9, 1, False), (14, 3, True), (1000, 1, True), (1000, 2, False)])
@pytest.mark.parametrize("held", [True, False])
def test_F11_F5_texts_give_the_terms_and_weights_of_lists(docs, monkeypatch, n, min_df, sublinear, held):
    terms = docs.withColumn("terms", tfidf.text_terms(F.col("text"), ["the"]))
    expected = _sorted(tfidf.vocabulary(terms, n, min_df))
    weights = {r[:2]: r[2] for r in _sorted(tfidf.fit(terms, n, min_df, sublinear).long_table(terms, "id"))}
    if not held:  # the table of terms, joined
        monkeypatch.setattr(tfidf, "HELD_TERMS", 5)
    assert _sorted(tfidf.vocabulary(docs, n, min_df, "text", ["the"])) == expected
    model = tfidf.fit(docs, n, min_df, sublinear, "text", ["the"])
    if not held and n < 1000:
        monkeypatch.setattr(grams, "HELD_WORDS", 3)
    assert {r[:2]: r[2] for r in _sorted(model.long_table(docs, "id", "text"))} == pytest.approx(weights)
    vectors = model.weights(docs, "text").collect()
    assert len(vectors) == len(TEXTS)
    assert sorted(x for r in vectors for x in r["vec"]["weights"]) == pytest.approx(sorted(weights.values()))


def test_F11_pairs_of_rare_words_are_not_counted(docs):
    found = {r["term"] for r in grams.frequent_terms(docs, "text", 5, 1).collect()}
    assert {"rust", "leaf", "wheat"} <= found and not any("rare" in t for t in found if t) and None in found


def test_F11_more_words_than_tasks_hold(docs, monkeypatch):
    expected = _sorted(tfidf.vocabulary(docs, 9, 1, "text", ()))
    monkeypatch.setattr(grams, "HELD_WORDS", 2)
    assert _sorted(tfidf.vocabulary(docs, 9, 1, "text", ())) == expected


def test_F12_F15_F16_spaces_get_the_terms_of_a_full_count(spark, monkeypatch):
    """Pairs of words that are rare everywhere are wanted where they are frequent in one category."""
    rows = [(i, TEXTS[i % len(TEXTS)], ["a", "b", None][i % 3], f"t{i % 2}" if i % 5 else None) for i in range(120)]
    rows += [(200 + i, "only here only here", "c", f"t{i % 2}") for i in range(8)]
    calls = spark.createDataFrame(rows, "call_id int, question string, category string, query_type string").repartition(3)
    for name, n in (("TOP_TERMS", 9), ("TERMS", 6)):
        monkeypatch.setattr(hierarchy, name, n)
    monkeypatch.setattr(hierarchy.svm, "solve", lambda *_: spark.createDataFrame([], hierarchy.svm.WEIGHTS))
    found = HierarchicalClassifier().fit(calls).terms.select("space", "term", "idx", "idf")
    spaces = {r["space"] for r in found.collect()}
    assert spaces == {"categories", "within a", "within b", "within c"}
    assert {r["term"] for r in found.where("space = 'within c'").collect()} == {"only", "here", "only here", "here only"}
    found = _sorted(found)
    monkeypatch.setattr(grams, "group_terms", lambda *_: None)
    assert _sorted(HierarchicalClassifier().fit(calls).terms.select("space", "term", "idx", "idf")) == found


def test_F4_only_known_terms_of_a_text_are_hashed(spark, docs):
    terms = spark.createDataFrame([("rust",), ("leaf rust",), ("gone",)], "term string")
    hashes = {r["term"]: r["h"] for r in terms.select("term", F.xxhash64("term").alias("h")).collect()}
    known = docs.select("text", grams.known_hashes(terms, F.col("text")).alias("h")).collect()
    every = {r["id"]: r["h"] for r in docs.select("id", F.transform(tfidf.text_terms(F.col("text")), lambda t: F.xxhash64(t)).alias("h")).collect()}
    expected = sorted(sorted(x for x in every[i] if x in hashes.values()) for i in every)
    assert sorted(sorted(r["h"]) for r in known) == expected and sum(map(len, expected)) > 10
