import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.functions import numeric, text
from casewise.operators import dictionary, mismatch, retrieval, tfidf, topk

DOCS = {
    1: "Leaf rust on wheat leaf, what to spray?",
    2: "spray for leaf rust",
    3: "éléphant et élève a b 12",
    4: "",
    5: "wheat price today",
    6: "spray for leaf rust",
}
STOP = ("on", "to", "for")


def python_terms(value, stop=()):
    words = [w for w in re.findall(r"\w{2,}", value.lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def python_tfidf(docs, max_features=None, min_df=1, sublinear=False):
    """Dense reference: {doc: {term: weight}}."""
    counts = {d: Counter(t) for d, t in docs.items()}
    df, cf = Counter(), Counter()
    for c in counts.values():
        df.update(c.keys())
        cf.update(c)
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-cf[t], t))[:max_features]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for d, c in counts.items():
        w = {t: (1 + math.log(n) if sublinear else n) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out[d] = {t: x / norm for t, x in w.items()} if norm else {}
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(DOCS.items()), "id int, text string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_F1_strip_is_unicode(spark):
    assert one(spark, text.strip(F.lit("  \t a b \n"))) == "a b"


def test_N11_words_are_unicode(spark):
    assert one(spark, text.words(F.lit("Élève a bc_1 नमस्ते"))) [:2] == ["élève", "bc_1"]


def test_X1_stop_words_go_before_bigrams(spark):
    terms = tfidf.text_terms(F.lit("rust on leaf, rust"), ["on"])
    assert one(spark, terms) == ["rust", "leaf", "rust", "rust leaf", "leaf rust"]
    assert one(spark, tfidf.text_terms(F.lit("a"), [])) == []
    assert one(spark, tfidf.text_terms(F.lit(None).cast("string"), [])) == []


def test_X2_char_ngrams(spark):
    grams = one(spark, text.char_ngrams(F.lit("Ab  c")))
    assert grams == [" a", "ab", "b ", " ab", "ab ", " ab ", " c", "c ", " c "]
    assert one(spark, text.char_ngrams(F.lit("a"), 4, 5)) == [" a "]
    assert one(spark, text.char_ngrams(F.lit(""))) == []


def test_term_counts(spark):
    found = one(spark, text.term_counts(F.split(F.lit("b a b c b"), " ")))
    assert [(r.term, r.tf) for r in found] == [("a", 1), ("b", 3), ("c", 1)]


def test_F7_F8_F9_display(spark):
    assert one(spark, text.truncate(F.lit(None).cast("string"), 5)) == ""
    assert one(spark, text.truncate(F.lit("abcd efgh"), 5)) == "abcd…"
    assert one(spark, text.truncate(F.lit("abcde"), 5)) == "abcde"
    assert [one(spark, text.percent(F.lit(x))) for x in (0.625, 0.615, 1.0)] == ["62%", "62%", "100%"]
    assert one(spark, text.number(F.lit(0.285))) == "0.28"
    assert one(spark, text.percent(F.lit(None).cast("double"))) is None
    assert one(spark, text.plural(F.lit(1), "step")) == "1 step"


def test_F4_values_are_not_read_as_fields(spark):
    filled = text.fill("Q: {question} A: {answer}", question=F.lit("{answer}"), answer=F.lit("b"))
    assert one(spark, filled) == "Q: {answer} A: b"


def test_M2_M3_confidences(spark):
    scores = [1.0, 3.0, -2.0]
    expected = math.exp(3) / sum(math.exp(s) for s in scores)
    assert one(spark, numeric.softmax_at(F.array(*map(F.lit, scores)), F.lit(1))) == pytest.approx(expected)
    assert one(spark, numeric.sigmoid(F.lit(0.7))) == pytest.approx(1 / (1 + math.exp(-0.7)))


def test_A13_verdict_has_no_gap_at_the_bounds(spark):
    found = [one(spark, numeric.correlation_verdict(F.lit(x).cast("double"))) for x in (0.3, 0.2, -0.3, None, float("nan"))]
    assert found == ["together", "weak", "opposite", "undefined", "undefined"]


def test_A13_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 3.0), (3.0, 7.0, 3.0)], "a double, b double, c double")
    row = df.agg(numeric.pearson("a", "b").alias("ab"), numeric.pearson("a", "c").alias("ac")).first()
    assert row["ab"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1]) and row["ac"] is None


@pytest.mark.parametrize("options", [{}, {"max_features": 7}, {"min_df": 2, "sublinear": True}])
def test_X3_X4_tfidf(docs, options):
    terms = docs.withColumn("terms", tfidf.text_terms(F.col("text")))
    model = tfidf.fit(terms, options.get("max_features", 100), options.get("min_df", 1), options.get("sublinear", False))
    expected = python_tfidf({d: python_terms(t) for d, t in DOCS.items()}, **options)
    found = {d: {} for d in DOCS}
    for r in model.long_table(terms, "id").collect():
        found[r["id"]][r["term"]] = r["tfidf"]
    assert found.keys() == expected.keys()
    for d in DOCS:
        assert found[d] == pytest.approx(expected[d])


def test_X4_transform_has_no_shuffle(docs):
    terms = docs.withColumn("terms", tfidf.text_terms(F.col("text")))
    plan = tfidf.fit(terms, 100).weights(terms)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("options", [{}, {"max_features": 7}, {"min_df": 2, "sublinear": True}])
def test_X3_X4_a_vocabulary_that_no_task_holds(docs, options, monkeypatch):
    """Terms ranked by ranges and joined: the same vocabulary and weights, without terms in the driver or in the plan."""
    terms = docs.withColumn("terms", tfidf.text_terms(F.col("text")))
    wanted = (options.get("max_features", 100), options.get("min_df", 1))
    held = tfidf.vocabulary(terms, *wanted).collect()
    monkeypatch.setattr(tfidf, "HELD_TERMS", 5)
    assert sorted(map(tuple, tfidf.vocabulary(terms, *wanted).collect())) == sorted(map(tuple, held))
    model = tfidf.fit(terms, *wanted, options.get("sublinear", False))
    assert isinstance(model, tfidf.TermTable)
    expected = python_tfidf({d: python_terms(t) for d, t in DOCS.items()}, **options)
    found = {d: {} for d in DOCS}
    for r in model.long_table(terms, "id").collect():
        found[r["id"]][r["term"]] = r["tfidf"]
    names = {r["idx"]: r["term"] for r in model.table.collect()}
    assert sorted(names) == list(range(len(names)))
    vectors = {r["id"]: dict(zip(r["vec"]["indices"], r["vec"]["weights"])) for r in model.weights(terms).collect()}
    for d in DOCS:
        assert found[d] == pytest.approx(expected[d])
        assert {names[i]: w for i, w in vectors[d].items()} == pytest.approx(expected[d])


def test_X3_numbers_are_dense_whatever_the_ranges(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("a"), "id")
    found = dictionary.numbered(rows, F.desc("a"), F.asc("id")).orderBy("number").collect()
    assert [r["number"] for r in found] == list(range(5000))
    assert [(-r["a"], r["id"]) for r in found] == sorted((-r["a"], r["id"]) for r in found)
    assert dictionary.numbered(rows.where("id < 0"), F.asc("id")).count() == 0


def test_X5_mismatch(spark):
    pairs = [
        (1, "leaf rust spray", "leaf rust spray"),
        (2, "leaf rust", "market price"),
        (3, "on the", "on the"),
        (4, "leaf rust today", "spray the leaf"),
        (5, None, "spray"),
    ]
    df = spark.createDataFrame(pairs, "id int, question string, answer string")
    found = {r["id"]: r for r in mismatch.find_mismatches(df, stop_words=("on", "the")).collect()}
    assert found[1]["mismatch_score"] == pytest.approx(0, abs=1e-9) and not found[1]["is_mismatch"]
    assert all(found[i]["mismatch_score"] == 1 and found[i]["is_mismatch"] for i in (2, 3, 5))
    corpus = {(i, s): python_terms(t or "", ("on", "the")) for i, q, a in pairs for s, t in (("q", q), ("a", a))}
    w = python_tfidf(corpus)
    cosine = sum(x * w[4, "a"].get(t, 0) for t, x in w[4, "q"].items())
    assert found[4]["mismatch_score"] == pytest.approx(1 - cosine)


def test_X9_X10_scorer_and_threshold(spark):
    df = spark.createDataFrame([(1, "q", "yes"), (2, "q", "half"), (3, "q", None)], "id int, question string, answer string")
    probabilities = {"yes": 0.9, "half": 0.5, "": 0.0}
    seen = "This response addresses the farmer's concern: q"

    def scorer(premises, hypotheses):
        assert set(hypotheses) == {seen}
        return [probabilities[p] for p in premises]

    found = {r["id"]: r["is_mismatch"] for r in mismatch.find_mismatches(df, "nli", scorer=scorer, batch=2).collect()}
    assert found == {1: False, 2: True, 3: True}
    with pytest.raises(ValueError):
        mismatch.find_mismatches(df, "other")


def test_T10_worst(spark):
    df = spark.createDataFrame([(2, 0.9), (1, 0.9), (3, 0.1)], "id int, mismatch_score double")
    assert [r["id"] for r in mismatch.worst(df, "id", 2).collect()] == [1, 2]


# -- top-k -------------------------------------------------------------------------------


def random_sparse(spark, n, seed, width=40):
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        terms = sorted(rng.choice(width, size=int(rng.integers(0, 8)), replace=False).tolist())
        data.append((i, terms, [float(x) for x in rng.integers(1, 4, size=len(terms))]))
    return data, spark.createDataFrame(data, "id bigint, indices array<int>, weights array<double>").repartition(3)


def brute(corpus, queries, k, skip_self=False):
    out = set()
    for q, qi, qw in queries:
        ask = dict(zip(qi, qw))
        sims = [(sum(ask.get(i, 0) * w for i, w in zip(ci, cw)), c) for c, ci, cw in corpus if not (skip_self and c == q)]
        best = sorted(((-s, c) for s, c in sims if s > 0))[:k]
        out |= {(q, c, -s, rank) for rank, (s, c) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("skip_self", [False, True])
def test_T8_sparse_top_k_with_ties(spark, skip_self):
    corpus, c = random_sparse(spark, 120, 1)
    queries, q = random_sparse(spark, 30, 2)
    found = {tuple(r) for r in topk.top_k(c, q, 5, skip_self=skip_self).collect()}
    assert found == brute(corpus, queries, 5, skip_self)


def test_T8_blocks_beyond_the_bound(spark, monkeypatch):
    corpus, c = random_sparse(spark, 120, 3)
    queries, q = random_sparse(spark, 30, 4)
    monkeypatch.setattr(topk, "MAX_QUERIES", 8)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 25)
    assert {tuple(r) for r in topk.top_k(c, q, 5).collect()} == brute(corpus, queries, 5)


def test_T8_slices_of_a_batch(spark, monkeypatch):
    corpus, c = random_sparse(spark, 120, 5)
    queries, q = random_sparse(spark, 30, 6)
    monkeypatch.setattr(topk, "WORK", 20)
    local = topk._k_best(topk.SparseBlock(q.toArrow()), [c.toArrow()], 5, False)
    expected = {(a, b, s) for a, b, s, _ in brute(corpus, queries, 5)}
    assert {tuple(r) for r in local[["query_id", "id", "similarity"]].itertuples(index=False)} == expected


def test_X7_dense_top_k(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(60, 5))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "call_id bigint, embedding array<float>")
    found = retrieval.EmbeddingRetriever().fit(df).query(df.withColumnRenamed("call_id", "query_id"), 3, payload=()).collect()
    sims = np.round(vectors.astype("float32").astype("float64") @ vectors.astype("float32").astype("float64").T, 9)
    for r in found:
        order = sorted(range(60), key=lambda j: (-sims[r["query_id"], j], j))
        assert order[r["rank"] - 1] == r["call_id"]
    assert len(found) == 180


def test_X6_retriever(spark, tmp_path):
    data = [(i, t, f"answer {i}", "Wheat", "Cereals") for i, t in DOCS.items()]
    corpus = spark.createDataFrame(data, "call_id int, question string, answer string, crop string, category string")
    retriever = retrieval.build_retriever(corpus).save_index(str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "spray for leaf rust"), (2, "zzz unseen"), (3, "wheat price")], "query_id int, text string")
    found = {(r["query_id"], r["rank"]): r for r in retriever.query(queries, 2).collect()}
    assert [found[1, k]["call_id"] for k in (1, 2)] == [2, 6]  # equal similarity: lowest id first
    assert found[1, 1]["similarity"] == pytest.approx(1)
    assert found[3, 1]["answer"] == "answer 5"
    assert not [k for k in found if k[0] == 2]
    assert retrieval.above(retriever.query(queries, 2), 0.99).count() == 2
    with pytest.raises(ValueError):
        retrieval.build_retriever(corpus, "other")
