"""Text queries: TF-IDF, mismatch, retrieval, classification."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewise.functions.numeric import dense_dot, softmax_at
from casewise.functions.text import char_ngrams, term_counts
from casewise.operators import cleaning, hierarchy, mismatch, retrieval, tfidf
from casewise.operators.hierarchy import HierarchicalClassifier, evaluate_against_gold
from casewise.plans import jobs, reports
from casewise.session import durable, shared_folder
from casewise.sources.tables import read_table, spread
from checks.cleaning import SPLIT
from checks.common import CASES, DOCUMENT_CALLS, QUESTION_ANSWERS, document_calls, query, question_answers, rounded, table

STOP = ("the", "of", "and", "to", "in", "is", "la", "le", "de", "der", "die", "und", "el", "que")
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)


def grams_sql(name: str, source: str, text: str, keys: str, stop: bool = False) -> str:
    """CTE ``name`` (keys, term, tf): counts of word 1-2-grams of ``text``."""
    words = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"
    if stop:
        words = f"list_filter({words}, lambda w: w NOT IN ({_STOP_SQL}))"
    return f"""
{name}_words AS (SELECT {keys}, {words} AS t FROM {source}),
{name}_grams AS (
  SELECT {keys}, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM {name}_words),
{name} AS (SELECT {keys}, term, count(*) AS tf FROM {name}_grams GROUP BY ALL)"""


def vocabulary_sql(source: str, n_docs: str, max_features: int, min_df: int = 1) -> str:
    return f"""
vocabulary AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df, ln((1 + {n_docs}) / (1 + count(*))) + 1 AS idf FROM {source} GROUP BY term
  HAVING count(*) >= {min_df} ORDER BY cf DESC, term LIMIT {max_features})"""


def weights_sql(name: str, source: str, keys: str, tf: str = "tf") -> str:
    """CTE ``name`` (keys, term, w): unit-length weights over the vocabulary."""
    return f"""
{name}_raw AS (SELECT {keys}, term, {tf} * idf AS w FROM {source} JOIN vocabulary USING (term)),
{name} AS (SELECT {keys}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {keys})) AS w FROM {name}_raw)"""


def _document_texts(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


DOC_GRAMS = grams_sql("tf", "documents", "text", "doc_id")
N_DOCUMENTS = "(SELECT count(*) FROM documents)"


@query(
    "vocabulary",
    f"WITH {DOC_GRAMS}, {vocabulary_sql('tf', N_DOCUMENTS, 6000, 2)} SELECT term, cf, df, round(idf, 6) AS idf FROM vocabulary",
)
def vocabulary(spark, sf):
    return rounded(tfidf.vocabulary(_document_texts(spark, sf), 6000, 2, "text", ()), "idf")


@query(
    "tfidf_terms",
    f"""WITH {DOC_GRAMS}, {vocabulary_sql('tf', N_DOCUMENTS, 6000, 2)}, {weights_sql('weights', 'tf', 'doc_id', '(1 + ln(tf))')}
        SELECT doc_id, term, round(w, 6) AS tfidf FROM weights""",
)
def tfidf_terms(spark, sf):
    docs = _document_texts(spark, sf)
    return rounded(tfidf.fit(docs, 6000, 2, True, "text", ()).long_table(docs, "doc_id", "text"), "tfidf")


WIDE = 150_000


@query(
    "vocabulary_wide",
    f"WITH {DOC_GRAMS}, {vocabulary_sql('tf', N_DOCUMENTS, WIDE)} SELECT term, cf, df, round(idf, 6) AS idf FROM vocabulary",
)
def vocabulary_wide(spark, sf):
    """A vocabulary larger than one that the plan holds."""
    return rounded(tfidf.vocabulary(_document_texts(spark, sf), WIDE, 1, "text", ()), "idf")


@query(
    "tfidf_terms_wide",
    f"""WITH {DOC_GRAMS}, {vocabulary_sql('tf', N_DOCUMENTS, WIDE)}, {weights_sql('weights', 'tf', 'doc_id', '(1 + ln(tf))')}
        SELECT doc_id, term, round(w, 6) AS tfidf FROM weights""",
)
def tfidf_terms_wide(spark, sf):
    docs = _document_texts(spark, sf)
    return rounded(tfidf.fit(docs, WIDE, 1, True, "text", ()).long_table(docs, "doc_id", "text"), "tfidf")


@query(
    "char_ngrams",
    """WITH labels_ AS (SELECT DISTINCT p_name AS label FROM part),
       words AS (SELECT label, ' ' || unnest(string_split(lower(label), ' ')) || ' ' AS w FROM labels_),
       sized AS (SELECT label, w, unnest([2, 3, 4]) AS n FROM words),
       placed AS (SELECT label, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM sized WHERE n <= length(w))
       SELECT label, substring(w, i, n) AS term, count(*) AS tf FROM placed GROUP BY ALL""",
)
def char_ngram_counts(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_name").alias("label")).distinct()
    return names.select("label", F.inline(term_counts(char_ngrams(F.col("label")))))


# -- mismatch ----------------------------------------------------------------------------

MISMATCH = f"""WITH {QUESTION_ANSWERS},
sides AS (
  SELECT conv_id, turn, 'q' AS side, question AS text FROM qa UNION ALL SELECT conv_id, turn, 'a', answer FROM qa),
{grams_sql("tf", "sides", "text", "conv_id, turn, side", stop=True)},
{vocabulary_sql("tf", "(SELECT count(*) FROM sides)", 5000)},
{weights_sql("weights", "tf", "conv_id, turn, side")},
cosine AS (
  SELECT q.conv_id, q.turn, sum(q.w * a.w) AS s FROM weights q JOIN weights a USING (conv_id, turn, term)
  WHERE q.side = 'q' AND a.side = 'a' GROUP BY ALL),
scored AS (
  SELECT conv_id, turn, crop, 1 - coalesce(s, 0) AS mismatch_score, round(1 - coalesce(s, 0), 9) >= 0.9 AS is_mismatch
  FROM qa LEFT JOIN cosine USING (conv_id, turn))"""


def _scored(spark, sf):
    return mismatch.find_mismatches(question_answers(spark, sf), "lexical", 0.9, stop_words=STOP)


@query(
    "lexical_mismatch",
    f"{MISMATCH} SELECT conv_id, turn, round(mismatch_score, 6) AS mismatch_score, is_mismatch FROM scored",
)
def lexical_mismatch(spark, sf):
    return rounded(_scored(spark, sf).select("conv_id", "turn", "mismatch_score", "is_mismatch"), "mismatch_score")


@query(
    "mismatch_by_segment",
    f"""{MISMATCH} SELECT crop, round(avg(CAST(is_mismatch AS INT)), 6) AS mismatch_rate, count(*) AS n_calls
        FROM scored GROUP BY 1""",
)
def mismatch_by_segment(spark, sf):
    return rounded(mismatch.mismatch_by_segment(_scored(spark, sf), "crop"), "mismatch_rate")


TURN_CASES = """
cases AS (
  SELECT conv_id AS case_id, 's' || (conv_id % 10) AS crop,
    (count(*) - count(DISTINCT role)) / count(*) AS loop_rate FROM conversations GROUP BY ALL)"""


def _turn_cases(spark, sf):
    turns = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("case_id")).agg(
        ((F.count(F.lit(1)) - F.count_distinct("role")) / F.count(F.lit(1))).alias("loop_rate")
    )
    return turns.withColumn("crop", F.concat(F.lit("s"), (F.col("case_id") % 10).cast("string")))


RATES = f"""{MISMATCH}, {TURN_CASES},
pairs AS (
  SELECT crop, l.loop_rate, l.n_cases, m.mismatch_rate, m.n_calls
  FROM (SELECT crop, avg(loop_rate) AS loop_rate, count(*) AS n_cases FROM cases GROUP BY 1) l
  JOIN (SELECT crop, avg(CAST(is_mismatch AS INT)) AS mismatch_rate, count(*) AS n_calls FROM scored GROUP BY 1) m USING (crop)
  WHERE m.n_calls >= 5)"""


@query(
    "loop_and_mismatch",
    f"""{RATES} SELECT crop, round(loop_rate, 6) AS loop_rate, n_cases, round(mismatch_rate, 6) AS mismatch_rate, n_calls
        FROM pairs""",
)
def loop_and_mismatch(spark, sf):
    found = mismatch.loop_and_mismatch(_turn_cases(spark, sf), _scored(spark, sf))
    return rounded(found, "loop_rate", "mismatch_rate")


@query(
    "loop_vs_mismatch_corr",
    f"""{RATES}, c AS (SELECT count(*) AS n_segments, corr(loop_rate, mismatch_rate) AS r FROM pairs)
        SELECT n_segments, CASE WHEN NOT isnan(r) THEN round(r, 6) END AS correlation, CASE WHEN r IS NULL OR isnan(r) THEN 'undefined'
          WHEN r >= 0.3 THEN 'together' WHEN r <= -0.3 THEN 'opposite' ELSE 'weak' END AS verdict FROM c""",
)
def loop_vs_mismatch_corr(spark, sf):
    return rounded(reports.loop_vs_mismatch(_turn_cases(spark, sf), _scored(spark, sf)), "correlation")


@query(
    "worst_mismatches",
    f"""{MISMATCH} SELECT turn * 1000000 + conv_id AS pair_id, round(mismatch_score, 6) AS mismatch_score
        FROM scored ORDER BY round(scored.mismatch_score, 6) DESC, pair_id LIMIT 5""",
)
def worst_mismatches(spark, sf):
    scored = _scored(spark, sf).select((F.col("turn") * 1000000 + F.col("conv_id")).alias("pair_id"), "mismatch_score")
    return mismatch.worst(rounded(scored, "mismatch_score"), "pair_id", 5)


def _overlap(premises: list[str], hypotheses: list[str]) -> list[float]:
    """A scorer for checks: how long the premise is against the hypothesis."""
    return [min(1.0, len(p) / len(h)) for p, h in zip(premises, hypotheses)]


@query(
    "entailment_mismatch",
    f"""WITH {QUESTION_ANSWERS}, s AS (
          SELECT conv_id, turn, 1 - least(1.0::DOUBLE, length(answer)
            / (length(question) + {len(mismatch.HYPOTHESIS.replace("{question}", ""))})) AS score FROM qa)
        SELECT conv_id, turn, round(score, 6) AS mismatch_score, score >= 0.5 AS is_mismatch FROM s""",
)
def entailment_mismatch(spark, sf):
    scored = mismatch.find_mismatches(question_answers(spark, sf), "nli", 0.5, scorer=_overlap)
    return rounded(scored.select("conv_id", "turn", "mismatch_score", "is_mismatch"), "mismatch_score")


# -- retrieval ---------------------------------------------------------------------------

RETRIEVED = f"""WITH {grams_sql("tf", "documents", "text", "doc_id", stop=True)},
{vocabulary_sql("tf", N_DOCUMENTS, 8000)},
{weights_sql("corpus", "tf", "doc_id")},
{grams_sql("qtf", "benchmark", "text", "item_id", stop=True)},
{weights_sql("asked", "qtf", "item_id")},
sims AS (
  SELECT item_id, doc_id, round(sum(a.w * c.w), 9) AS similarity FROM asked a JOIN corpus c USING (term) GROUP BY ALL),
found AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM sims QUALIFY rank <= 5)"""


def _retriever(spark, sf):
    docs = spread(table(spark, sf, "documents"))
    corpus = docs.select("doc_id", "text", F.col("source").alias("crop"), F.col("lang").alias("category"))
    fitted = retrieval.TfidfRetriever(stop_words=STOP).fit(corpus, "text", "doc_id")
    return fitted


def _asked(spark, sf):
    return table(spark, sf, "benchmark").withColumnRenamed("item_id", "query_id")


@query(
    "retrieve_tfidf",
    f"""{RETRIEVED} SELECT item_id AS query_id, doc_id, source AS crop, lang AS category,
        round(similarity, 6) AS similarity, rank FROM found JOIN documents USING (doc_id)""",
)
def retrieve_tfidf(spark, sf):
    found = _retriever(spark, sf).query(_asked(spark, sf), 5, payload=("crop", "category"))
    return rounded(found, "similarity")


@query(
    "retrieve_indexed",
    f"""{RETRIEVED} SELECT item_id AS query_id, doc_id, source AS crop, lang AS category,
        round(similarity, 6) AS similarity, rank FROM found JOIN documents USING (doc_id)""",
)
def retrieve_indexed(spark, sf):
    """The same from an inverted index whose lists are read from the top."""
    found = _retriever(spark, sf).save_lists(f"{shared_folder(spark)}/lists-{uuid.uuid4().hex}").query(
        _asked(spark, sf), 5, payload=("crop", "category")
    )
    return rounded(found, "similarity")


NEAREST_VECTORS = """WITH sims AS (
         SELECT q.vec_id AS query_id, c.vec_id AS vec_id, c.label, round(list_inner_product(
           list_transform(q.embedding, lambda x: x::DOUBLE), list_transform(c.embedding, lambda x: x::DOUBLE)), 9) AS similarity
         FROM embeddings q CROSS JOIN embeddings c)
       SELECT query_id, vec_id, label, round(similarity, 6) AS similarity,
         row_number() OVER (PARTITION BY query_id ORDER BY sims.similarity DESC, vec_id) AS rank
       FROM sims QUALIFY rank <= 5"""


@query(
    "retrieve_embedding",
    NEAREST_VECTORS,
)
def retrieve_embedding(spark, sf):
    vectors = table(spark, sf, "embeddings")
    found = retrieval.EmbeddingRetriever().fit(vectors, "embedding", "vec_id").query(
        vectors.withColumnRenamed("vec_id", "query_id"), 5, payload=("label",)
    )
    return rounded(found, "similarity")


@query("retrieve_in_blocks", NEAREST_VECTORS)
def retrieve_in_blocks(spark, sf):
    """The same with blocks skipped by their distance to a pivot."""
    vectors = table(spark, sf, "embeddings")
    found = retrieval.EmbeddingRetriever().fit(vectors, "embedding", "vec_id").save_blocks(
        f"{shared_folder(spark)}/blocks-{uuid.uuid4().hex}"
    ).query(vectors.withColumnRenamed("vec_id", "query_id"), 5, payload=("label",))
    return rounded(found, "similarity")


@query(
    "vector_confidence",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
       SELECT vec_id, round(list_inner_product(e, e), 6) AS squared,
         round(exp(e[1] - list_max(e)) / list_sum(list_transform(e, lambda x: exp(x - list_max(e)))), 6) AS share FROM v""",
)
def vector_confidence(spark, sf):
    doubles = F.col("embedding").cast("array<double>")
    return rounded(
        table(spark, sf, "embeddings").select(
            "vec_id",
            dense_dot(F.col("embedding"), F.col("embedding")).alias("squared"),
            softmax_at(doubles, F.lit(0)).alias("share"),
        ),
        "squared", "share",
    )


# -- classification ----------------------------------------------------------------------


def _labelled(spark, sf):
    docs = spread(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id")
    return docs.select(
        F.col("doc_id").alias("call_id"), F.col("text").alias("question"), F.col("lang").alias("category"),
        F.concat(F.lit("quality "), "quality").alias("query_type"),
    )


#: Weights of a space as a formula of the term's and the class's place, in Spark and in SQL.
TOP_WEIGHT, PAIR_WEIGHT, THREE_WEIGHT = "((i * 7 + k * 13) % 11 - 5) / 10.0D", "((i * 5) % 7 - 3) / 5.0D", "((i * 3 + k * 5) % 13 - 6) / 8.0D"
_SQL_WEIGHTS = [w.replace("10.0D", "10.0::DOUBLE").replace("5.0D", "5.0::DOUBLE").replace("8.0D", "8.0::DOUBLE") for w in (TOP_WEIGHT, PAIR_WEIGHT, THREE_WEIGHT)]


def _given_model(spark, sf):
    """A model from given tables: 500 terms for the languages; 200 for the texts of two of them, a fallback for one."""
    docs = _document_texts(spark, sf)
    order = Window.orderBy(F.desc("cf"), "term")  # 500 rows
    terms = durable(tfidf.vocabulary(docs, 500, 2, "text", ()).select("term", (F.row_number().over(order) - 1).alias("idx"), "idf"))
    langs = table(spark, sf, "documents").where("lang IS NOT NULL").select(F.col("lang").alias("label")).distinct()
    top = langs.select(
        F.lit(hierarchy.TOP).alias("space"), (F.row_number().over(Window.orderBy("label")) - 1).alias("place"), "label",
        F.lit(500).alias("width"), F.lit(TOP_WEIGHT).alias("kind"), F.lit(0.1).alias("step"),
    )
    within = f"""SELECT * FROM VALUES
        ('{hierarchy.WITHIN}de', 0, 'quality 0', 200, 'none', 0.0D), ('{hierarchy.WITHIN}de', 1, 'quality 1', 200, 'pair', -0.1D),
        ('{hierarchy.WITHIN}en', 0, 'a', 200, 'three', 0.2D), ('{hierarchy.WITHIN}en', 1, 'b', 200, 'three', 0.2D),
        ('{hierarchy.WITHIN}en', 2, 'c', 200, 'three', 0.2D) AS t(space, place, label, width, kind, step)"""
    places = F.sequence(F.lit(0), F.col("width") - 1)
    weight = F.expr(f"""CASE kind WHEN 'pair' THEN transform(places, i -> {PAIR_WEIGHT}) WHEN 'three' THEN transform(places, i -> {THREE_WEIGHT})
        WHEN 'none' THEN NULL ELSE transform(places, i -> {TOP_WEIGHT}) END""")
    n_terms = terms.count()
    classes = top.unionByName(spark.sql(within)).withColumns({"width": F.least("width", F.lit(n_terms)), "k": F.col("place")}).withColumn("places", places)
    classes = classes.select("space", "place", "label", weight.alias("weights"), (F.col("place") * F.col("step")).alias("intercept"))
    spaces = F.explode(F.array(*(F.lit(x) for x in (hierarchy.TOP, f"{hierarchy.WITHIN}de", f"{hierarchy.WITHIN}en"))))
    terms = terms.withColumn("space", spaces).where((F.col("space") == hierarchy.TOP) | (F.col("idx") < 200))
    plan = spark.sql("SELECT 'es' AS category, 'fallback' AS decision, 'only' AS fallback_label")
    return HierarchicalClassifier(terms=terms.select("space", "term", "idx", "idf"), classes=classes, plan=plan)


def scored_sql(asked: str, key: str) -> str:
    """Labels of the texts of a table by the given model, whose terms come from the documents."""
    return f"""WITH {DOC_GRAMS}, {vocabulary_sql('tf', N_DOCUMENTS, 500, 2)}, {grams_sql('asked_tf', asked, 'text', key)},
numbered AS (SELECT *, row_number() OVER (ORDER BY cf DESC, term) - 1 AS i FROM vocabulary),
raw AS (SELECT {key}, i, (1 + ln(asked_tf.tf)) * idf AS w FROM asked_tf JOIN numbered USING (term)),
wide AS (SELECT {key}, i, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM raw),
narrow AS (SELECT {key}, i, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM raw WHERE i < 200),
langs AS (SELECT lang AS label, row_number() OVER (ORDER BY lang) - 1 AS k FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
top AS (
  SELECT d.{key}, k, label, k * 0.1 + coalesce(sum(w * ({_SQL_WEIGHTS[0]})), 0) AS m
  FROM {asked} d CROSS JOIN langs LEFT JOIN wide v ON v.{key} = d.{key} GROUP BY d.{key}, k, label),
category AS (
  SELECT {key}, arg_min(label, (-m, k)) AS label, 1 / sum(exp(m - best)) AS confidence
  FROM (SELECT *, max(m) OVER (PARTITION BY {key}) AS best FROM top) GROUP BY {key}),
pair AS (
  SELECT c.{key}, -0.1 + coalesce(sum(w * ({_SQL_WEIGHTS[1]})), 0) AS m
  FROM category c LEFT JOIN narrow v ON v.{key} = c.{key} WHERE c.label = 'de' GROUP BY c.{key}),
three AS (
  SELECT c.{key}, k, k * 0.2 + coalesce(sum(w * ({_SQL_WEIGHTS[2]})), 0) AS m
  FROM category c CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) LEFT JOIN narrow v ON v.{key} = c.{key} WHERE c.label = 'en' GROUP BY c.{key}, k),
query_type AS (
  SELECT {key}, CASE WHEN m > 0 THEN 'quality 1' ELSE 'quality 0' END AS label, 1 / (1 + exp(-abs(m))) AS confidence FROM pair
  UNION ALL
  SELECT {key}, ['a', 'b', 'c'][arg_min(k, (-m, k)) + 1], 1 / sum(exp(m - best))
  FROM (SELECT *, max(m) OVER (PARTITION BY {key}) AS best FROM three) GROUP BY {key})
SELECT {key}, c.label AS pred_category, coalesce(q.label, CASE WHEN c.label = 'es' THEN 'only' ELSE 'UNKNOWN' END) AS pred_query_type,
  round(c.confidence, 6) AS category_confidence, round(q.confidence, 6) AS query_type_confidence
FROM category c LEFT JOIN query_type q USING ({key})"""


SCORED = scored_sql("documents", "doc_id")


def _given_labels(spark, sf, **how):
    model = _given_model(spark, sf)
    routed = HierarchicalClassifier(terms=model.terms, classes=model.classes, plan=model.plan, **how)
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return rounded(routed.predict(docs, "text").drop("text"), "category_confidence", "query_type_confidence")


@query("score_given_weights", SCORED)
def score_given_weights(spark, sf):
    """Labels and confidences of both levels from given tables of terms and weights, in one pass."""
    return _given_labels(spark, sf)


@query("score_by_routing", SCORED)
def score_by_routing(spark, sf):
    """The same with rows shuffled to the model of their category, hot categories in parts."""
    return _given_labels(spark, sf, broadcast_bytes=0, part_rows=100)


@query("saved_model", SCORED)
def saved_model(spark, sf):
    """The model written as tables, read back and used."""
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    _given_model(spark, sf).save(spark, path)
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    found = HierarchicalClassifier.load(spark, path).predict(docs, "text").drop("text")
    return rounded(found, "category_confidence", "query_type_confidence")


@query(
    "scores_of_labels",
    f"""WITH scored AS ({SCORED}), pairs AS (
          SELECT 'category' AS level, lang AS truth, pred_category AS guess FROM scored JOIN documents USING (doc_id)
          UNION ALL SELECT 'query_type', 'quality ' || (n_chars % 2), pred_query_type FROM scored JOIN documents USING (doc_id)),
        labels_ AS (SELECT level, truth AS l FROM pairs UNION SELECT level, guess FROM pairs),
        per AS (SELECT level, l, (SELECT count(*) FROM pairs p WHERE p.level = x.level AND truth = l AND guess = l) AS hit,
          (SELECT count(*) FROM pairs p WHERE p.level = x.level AND truth = l) AS n,
          (SELECT count(*) FROM pairs p WHERE p.level = x.level AND guess = l) AS said FROM labels_ x)
        SELECT level, CAST(sum(n) AS BIGINT) AS n, round(sum(hit) / sum(n), 6) AS accuracy,
          round(avg(CASE WHEN n + said > 0 THEN 2 * hit / (n + said) ELSE 0 END), 6) AS macro_f1 FROM per GROUP BY level""",
)
def scores_of_labels(spark, sf):
    """Accuracy and macro-F1 of both levels, of the labels that given weights give."""
    gold = spread(table(spark, sf, "documents")).select(
        F.col("text").alias("question"), F.col("lang").alias("category"),
        F.concat(F.lit("quality "), (F.col("n_chars") % 2).cast("string")).alias("query_type"),
    )
    return rounded(evaluate_against_gold(_given_model(spark, sf), gold), "accuracy", "macro_f1")


@query("hier_predict")
def hier_predict(spark, sf):
    """Train on the labelled documents and label every document; model results have no SQL."""
    model = HierarchicalClassifier().fit(_labelled(spark, sf))
    documents = spread(table(spark, sf, "documents")).select("doc_id", F.col("text").alias("question"))
    return rounded(model.predict(documents).drop("question"), "category_confidence", "query_type_confidence", digits=4)


@query("hier_scores")
def hier_scores(spark, sf):
    """Accuracy and macro-F1 of both levels on the rows the model was trained on."""
    rows = durable(_labelled(spark, sf))
    model = HierarchicalClassifier().fit(rows)
    return rounded(evaluate_against_gold(model, rows), "accuracy", "macro_f1", digits=4)


@query("answer_queries")
def answer_queries(spark, sf):
    """Predictions and similar past documents for the benchmark texts."""
    model = HierarchicalClassifier().fit(_labelled(spark, sf))
    docs = spread(table(spark, sf, "documents"))
    corpus = docs.select(
        F.col("doc_id").alias("call_id"), F.col("text").alias("question"), F.col("text").alias("answer"),
        F.col("source").alias("crop"), F.col("lang").alias("category"),
    )
    retriever = retrieval.build_retriever(corpus, "tfidf")
    predictions, similar = reports.answer_queries(model, retriever, _asked(spark, sf))
    return similar.join(predictions.select("query_id", "pred_category", "pred_query_type"), "query_id")


# -- answers and models that are written and read ------------------------------------------------


@query(
    "retrieve_above",
    """WITH sims AS (
         SELECT q.vec_id AS query_id, c.vec_id AS vec_id, c.label, round(list_inner_product(
           list_transform(q.embedding, lambda x: x::DOUBLE), list_transform(c.embedding, lambda x: x::DOUBLE)), 9) AS similarity
         FROM embeddings q CROSS JOIN embeddings c)
       SELECT query_id, vec_id, label, round(similarity, 6) AS similarity,
         row_number() OVER (PARTITION BY query_id ORDER BY sims.similarity DESC, vec_id) AS rank
       FROM sims QUALIFY rank <= 5 AND sims.similarity > 0.35""",
)
def retrieve_above(spark, sf):
    """Matches that are hardly similar go; the backend is chosen by its name."""
    vectors = table(spark, sf, "embeddings")
    found = retrieval.build_retriever(vectors, "embedding", vector_col="embedding", id_col="vec_id").query(
        vectors.withColumnRenamed("vec_id", "query_id"), 5, payload=("label",)
    )
    return rounded(retrieval.above(found, 0.35), "similarity")


@query(
    "answers_given",
    f"""WITH near AS ({RETRIEVED} SELECT item_id, rank, similarity, source, lang, text FROM found JOIN documents USING (doc_id)),
          said AS ({scored_sql("benchmark", "item_id")})
        SELECT b.item_id AS query_id, rank, CAST(CAST(round_even(similarity * 100, 0) AS INT) AS VARCHAR) || '%' AS match,
          source AS crop, lang AS category, pred_category, pred_query_type,
          CASE WHEN rank IS NULL THEN 'no sufficiently similar past question found' END AS note,
          md5(CASE WHEN length(near.text) > 140 THEN regexp_replace(left(near.text, 140), '\\s+$', '') || '…' ELSE near.text END) AS similar_question
        FROM benchmark b LEFT JOIN near ON near.item_id = b.item_id AND similarity > 0.03 JOIN said ON said.item_id = b.item_id""",
)
def answers_given(spark, sf):
    """Predictions of a given model and similar past questions for the benchmark texts."""
    docs = spread(table(spark, sf, "documents"))
    corpus = docs.select(
        F.col("doc_id").alias("call_id"), F.col("text").alias("question"), F.col("text").alias("answer"),
        F.col("source").alias("crop"), F.col("lang").alias("category"),
    )
    retriever = retrieval.TfidfRetriever(stop_words=STOP).fit(corpus)
    predictions, similar = reports.answer_queries(_given_model(spark, sf), retriever, _asked(spark, sf))
    return similar.join(predictions.select("query_id", "pred_category", "pred_query_type"), "query_id").select(
        "query_id", "rank", "match", "crop", "category", "pred_category", "pred_query_type", "note",
        F.md5("similar_question").alias("similar_question"),
    )


TRAINED = f"""WITH labelled AS (
    SELECT doc_id, lang AS raw, 'quality ' || quality AS query_type FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL),
usable AS (
    SELECT doc_id, query_type, CASE WHEN count(*) OVER (PARTITION BY raw) < 5 THEN 'Rare/Other' ELSE raw END AS lang FROM labelled),
{SPLIT.replace("FROM documents", "FROM usable")},
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS place FROM usable),
train AS (SELECT placed.* FROM placed JOIN quotas USING (lang) WHERE place > size - n_train),
kinds AS (SELECT lang, query_type, count(*) AS n FROM train GROUP BY ALL HAVING count(*) >= 3),
trained AS (SELECT lang FROM kinds GROUP BY 1 HAVING count(*) >= 2 AND sum(n) >= 4)
SELECT 'categories' AS space, lang AS label, CAST(0 AS BIGINT) AS n FROM train GROUP BY lang
UNION ALL SELECT 'within ' || lang, query_type, 0 FROM kinds WHERE lang IN (SELECT lang FROM trained)
UNION ALL SELECT 'scores', unnest(['category', 'query_type']), CAST((SELECT sum(size - n_train) FROM quotas) AS BIGINT)"""


@query("train_job", TRAINED)
def train_job(spark, sf):
    """The whole training job; the classes of the model it wrote, and the rows it scored."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    jobs.train_job(_labelled(spark, sf), f"{folder}/model", f"{folder}/scores")
    written = HierarchicalClassifier.load(spark, f"{folder}/model")
    scores = spark.read.json(f"{folder}/scores").select(F.lit("scores").alias("space"), F.col("level").alias("label"), "n")
    return written.classes.select("space", "label", F.lit(0).cast("long").alias("n")).unionByName(scores)


@query(
    "event_log_job",
    f"""WITH {DOCUMENT_CALLS}, log AS (
          SELECT district || '_' || crop AS case_id, query_type AS activity, created_on AS ts, call_id AS ord, state, crop
          FROM clean WHERE crop <> 'Others' AND query_type IS NOT NULL), {CASES}
        SELECT case_id, n_events, n_repeats, round(loop_rate, 6) AS loop_rate, crop, state FROM cases""",
)
def event_log_job(spark, sf):
    """The whole mining job; the loop rates it wrote, read back."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    jobs.event_log_job(cleaning.basic_clean(document_calls(spark, sf)), folder, "query_type")
    return rounded(read_table(spark, f"{folder}/loop_rate_per_case"), "loop_rate")
