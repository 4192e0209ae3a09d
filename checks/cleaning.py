"""Cleaning, sampling, metric and extraction queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casewise.functions.text import percent, plural, strip, truncate
from casewise.operators import cleaning, extraction, hierarchy, labels, metrics, sampling
from casewise.plans import jobs
from casewise.session import durable, shared_folder
from checks.common import DOCUMENT_CALLS, document_calls, query, rounded, table

LATIN_1_LETTERS = (0x00C0, 0x00FF)


@query(
    "clean_rows",
    f"""WITH {DOCUMENT_CALLS} SELECT call_id, state, district, crop, category, query_type, md5(question) AS question,
        md5(answer) AS answer, created_on FROM clean""",
)
def clean_rows(spark, sf):
    return cleaning.basic_clean(document_calls(spark, sf)).select(
        "call_id", "state", "district", "crop", "category", "query_type", F.md5("question").alias("question"),
        F.md5("answer").alias("answer"), "created_on",
    )


@query(
    "strip_columns",
    r"SELECT doc_id, md5(regexp_replace('  ' || text || chr(10), '^\s+|\s+$', '', 'g')) AS text FROM documents",
)
def strip_columns(spark, sf):
    padded = F.concat(F.lit("  "), "text", F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", F.md5(strip(padded)).alias("text"))


@query(
    "label_denylist",
    "SELECT doc_id, source FROM documents WHERE source IS NULL OR source NOT IN ('src1', 'src5', 'src9')",
)
def label_denylist(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return cleaning.filter_to_advisory(docs, "source", ("src1", "src5", "src9"))


@query(
    "script_filter",
    r"SELECT doc_id, lang FROM documents WHERE NOT regexp_matches(text, '[\x{00C0}-\x{00FF}]')",
)
def script_filter(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return cleaning.filter_scripts(docs, "text", (LATIN_1_LETTERS,)).select("doc_id", "lang")


@query(
    "scope",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
       AND o_orderstatus IN ('F', 'O') AND o_orderdate >= '1995-01-01' AND o_orderdate <= '1996-06-30'""",
)
def scope(spark, sf):
    return cleaning.scope(
        table(spark, sf, "orders"),
        states=["1-URGENT", "5-LOW"],
        crops=["F", "O"],
        start_date="1995-01-01",
        end_date="1996-06-30",
        columns={"state": "o_orderpriority", "crop": "o_orderstatus", "date": "o_orderdate"},
    ).select("o_orderkey", "o_orderdate")


@query(
    "rare_merge",
    """WITH classed AS (SELECT doc_id, CAST(n_chars // 500 AS VARCHAR) AS category FROM documents),
       rare AS (SELECT category FROM classed GROUP BY 1 HAVING count(*) < 5)
       SELECT doc_id, CASE WHEN category IN (SELECT category FROM rare) THEN 'Rare/Other' ELSE category END AS category
       FROM classed""",
)
def rare_merge(spark, sf):
    classed = table(spark, sf, "documents").select(
        "doc_id", F.floor(F.col("n_chars") / 500).cast("string").alias("category")
    )
    return cleaning.merge_rare(classed, "category")


@query(
    "clean_audit",
    f"""WITH {DOCUMENT_CALLS},
        c AS (SELECT
          (SELECT count(*) FROM stripped) AS c0,
          (SELECT count(*) FROM stripped WHERE length(question) > 3) AS c1,
          (SELECT count(*) FROM stripped WHERE length(question) > 3 AND length(answer) > 3) AS c2,
          (SELECT count(*) FROM stripped WHERE length(question) > 3 AND length(answer) > 3
             AND lower(answer) NOT IN ('irrelevant call', 'nan', '')) AS c3,
          (SELECT count(*) FROM kept) AS c4, (SELECT count(*) FROM clean) AS c5,
          (SELECT count(*) FROM clean) AS c6, (SELECT count(*) FROM clean) AS c7,
          (SELECT count(*) FROM clean WHERE state IN ('en', 'fr') AND created_on <= '2024-02-20') AS c8),
        steps AS (
          SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS step,
            unnest(['question length', 'answer length', 'junk answer', 'date', 'duplicate', 'advisory label', 'script',
                    'scope']) AS rule,
            unnest([c0, c1, c2, c3, c4, c5, c6, c7]) AS n_in, unnest([c1, c2, c3, c4, c5, c6, c7, c8]) AS n_out FROM c)
        SELECT step, rule, n_in, n_out, round(n_out * 100.0 / n_in, 6) AS pct_kept FROM steps""",
)
def clean_audit(spark, sf):
    audit = cleaning.cleaning_audit(document_calls(spark, sf), states=["en", "fr"], end_date="2024-02-20")
    return rounded(audit, "pct_kept")


DRAWN = """
draws AS (SELECT *, md5(CAST(doc_id AS VARCHAR) || ':42') AS draw FROM documents),
per_lang AS (SELECT greatest(1, 50 // count(DISTINCT lang)) AS quota FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY draw, doc_id) AS place FROM draws),
first_part AS (SELECT * FROM ranked WHERE place <= (SELECT quota FROM per_lang)),
rest AS (
  SELECT *, row_number() OVER (ORDER BY draw, doc_id) AS rest_place FROM ranked
  WHERE place > (SELECT quota FROM per_lang)),
sample AS (
  SELECT doc_id, lang, source FROM first_part
  UNION ALL SELECT doc_id, lang, source FROM rest WHERE rest_place <= 50 - (SELECT count(*) FROM first_part))"""


def _sample(spark, sf):
    return sampling.sample_gold(
        table(spark, sf, "documents").select("doc_id", "lang", "source"),
        n=50, id_col="doc_id", stratum="lang", columns=("lang", "source"), labels=("lang", "source"),
    )


@query(
    "gold_sample",
    f"""WITH {DRAWN} SELECT doc_id, lang, source, lang AS lang_verified, source AS source_verified,
        '' AS resolution_signal_verified, '' AS notes FROM sample""",
)
def gold_sample(spark, sf):
    return _sample(spark, sf)


@query(
    "gold_merge",
    f"""WITH {DRAWN} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'xx' ELSE lang END AS lang, source,
        '' AS resolution_signal FROM sample""",
)
def gold_merge(spark, sf):
    corrected = F.when(F.col("doc_id") % 2 == 0, "xx").otherwise(F.col("lang_verified"))
    return sampling.merge_gold(_sample(spark, sf).withColumn("lang_verified", corrected))


@query(
    "blank_signals",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE toxic = 1 OR quality = 0) AS n_blank FROM labels""",
)
def blank_signals(spark, sf):
    signal = F.when(F.col("toxic") == 1, F.lit("")).when(F.col("quality") == 1, F.lit("resolved"))
    return sampling.blank_signals(table(spark, sf, "labels").select(signal.alias("resolution_signal_verified")))


SPLIT = """
sizes AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1),
total AS (SELECT sum(size) AS n, sum(size) - ceil(sum(size) * 0.2) AS n_train FROM sizes),
shares AS (
  SELECT lang, size, n_train, floor(n_train * size / n) AS whole, (n_train * size) % n AS left_over FROM sizes, total),
quotas AS (
  SELECT lang, size, CAST(whole + CASE WHEN row_number() OVER (ORDER BY left_over DESC, lang) <= n_train - sum(whole) OVER ()
    THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM shares)"""


@query("split_sizes", f"WITH {SPLIT} SELECT lang, size, n_train, size - n_train AS n_test FROM quotas")
def split_sizes(spark, sf):
    return sampling.split_sizes(table(spark, sf, "documents").select("lang"), "lang")


@query(
    "stratified_split",
    f"""WITH {SPLIT}, placed AS (
          SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id)
            AS place FROM documents)
        SELECT doc_id, lang, CASE WHEN place <= size - n_train THEN 'test' ELSE 'train' END AS part
        FROM placed JOIN quotas USING (lang)""",
)
def stratified_split(spark, sf):
    train, test = sampling.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _guesses(spark, sf):
    """Languages with a guess that is wrong for a third of the rows."""
    guess = F.when(F.col("n_chars") % 3 == 0, "en").when(F.col("n_chars") % 7 == 0, "xx").otherwise(F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("truth"), guess.alias("guess"), "source"
    )


GUESSES = """
guesses AS (
  SELECT doc_id, lang AS truth, source,
    CASE WHEN n_chars % 3 = 0 THEN 'en' WHEN n_chars % 7 = 0 THEN 'xx' ELSE lang END AS guess FROM documents)"""


def _class_sql(truth: str, guess: str, rows: str = "guesses") -> str:
    return f"""(
  SELECT label, count(*) FILTER (WHERE truth_is) AS support,
    count(*) FILTER (WHERE truth_is AND guess_is) AS n_correct,
    coalesce(n_correct / nullif(count(*) FILTER (WHERE guess_is), 0), 0) AS precision,
    coalesce(n_correct / nullif(support, 0), 0) AS recall,
    coalesce(2 * n_correct / nullif(count(*) FILTER (WHERE guess_is) + support, 0), 0) AS f1
  FROM (SELECT label, {truth} = label AS truth_is, {guess} = label AS guess_is FROM {rows},
        (SELECT {truth} AS label FROM {rows} UNION SELECT {guess} FROM {rows}))
  GROUP BY label)"""


@query("confusion", f"WITH {GUESSES} SELECT truth AS true_label, guess AS pred_label, count(*) AS n FROM guesses GROUP BY ALL")
def confusion(spark, sf):
    return metrics.confusion(_guesses(spark, sf), "truth", "guess")


@query(
    "class_report",
    f"""WITH {GUESSES} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        support, n_correct FROM {_class_sql("truth", "guess")}""",
)
def class_report(spark, sf):
    report = metrics.per_class(metrics.confusion(_guesses(spark, sf), "truth", "guess"))
    return rounded(report, "precision", "recall", "f1")


@query(
    "confusion_metrics",
    f"""WITH {GUESSES} SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(n_correct) / sum(support), 6) AS accuracy,
        round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
        round(sum(precision * support) / sum(support), 6) AS weighted_precision,
        round(sum(recall * support) / sum(support), 6) AS weighted_recall,
        round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM {_class_sql("truth", "guess")}""",
)
def confusion_metrics(spark, sf):
    result = metrics.scores(_guesses(spark, sf), "truth", "guess")
    return rounded(result, *[c for c in result.columns if c != "n"])


@query(
    "class_weights",
    """SELECT lang, count(*) AS n, round((SELECT count(*) FROM documents)
       / ((SELECT count(DISTINCT lang) FROM documents) * count(*)), 6) AS weight FROM documents GROUP BY 1""",
)
def class_weights(spark, sf):
    return rounded(metrics.class_weights(table(spark, sf, "documents"), "lang"), "weight")


@query(
    "level2_plan",
    """WITH sizes AS (
         SELECT source AS category, CAST(n_chars % 40 AS VARCHAR) AS label, count(*) AS n FROM documents GROUP BY ALL),
       plans AS (
         SELECT category, count(*) FILTER (WHERE n >= 3) AS n_classes,
           CAST(coalesce(sum(n) FILTER (WHERE n >= 3), 0) AS BIGINT) AS n_rows,
           first(label ORDER BY n DESC, label) FILTER (WHERE n >= 3) AS top FROM sizes GROUP BY 1)
       SELECT category, n_classes, n_rows,
         CASE WHEN n_classes >= 2 AND n_rows >= 4 THEN 'train' WHEN n_rows > 0 THEN 'fallback' ELSE 'none' END AS decision,
         CASE WHEN n_classes >= 2 AND n_rows >= 4 THEN NULL ELSE top END AS fallback_label FROM plans""",
)
def level2_plan(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("category"), (F.col("n_chars") % 40).cast("string").alias("query_type")
    )
    return hierarchy.level2_plan(docs, "category", "query_type")


@query(
    "compare_methods",
    f"""WITH {GUESSES},
        e AS (SELECT sum(n_correct) / sum(support) AS a, avg(f1) AS f, sum(support) AS n FROM {_class_sql("truth", "guess")}),
        b AS (SELECT sum(n_correct) / sum(support) AS a, avg(f1) AS f FROM {_class_sql("truth", "lower(truth)")}),
        s AS (SELECT sum(n_correct) / sum(support) AS a FROM {_class_sql("source", "'src1'")})
        SELECT CAST(e.n AS BIGINT) AS n_compared, round(e.a, 6) AS extraction_accuracy, round(e.f, 6) AS extraction_macro_f1,
          round(s.a, 6) AS signal_accuracy, round(b.a, 6) AS classifier_accuracy, round(b.f, 6) AS classifier_macro_f1,
          CASE WHEN e.a > b.a THEN 'LLM extraction' WHEN e.a < b.a THEN 'Baseline classifier' ELSE 'Tie' END AS winner
        FROM e, b, s""",
)
def compare_methods(spark, sf):
    rows = _guesses(spark, sf).withColumns({"signal": F.lit("src1"), "other": F.lower("truth")})
    result = jobs.compare_methods(rows, "truth", "guess", "source", "signal", "other")
    return rounded(result, *[c for c in result.columns if c not in ("n_compared", "winner")])


@query(
    "align",
    """SELECT doc_id, lang AS gold_lang, source AS gold_source, quality AS ext_quality, toxic AS ext_toxic
       FROM documents JOIN labels USING (doc_id)""",
)
def align(spark, sf):
    return metrics.align(
        table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), "doc_id"
    )


@query(
    "align_audit",
    """SELECT (SELECT count(*) FROM documents) AS n_gold, (SELECT count(*) FROM labels) AS n_extracted,
       count(*) AS n_matched, (SELECT count(*) FROM documents) - count(*) AS n_dropped
       FROM documents JOIN labels USING (doc_id)""",
)
def align_audit(spark, sf):
    return metrics.align_audit(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    "missing_values",
    """SELECT count(*) FILTER (WHERE quality IS NULL) AS quality, count(*) FILTER (WHERE toxic IS NULL) AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def missing_values(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return metrics.missing_values(joined, ["quality", "toxic"])


@query(
    "vote_agreement",
    """WITH votes AS (
         SELECT user_id, 'event_type' AS field, event_type AS value FROM events
         UNION ALL SELECT user_id, 'props', props FROM events),
       counts AS (SELECT field, user_id, value, count(*) AS n FROM votes GROUP BY ALL),
       records AS (SELECT field, user_id, max(n) / sum(n) AS agreement, sum(n) AS repeats FROM counts GROUP BY ALL)
       SELECT field, count(*) AS n_records, CAST(max(repeats) AS BIGINT) AS n_repeats, round(avg(agreement), 6) AS mean_agreement
       FROM records GROUP BY 1""",
)
def vote_agreement(spark, sf):
    agreement = metrics.vote_agreement(table(spark, sf, "events"), "user_id", ["event_type", "props"])
    return rounded(agreement, "mean_agreement")


# -- extraction --------------------------------------------------------------------------


def _responses(spark, sf):
    """Responses of every shape, built from the events."""
    kind = F.col("event_id") % 8
    field = lambda k, v: F.concat(F.lit(f'"{k}": "'), v, F.lit('"'))
    category = F.when(F.col("event_type") == "view", F.lit("Weather")).otherwise(F.col("event_type"))
    signal = F.when(F.col("value") > 50, F.lit("resolved")).otherwise(F.lit("done"))
    body = F.concat(
        F.lit("{"), field("category", category), F.lit(", "), field("crop", F.col("user_id").cast("string")),
        F.lit(", "), field("resolution_signal", signal), F.lit("}"),
    )
    raw = (
        F.when(kind == 0, F.concat(F.lit("Here it is:\n"), body, F.lit("\nDone.")))
        .when(kind == 1, F.concat(body, F.lit(" and "), body))
        .when(kind == 2, F.replace(body, F.lit('"'), F.lit("'")))
        .when(kind == 3, F.concat(F.lit("no object for "), "event_type"))
        .when(kind == 4, F.col("props"))
        .when(kind == 5, F.concat(body, F.lit(","), body))
        .otherwise(body)
    )
    return table(spark, sf, "events").select("event_id", raw.alias("raw"))


RESPONSES = """
bodies AS (
  SELECT event_id, event_type, props, '{"category": "' || CASE WHEN event_type = 'view' THEN 'Weather' ELSE event_type END
    || '", "crop": "' || user_id || '", "resolution_signal": "' || CASE WHEN value > 50 THEN 'resolved' ELSE 'done' END
    || '"}' AS body FROM events),
responses AS (
  SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'Here it is:' || chr(10) || body || chr(10) || 'Done.'
    WHEN 1 THEN body || ' and ' || body WHEN 2 THEN replace(body, '"', chr(39))
    WHEN 3 THEN 'no object for ' || event_type WHEN 4 THEN props WHEN 5 THEN body || ',' || body ELSE body END AS raw
  FROM bodies),
blocks AS (SELECT event_id, raw, regexp_extract(raw, '(?s)\\{.*\\}') AS block FROM responses),
valid AS (SELECT *, NOT (block <> '' AND json_valid(block)) AS bad FROM blocks),
parsed AS (
  SELECT event_id, bad, CASE WHEN bad THEN left(raw, 200) END AS raw_head,
    CASE WHEN NOT bad THEN json_extract_string(block, '$.category') END AS c,
    CASE WHEN NOT bad THEN json_extract_string(block, '$.crop') END AS crop,
    CASE WHEN NOT bad THEN json_extract_string(block, '$.issue') END AS issue,
    CASE WHEN NOT bad THEN json_extract_string(block, '$.resolution_signal') END AS s FROM valid)"""


@query(
    "parse_json_events",
    f"""WITH {RESPONSES} SELECT event_id,
        CASE WHEN c IN ('Plant Protection', 'Nutrient Management', 'Weather', 'Cultural Practices', 'Market Information',
          'Other') THEN c ELSE 'Other' END AS category,
        coalesce(crop, 'Unknown') AS crop, coalesce(issue, CASE WHEN bad THEN 'parse_error' ELSE 'unspecified' END) AS issue,
        CASE WHEN s IN ('resolved', 'unresolved', 'unclear') THEN s ELSE 'unclear' END AS resolution_signal,
        bad AS parse_error, raw_head FROM parsed""",
)
def parse_json_events(spark, sf):
    return extraction.parse_responses(_responses(spark, sf), "event_id")


PROMPT_HEAD = extraction.PROMPT.split("{question}")[0]
for _name, _values in (("{categories}", extraction.CATEGORIES), ("{signals}", extraction.SIGNALS)):
    PROMPT_HEAD = PROMPT_HEAD.replace(_name, ", ".join(f'"{v}"' for v in _values))


@query(
    "prompts",
    "SELECT conv_id, turn, md5('" + PROMPT_HEAD.replace("'", "''")
    + "' || text || chr(10) || 'Answer: ' || role || chr(10)) AS prompt FROM conversations",
)
def prompts(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", F.md5(extraction.prompt(F.col("text"), F.col("role"))).alias("prompt"))


def _stub(texts: list[str]) -> list[str]:
    """A responder for checks: it labels by the length of the prompt."""
    return [f'{{"category": "{"Weather" if len(t) % 2 else "Other"}", "resolution_signal": "resolved"}}' for t in texts]


@query(
    "run_extraction",
    f"""SELECT doc_id, CASE WHEN (length(text) + length(source) + {len(PROMPT_HEAD) + 10}) % 2 = 1 THEN 'Weather'
        ELSE 'Other' END AS category, 'Unknown' AS crop, 'unspecified' AS issue, 'resolved' AS resolution_signal,
        false AS parse_error, CAST(NULL AS VARCHAR) AS raw_head FROM documents""",
)
def run_extraction(spark, sf):
    docs = table(spark, sf, "documents")
    return extraction.run_extraction(docs, _stub, id_col="doc_id", question="text", answer="source")


EXTRACTED = f"""SELECT doc_id, CASE WHEN (length(text) + length(source) + {len(PROMPT_HEAD) + 10}) % 2 = 1 THEN 'Weather'
        ELSE 'Other' END AS category, 'Unknown' AS crop, 'unspecified' AS issue, 'resolved' AS resolution_signal,
        false AS parse_error, CAST(NULL AS VARCHAR) AS raw_head FROM documents"""


@query("extract_first", f"{EXTRACTED} ORDER BY doc_id LIMIT 25")
def extract_first(spark, sf):
    """Only the first calls are asked for."""
    docs = table(spark, sf, "documents")
    return extraction.run_extraction(docs, _stub, id_col="doc_id", question="text", answer="source", n=25)


def _failing(texts: list[str]) -> list[str]:
    """A responder that is down for some prompts."""
    if any(len(t) % 5 == 0 for t in texts):
        raise RuntimeError("no answer")
    return _stub(texts)


@query("resumed_extraction", EXTRACTED)
def resumed_extraction(spark, sf):
    """A run in which many batches fail, and a second one that asks only for the rest."""
    docs, folder = table(spark, sf, "documents"), f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}"
    how = {"id_col": "doc_id", "question": "text", "answer": "source", "answers": folder}
    extraction.run_extraction(docs, _failing, **how).write.format("noop").mode("overwrite").save()
    return extraction.run_extraction(docs, _stub, **how)


@query(
    "consistency_check",
    """SELECT unnest(['category', 'resolution_signal']) AS field, count(*) AS n_records, 3 AS n_repeats,
       CAST(1 AS DOUBLE) AS mean_agreement FROM documents""",
)
def consistency_check(spark, sf):
    docs = table(spark, sf, "documents")
    return extraction.consistency_check(docs, _stub, None, id_col="doc_id", question="text", answer="source")


# -- text expressions and label merge ----------------------------------------------------


@query(
    "text_expressions",
    r"""SELECT doc_id, md5(CASE WHEN length(text) > 140 THEN regexp_replace(left(text, 140), '\s+$', '') || '…' ELSE text END)
          AS cut, n_chars || CASE WHEN n_chars = 1 THEN ' char' ELSE ' chars' END AS counted,
        CAST(CAST(round_even((n_chars % 200) / 200 * 100, 0) AS INT) AS VARCHAR) || '%' AS share FROM documents""",
)
def text_expressions(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(truncate(F.col("text"), 140)).alias("cut"),
        plural(F.col("n_chars"), "char").alias("counted"),
        percent((F.col("n_chars") % 200) / 200).alias("share"),
    )


def merge_sql(labels_: str, distance: float) -> str:
    """CTEs up to ``label_map`` (raw_label, canonical) of ``labels_`` (label, n): average linkage, all mutual pairs a round."""
    return f"""
grams_words AS (SELECT label, ' ' || unnest(list_filter(string_split(lower(label), ' '), lambda w: w <> '')) || ' ' AS w FROM {labels_}),
grams_sized AS (SELECT label, w, unnest([2, 3, 4]) AS n FROM grams_words),
grams_placed AS (SELECT label, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM grams_sized WHERE n <= length(w)),
grams AS (SELECT label, substring(w, i, n) AS term, count(*) AS tf FROM grams_placed GROUP BY ALL),
seen AS (SELECT term, count(*) AS df FROM grams GROUP BY term),
weighted AS (
  SELECT label, term, tf * (ln((1 + (SELECT count(*) FROM {labels_})) / (1 + df)) + 1) AS w FROM grams JOIN seen USING (term)),
unit AS (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY label)) AS w FROM weighted),
cosines AS (SELECT a.label AS x, b.label AS y, sum(a.w * b.w) AS s FROM unit a JOIN unit b USING (term) GROUP BY ALL),
similar_ AS MATERIALIZED (
  SELECT a.label AS x, b.label AS y, coalesce(s, 0) AS s
  FROM {labels_} a CROSS JOIN {labels_} b LEFT JOIN cosines c ON c.x = a.label AND c.y = b.label),
rounds(step, label, cluster) AS (
  SELECT 0, label, label FROM {labels_}
  UNION ALL
  (WITH means AS (
     SELECT a.cluster AS x, b.cluster AS y, round(avg(s), 9) AS m
     FROM rounds a JOIN similar_ ON similar_.x = a.label JOIN rounds b ON similar_.y = b.label
     WHERE a.cluster <> b.cluster GROUP BY ALL),
   near AS (SELECT x, arg_min(y, (-m, y)) AS y FROM means WHERE m > {1 - distance!r}::DOUBLE GROUP BY x),
   pairs AS (SELECT p.x AS kept, p.y AS gone FROM near p JOIN near q ON p.x = q.y AND p.y = q.x WHERE p.x < p.y)
   SELECT step + 1, label, coalesce(kept, cluster) FROM rounds LEFT JOIN pairs ON gone = cluster
   WHERE (SELECT count(*) FROM pairs) > 0)),
clusters AS (SELECT label, cluster FROM rounds WHERE step = (SELECT max(step) FROM rounds)),
label_map AS (
  SELECT label AS raw_label, first_value(label) OVER (PARTITION BY cluster ORDER BY n DESC, label) AS canonical
  FROM clusters JOIN {labels_} USING (label))"""


CLEAN_JOB_RULES = (
    r"state IN ('en', 'fr') AND created_on <= '2024-02-20' AND NOT regexp_matches(answer, '[\x{0900}-\x{097F}\x{0D00}-\x{0D7F}]')"
)
PART_NAMES = f"""WITH RECURSIVE names_ AS (SELECT p_name AS label, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1),
{merge_sql("names_", 0.6)}"""


@query("label_merge", f"{PART_NAMES} SELECT raw_label, canonical FROM label_map")
def label_merge(spark, sf):
    return labels.label_map(table(spark, sf, "part"), "p_name", 0.6)


@query(
    "merged_rows",
    f"{PART_NAMES} SELECT p_partkey, canonical AS p_name, p_name AS p_name_raw FROM part LEFT JOIN label_map ON p_name = raw_label",
)
def merged_rows(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return labels.merge_near_duplicate_labels(parts, "p_name", 0.6)


@query(
    "similar_labels",
    f"{PART_NAMES} SELECT x AS a, y AS b, round(s, 6) AS similarity, round(1 - s, 6) AS distance FROM similar_ WHERE x < y AND s > 0.35",
)
def similar_labels(spark, sf):
    """M5: pairs of labels by the distance of their spelling."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("label")).where("label IS NOT NULL").distinct()
    pairs = labels.similar_pairs(durable(labels.label_vectors(names)), 0.35)
    return rounded(pairs.withColumn("distance", 1 - F.col("similarity")), "similarity", "distance")


@query(
    "clean_job",
    f"""WITH RECURSIVE {DOCUMENT_CALLS},
advisory AS (SELECT * FROM clean WHERE {CLEAN_JOB_RULES}),
names_ AS (SELECT query_type AS label, count(*) AS n FROM advisory WHERE query_type IS NOT NULL GROUP BY 1),
{merge_sql("names_", labels.DISTANCE)}
SELECT call_id, crop, canonical AS query_type, query_type AS query_type_raw, created_on
FROM advisory LEFT JOIN label_map ON query_type = raw_label""",
)
def clean_job(spark, sf):
    """The whole cleaning job, label merge included."""
    return jobs.clean_calls(document_calls(spark, sf), states=["en", "fr"], end_date="2024-02-20").select(
        "call_id", "crop", "query_type", "query_type_raw", "created_on"
    )
