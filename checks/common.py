"""How the given tables stand for call records, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators.event_log import build_event_log
from casewise.sources.tables import spread

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, its SQL."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# -- event logs --------------------------------------------------------------------------


def events_log(spark: SparkSession, sf: str) -> DataFrame:
    """Short cases: a user's day; segment = user, state = day, season = the event's props."""
    events = table(spark, sf, "events").withColumns(
        {"day": F.date_format("ts", "yyyy-MM-dd"), "user": F.col("user_id").cast("string")}
    )
    return build_event_log(
        events,
        activity_col="event_type",
        case_cols=("user_id", "day"),
        ts_col="ts",
        ord_col="event_id",
        attributes={"state": "day", "crop": "user", "season": "props"},
    )


EVENTS_LOG = """
log AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS case_id, event_type AS activity,
         ts, event_id AS ord, strftime(ts, '%Y-%m-%d') AS state, CAST(user_id AS VARCHAR) AS crop, props AS season
  FROM events)"""


def orders_log(spark: SparkSession, sf: str) -> DataFrame:
    """Long cases with tied times: nation and segment of the customer; activity = priority."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    calls = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return build_event_log(
        calls,
        activity_col="o_orderpriority",
        case_cols=("n_name", "c_mktsegment"),
        ts_col="o_orderdate",
        ord_col="o_orderkey",
        attributes={"state": "n_name", "crop": "c_mktsegment", "season": "o_orderstatus"},
    )


ORDERS_LOG = """
log AS (
  SELECT n_name || '_' || c_mktsegment AS case_id, o_orderpriority AS activity, o_orderdate AS ts,
         o_orderkey AS ord, n_name AS state, c_mktsegment AS crop, o_orderstatus AS season
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

#: one row per case: counts, repeats, loop rate, whole days, first crop and state
CASES = """
cases AS (
  SELECT case_id, count(*) AS n_events, count(*) - count(DISTINCT activity) AS n_repeats,
         (count(*) - count(DISTINCT activity)) / count(*) AS loop_rate,
         date_sub('day', min(ts), max(ts)) AS duration_days,
         first(crop ORDER BY ts, ord) AS crop, first(state ORDER BY ts, ord) AS state
  FROM log GROUP BY case_id)"""

#: one row per case: its sequence and modal season, lowest on a tie
VARIANTS = """
season_counts AS (SELECT case_id, season, count(*) AS n FROM log WHERE season IS NOT NULL GROUP BY ALL),
seasons AS (
  SELECT case_id, season FROM season_counts
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY n DESC, season) = 1),
variants AS (
  SELECT case_id, string_agg(activity, ' -> ' ORDER BY ts, ord) AS variant, count(*) AS n_steps,
         first(crop ORDER BY ts, ord) AS crop, first(state ORDER BY ts, ord) AS state, any_value(seasons.season) AS season
  FROM log LEFT JOIN seasons USING (case_id) GROUP BY case_id)"""

VARIANT_COUNTS = """
variant_names AS (SELECT variant, crop, count(*) AS n FROM variants GROUP BY ALL),
variant_counts AS (
  SELECT variant, CAST(sum(n) AS BIGINT) AS n_cases,
         array_to_string(list_slice(list_sort(list(crop)), 1, 3), ', ') AS example_crops,
         (SELECT any_value(n_steps) FROM variants v WHERE v.variant = variant_names.variant) AS n_steps,
         sum(n) * 100.0 / (SELECT count(*) FROM variants) AS pct_of_cases
  FROM variant_names GROUP BY variant)"""

#: next activity in the case, null at its end
STEPS = """
steps AS (
  SELECT activity, lead(activity) OVER w AS next_activity, row_number() OVER w = 1 AS is_start
  FROM log WINDOW w AS (PARTITION BY case_id ORDER BY ts, ord))"""


# -- calls -------------------------------------------------------------------------------


def document_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw calls; some dates do not exist, some answers are junk."""
    docs = spread(table(spark, sf, "documents"))
    junk = (F.col("lang") == "de") & (F.col("n_chars") % 5 == 0)
    return docs.select(
        F.col("doc_id").alias("call_id"),
        F.col("lang").alias("state"),
        F.concat("lang", (F.col("n_chars") % 7).cast("string")).alias("district"),
        F.concat(F.lit(" crop "), (F.col("n_chars") % 11).cast("string"), F.lit("\t")).alias("crop"),
        F.col("lang").alias("category"),
        F.col("source").alias("query_type"),
        F.lit(None).cast("string").alias("season"),
        F.concat(F.lit("  "), "text").alias("question"),
        F.when(junk, F.lit("Irrelevant Call")).otherwise(F.col("text")).alias("answer"),
        F.concat(F.lit("2024-02-"), F.lpad((F.col("n_chars") % 31 + 1).cast("string"), 2, "0")).alias("created_on"),
    )


DOCUMENT_CALLS = r"""
raw AS (
  SELECT doc_id AS call_id, lang AS state, lang || (n_chars % 7) AS district,
         ' crop ' || (n_chars % 11) || chr(9) AS crop, lang AS category, source AS query_type,
         '  ' || text AS question,
         CASE WHEN lang = 'de' AND n_chars % 5 = 0 THEN 'Irrelevant Call' ELSE text END AS answer,
         '2024-02-' || lpad(CAST(n_chars % 31 + 1 AS VARCHAR), 2, '0') AS created_on
  FROM documents),
stripped AS (
  SELECT call_id, category, query_type, state, district,
         regexp_replace(crop, '^\s+|\s+$', '', 'g') AS crop,
         regexp_replace(question, '^\s+|\s+$', '', 'g') AS question,
         regexp_replace(answer, '^\s+|\s+$', '', 'g') AS answer,
         TRY_CAST(created_on AS TIMESTAMP) AS created_on
  FROM raw),
kept AS (
  SELECT * FROM stripped
  WHERE length(question) > 3 AND length(answer) > 3
    AND lower(answer) NOT IN ('irrelevant call', 'nan', '') AND created_on IS NOT NULL),
clean AS (
  SELECT * FROM kept
  QUALIFY row_number() OVER (PARTITION BY question, answer, district, created_on ORDER BY call_id) = 1)"""


def question_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn with the assistant turn that directly follows it.

    The pair is found by an equality on (conversation, turn), which a conversation of any
    length shares out over all tasks.
    """
    turns = spread(table(spark, sf, "conversations"))
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"]).withColumn(
        "crop", F.concat(F.lit("s"), (F.col("conv_id") % 10).cast("string"))
    )


QUESTION_ANSWERS = """
turns AS (
  SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
qa AS (
  SELECT conv_id, turn, question, answer, 's' || (conv_id % 10) AS crop
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""
