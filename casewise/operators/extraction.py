"""Structured extraction: prompt, responder, strict parsing of the responses, consistency.

A request is a distinct prompt and the number of its repeat. Each is asked once, however many calls have it, and its
answer or failure is a row of a table in a folder all machines share. A later run over the same folder asks only what
has no answer yet, and a task has few requests, so that a lost executor repeats little.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewise.functions.text import fill, let
from casewise.operators.joins import split_join
from casewise.operators.metrics import vote_agreement
from casewise.session import durable, shared_folder
from casewise.sources.tables import read_optional

# The record format that responses are held to.
CATEGORIES = (
    "Plant Protection",
    "Nutrient Management",
    "Weather",
    "Cultural Practices",
    "Market Information",
    "Other",
)
SIGNALS = ("resolved", "unresolved", "unclear")
DEFAULTS = {"category": "Other", "crop": "Unknown", "issue": "unspecified", "resolution_signal": "unclear"}
RAW_HEAD = 200
#: Requests of a task.
TASK_REQUESTS = 1_000
ANSWERS = "digest string, repeat int, raw string, error string, attempt int"

PROMPT = """Extract one structured event from this helpline call.
Reply with a single JSON object and no other text. Its fields:
"category": one of {categories}
"crop": the crop that is named, or "Unknown"
"issue": the specific problem in three to six words
"resolution_signal": one of {signals}; "resolved" for a concrete fix, "unresolved" for an answer \
that is generic or misses the question, "unclear" otherwise

Question: {question}
Answer: {answer}
"""


def prompt(question: Column, answer: Column, template: str = PROMPT) -> Column:
    """The prompt text of a row. ``template`` may be any text with the same fields."""
    quoted = [", ".join(f'"{v}"' for v in values) for values in (CATEGORIES, SIGNALS)]
    fixed = template.replace("{categories}", quoted[0]).replace("{signals}", quoted[1])
    return fill(fixed, question=question, answer=answer)


def parse_response(raw: Column, error: Column | None = None) -> Column:
    """A response text as a struct of the four fields, ``parse_error`` and ``raw_head``.

    The object is the text from the first "{" to the last "}". It must be one valid JSON
    object: wrapped in an array it must give exactly one element, which rules out trailing
    text and second objects. Unknown categories and signals fall back to their defaults.
    A row with ``error`` (the responder failed) gets the defaults and the error as its issue.
    """
    block = F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)\{.*\}", 0)
    fields = "array<struct<" + ",".join(f"{f}:string" for f in DEFAULTS) + ">>"
    objects = F.from_json(F.concat(F.lit("["), block, F.lit("]")), fields, {"allowSingleQuotes": "false"})
    failed = F.lit(False) if error is None else error.isNotNull()

    def record(objs: Column) -> Column:
        bad = failed | (block == "") | F.coalesce(F.size(objs) != 1, F.lit(True)) | F.get(objs, F.lit(0)).isNull()
        obj = F.get(objs, F.lit(0))

        def field(name: str, allowed: tuple[str, ...] | None = None) -> Column:
            value = F.coalesce(obj[name], F.lit(DEFAULTS[name]))
            if allowed:
                value = F.when(value.isin(*allowed), value).otherwise(DEFAULTS[name])
            broken = "parse_error" if name == "issue" else DEFAULTS[name]
            out = F.when(bad, broken).otherwise(value)
            return F.when(failed, "api_error").otherwise(out) if name == "issue" else out

        head = raw if error is None else F.coalesce(error, raw)
        return F.struct(
            field("category", CATEGORIES).alias("category"),
            field("crop").alias("crop"),
            field("issue").alias("issue"),
            field("resolution_signal", SIGNALS).alias("resolution_signal"),
            bad.alias("parse_error"),
            F.when(bad, F.substring(head, 1, RAW_HEAD)).alias("raw_head"),
        )

    return let(objects, record)


def respond(prompts: DataFrame, responder: Callable[[list[str]], list[str]], batch: int = 16) -> DataFrame:
    """Call a user-supplied responder on the ``prompt`` column, in the executors.

    Adds ``raw`` and ``error``; one failing batch marks its own rows and the job goes on.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw: list[str | None] = []
            errors: list[str | None] = []
            for start in range(0, len(frame), batch):
                texts = frame["prompt"].iloc[start : start + batch].tolist()
                try:
                    replies = list(responder(texts))
                    if len(replies) != len(texts):
                        raise ValueError(f"{len(replies)} responses to {len(texts)} prompts")
                    raw += replies
                    errors += [None] * len(texts)
                except Exception as problem:  # noqa: BLE001 - any responder failure is a row result
                    raw += [None] * len(texts)
                    errors += [str(problem)] * len(texts)
            yield frame.assign(raw=raw, error=errors)

    added = [T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())]
    return prompts.mapInPandas(run, T.StructType(prompts.schema.fields + added))


def ask(
    prompts: DataFrame, responder: Callable[[list[str]], list[str]], folder: str | None = None, batch: int = 16,
    task_requests: int = TASK_REQUESTS,
) -> DataFrame:
    """``prompts`` with ``raw`` and ``error``; the column ``repeat``, if there is one, tells equal requests apart.

    ``folder`` holds the answers of earlier runs and gets those of this one; without it, a new one is taken. A null prompt
    is not asked and has a null answer. A request that failed in all runs has the error of the last one.
    """
    spark = prompts.sparkSession
    folder = folder or f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}"
    key = ["digest", "repeat"]
    repeat = F.col("repeat").cast("int") if "repeat" in prompts.columns else F.lit(0)
    asked = prompts.withColumns({"digest": F.sha2("prompt", 256), "repeat": repeat})
    past = read_optional(spark, folder)
    if past is None:
        past = spark.createDataFrame([], ANSWERS)
    tried = past.groupBy(*key).agg(F.max("attempt").alias("attempt"), F.count_if(F.col("error").isNull()).alias("n_good"))
    requests = asked.where(F.col("prompt").isNotNull()).groupBy(*key).agg(F.max("prompt").alias("prompt"))
    todo = durable(requests.join(tried, key, "left").where(F.coalesce("n_good", F.lit(0)) == 0).drop("n_good"))
    n = todo.count()
    if n:
        number = (F.coalesce("attempt", F.lit(0)) + 1).cast("int").alias("attempt")
        found = respond(todo.repartition(math.ceil(n / task_requests)), responder, batch)
        found.select(*key, "raw", "error", number).write.mode("append").parquet(folder)
    every = spark.read.schema(ANSWERS).parquet(folder) if n else past
    best = every.groupBy(*key).agg(
        F.min_by(F.struct("raw", "error"), F.struct(F.col("error").isNotNull(), -F.col("attempt"))).alias("_a")
    )
    joined = split_join(asked, best, key, "left").withColumns({"raw": F.col("_a.raw"), "error": F.col("_a.error")})
    return joined.select(*prompts.columns, "raw", "error")


def first_rows(df: DataFrame, n: int, by: str) -> DataFrame:
    """The ``n`` first rows in the order of ``by``."""
    return df.orderBy(by).limit(n)


def run_extraction(
    calls: DataFrame,
    responder: Callable[[list[str]], list[str]],
    id_col: str = "call_id",
    question: str = "question",
    answer: str = "answer",
    n: int | None = None,
    answers: str | None = None,
) -> DataFrame:
    """One extracted record per call, carrying the call id.

    ``answers`` is a folder that keeps answers, so that a run after a failed one asks only for the rest.
    """
    rows = calls if n is None else first_rows(calls, n, id_col)
    asked = rows.select(id_col, prompt(F.col(question), F.col(answer)).alias("prompt"))
    return parse_responses(ask(asked, responder, answers), id_col, "raw", "error")


def parse_responses(responses: DataFrame, id_col: str, raw: str = "raw", error: str | None = None) -> DataFrame:
    """J2 over a table of responses that were produced elsewhere."""
    parsed = parse_response(F.col(raw), F.col(error) if error else None)
    return responses.select(id_col, parsed.alias("_r")).select(id_col, "_r.*")


def consistency_check(
    calls: DataFrame,
    responder: Callable[[list[str]], list[str]],
    n_records: int | None = 10,
    n_repeats: int = 3,
    id_col: str = "call_id",
    question: str = "question",
    answer: str = "answer",
    answers: str | None = None,
) -> DataFrame:
    """Ask each of the first calls (None: all) several times; how often do the values agree?"""
    repeats = F.explode(F.sequence(F.lit(1), F.lit(n_repeats))).alias("repeat")
    rows = calls if n_records is None else first_rows(calls, n_records, id_col)
    asked = rows.select(
        id_col, prompt(F.col(question), F.col(answer)).alias("prompt"), repeats
    )
    votes = parse_responses(ask(asked, responder, answers), id_col, "raw", "error")
    return vote_agreement(votes, id_col, ["category", "resolution_signal"])
