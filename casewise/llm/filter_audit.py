"""What filters do together, in every order: survivors, removals, redundancies and labels lost after each step.

Each filter has a relation of the ids that fail it, a table in the shared folder. The survivors of a set of filters are the
rows that a left-anti join with the relation of each of them leaves, whatever their order, so each set is computed once, from
the survivors of the set without its last filter. What a filter removes after a set is the left-semi join of that set's
survivors with the filter's relation; the rest of the relation was removed earlier and is redundant there. Rows that fail no
filter (a left-anti join with all relations) survive everything and are counted once. The report of the orders is put
together from the counts of the sets.

A row is known by a 128-bit key of its id and its text, because a verdict depends on nothing else: repeated rows are one row
with a count, so a text or an id that a third of the table repeats is added up before it is joined. A null text is empty. A
null part (and a null label) is the empty string (no label). A null id comes after all numbers: such a row has an earlier copy
if any row with an id has its text, has no labels, and copies without any id are not copies of each other. An id with several
rows in ``labels`` has a label if one of them has it. An empty table of documents gives no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import Tables, text_or_empty
from casewise.operators.joins import split_join

#: Separators of words.
SPACE = r"[\x20\x09-\x0D]+"
#: Filters that may be audited together: all orders of them are reported.
MOST_FILTERS = 6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


#: When a text fails, from the text and its words.
RULES: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The filter of texts that a smaller id has as well.
COPIES = "E"


def verdicts(
    docs: DataFrame, rules: Mapping[str, Callable[[Column, Column], Column]], id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """key, doc_id, digest, part, n, failed (names of the failed rules): one row for each id, text and part."""
    text = F.col("text")
    marks = F.transform(
        F.array(F.struct(text.alias("text"), _words(text).alias("words"))),
        lambda x: F.array_compact(F.array(*(F.when(rule(x.text, x.words), name) for name, rule in rules.items()))),
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    ).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.get(marks, F.lit(0)).alias("failed"))
    key = F.unhex(F.md5(F.concat("digest", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))))
    return rows.groupBy(key.alias("key"), "doc_id", "digest", "part").agg(
        F.count(F.lit(1)).alias("n"), F.first("failed").alias("failed")
    )


def later_copies(rows: DataFrame) -> DataFrame:
    """The keys of rows whose text a smaller id has as well."""
    lowest = rows.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("lost"))
    shared = lowest.where("low < high OR lost > 0").select("digest", "low")
    return split_join(rows.select("digest", "doc_id", "key"), shared, ["digest"], "inner").where(
        "doc_id > low OR (doc_id IS NULL AND low IS NOT NULL)"
    ).select("key").distinct()


def labelled(rows: DataFrame, labels: DataFrame, kinds: Mapping[str, Column], id_col: str = "doc_id") -> DataFrame:
    """``rows`` with a boolean column for each kind of label; rows without an id are spread by their text."""
    names = list(kinds)
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        *(F.max(F.coalesce(kinds[k], F.lit(False))).alias(k) for k in names)
    ).withColumn("spread", F.lit(b""))
    spread = F.when(F.col("doc_id").isNull(), F.col("digest")).otherwise(F.lit(b""))
    return rows.withColumn("spread", spread).join(known, ["doc_id", "spread"], "left").drop("spread").withColumns(
        {k: F.coalesce(k, F.lit(False)) for k in names}
    )


def _counted(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    losses = [F.sum(F.when(F.col(k), F.col("n")).otherwise(0)).alias(k) for k in names]
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), *losses)


def set_counts(rows: DataFrame, relations: Mapping[str, DataFrame], names: list[str], tables: Tables) -> tuple[DataFrame, DataFrame]:
    """(removed: before, filter, part, n and labels; survivors: before, part, n). A set of filters is the sum of their bits."""
    bits = {f: 1 << i for i, f in enumerate(relations)}
    any_fails = tables.store(_union([r for r in relations.values()]).distinct(), "any")
    clean = rows.join(any_fails, "key", "left_anti").groupBy("part").agg(F.sum("n").alias("n"))
    clean = tables.store(clean, "clean")
    alive = tables.store(rows.join(any_fails, "key", "left_semi").withColumn("before", F.lit(0)), "alive-0")
    removed, survivors = [], [clean.withColumn("before", F.explode(F.sequence(F.lit(0), F.lit((1 << len(bits)) - 1))))]
    for size in range(len(bits)):
        lacking = lambda f: alive.where(F.col("before").bitwiseAND(F.lit(bits[f])) == 0)  # noqa: B023,E731
        gone = [
            _counted(lacking(f).join(relation, "key", "left_semi"), ["before", "part"], names).withColumn("filter", F.lit(f))
            for f, relation in relations.items()
        ]
        removed.append(tables.store(_union(gone), f"removed-{size}"))
        survivors.append(tables.store(alive.groupBy("before", "part").agg(F.sum("n").alias("n")), f"survivors-{size}"))
        if size == len(bits) - 1:
            break
        left = [  # each set from the set without its last filter
            alive.where(F.col("before") < bits[f]).join(relation, "key", "left_anti")
            .withColumn("before", (F.col("before") + bits[f]).cast("int"))
            for f, relation in relations.items() if bits[f] >= 1 << size
        ]
        alive = tables.store(_union(left), f"alive-{size + 1}")
    survivors = _union(survivors).groupBy("before", "part").agg(F.sum("n").alias("n"))
    return _union(removed), survivors


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _steps(filters: list[str]) -> str:
    """All steps of all orders."""
    bits = {f: 1 << i for i, f in enumerate(filters)}
    return json.dumps([
        {"filter_order": "".join(order), "step": i + 1, "filter": f, "before": sum(bits[g] for g in order[:i])}
        for order in itertools.permutations(filters) for i, f in enumerate(order)
    ])


def audit(
    docs: DataFrame, labels: DataFrame, rules: Mapping[str, Callable[[Column, Column], Column]] = RULES, copies: str | None = COPIES,
    kinds: Mapping[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """One row for each part, order of the filters and step.

    part, filter_order, step, then counts of the part's rows: kept after the step, removed by it, redundant (fail its filter,
    removed earlier), unique_fails (fail its filter only), a column <kind>_lost for each kind of label, and shapley (what its
    filter removes, summed over all orders).
    """
    kinds = kinds if kinds is not None else {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    filters = sorted([*rules, *([copies] if copies else [])])
    if not filters or len(filters) > MOST_FILTERS:
        raise ValueError(f"all orders of 1 to {MOST_FILTERS} filters can be reported")
    names = [f"{k}_lost" for k in kinds]
    tables, kept = Tables(docs.sparkSession), Tables(docs.sparkSession)
    rows = tables.store(verdicts(docs, rules, id_col, text_col, part_col), "rows")
    relations = {
        f: tables.store(
            later_copies(rows) if f == copies else rows.where(F.array_contains("failed", f)).select("key").distinct(), f"fails-{i}"
        )
        for i, f in enumerate(filters)
    }
    marked = labelled(rows, labels, {f"{k}_lost": column for k, column in kinds.items()}, id_col)
    removed, survivors = set_counts(marked.select("key", "part", "n", *names), relations, names, tables)
    removed = kept.store(removed, "removed")
    survivors = kept.store(survivors, "survivors")
    parts = kept.store(rows.select("part").distinct(), "parts")
    tables.drop()

    bits, last = {f: 1 << i for i, f in enumerate(filters)}, len(filters) - 1
    bit = F.element_at(F.create_map(*(F.lit(x) for pair in bits.items() for x in pair)), F.col("filter"))
    orders = F.get(F.array(*(F.lit(math.factorial(k) * math.factorial(last - k)) for k in range(last + 1))), F.bit_count("before"))
    alone = F.col("before") == F.lit((1 << len(filters)) - 1) - bit
    whole = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("n"))).alias("fails"), F.sum(F.when(alone, F.col("n"))).alias("unique_fails"),
        F.sum(F.col("n") * orders).alias("shapley"),
    )
    schema = "array<struct<filter_order:string,step:int,filter:string,before:int>>"
    steps = parts.select("part", F.inline(F.from_json(F.lit(_steps(filters)), schema))).withColumn("after", F.col("before") + bit)
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long")
    return (
        steps.join(removed.withColumnRenamed("n", "removed"), ["part", "filter", "before"], "left")
        .join(survivors.select("part", F.col("before").alias("after"), F.col("n").alias("kept")), ["part", "after"], "left")
        .join(whole, ["part", "filter"], "left")
        .select(
            "part", "filter_order", "step", zero("kept").alias("kept"), zero("removed").alias("removed"),
            (zero("fails") - zero("removed")).alias("redundant"), zero("unique_fails").alias("unique_fails"),
            *(zero(name).alias(name) for name in names), zero("shapley").alias("shapley"),
        )
    )
