"""The filter audit against a plain version that applies every order to a list."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from casewise.llm import filter_audit, queries
from checks.compare import connect, difference
from tests.llm.test_operators import docs, nothing  # noqa: F401

LABELS = "doc_id bigint, quality int, toxic int"


def plain_fails(rows):
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        same = [j for j, u, _ in rows if (u or "") == t and j is not None]
        if any(i is None or j < i for j in same):
            fails.add("E")
        out.append(fails)
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, out = plain_fails(rows), []
    for part in sorted({p or "" for _, _, p in rows}):
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                redundant = sum(f in fails[k] for k in own) - len(gone)
                left = [k for k in left if f not in fails[k]]
                alone = sum(fails[k] == {f} for k in own)
                shapley[f] += len(gone)
                lost = [sum(rows[k][0] in ids for k in gone) for ids in (good, toxic)]
                found.append((f, (part, "".join(order), step, len(left), len(gone), redundant, alone, *lost)))
        out += [(*row, shapley[f]) for f, row in found]
    return sorted(out)


def fixture_rows():
    long = " ".join(f"word{i}" for i in range(250))
    few = "same words again and " * 80
    base = [
        long, long + " #", few, few + "$", "SHOUT " * 210, "short", "Short & |", None, "", "   \n", long.replace("w", "W", 40), few + "X" * 90,
    ]
    rows = [(i, t, [None, "a", "", "b", "b", "b"][i % 6]) for i, t in enumerate(base * 2)]
    return [*rows, *[(3, few + "$", "b")] * 40, (None, long, "a"), (None, long, "a"), (None, "no id", "c"), (None, "no id", "c"), (-5, "no id 2", None)]


LABEL_ROWS = [(i, i % 2, (i % 3 == 0) * 1) for i in range(0, 24, 1)] + [(2, 1, None), (None, 1, 1), (3, None, 1), (3, 1, 0)]


def test_audit_equals_plain_version(spark):
    rows = fixture_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("part", F.lit("x")).withColumn("before", F.lit(1))
    got = filter_audit.audit(frame.repartition(5), spark.createDataFrame(LABEL_ROWS, LABELS))
    assert got.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, LABEL_ROWS)


def test_audit_of_mixed_texts_and_without_labels(spark, docs, nothing):  # noqa: F811
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    none = spark.createDataFrame([], LABELS)
    assert sorted(map(tuple, filter_audit.audit(docs, none).collect())) == plain_audit(rows, [])
    assert filter_audit.audit(nothing, none).collect() == []


def test_other_rules(spark):
    rows = spark.createDataFrame([(1, "a b", "p"), (2, "a", "p"), (3, "a b", None)], "id long, body string, origin string")
    rules = {"short": lambda text, words: F.size(words) < 2, "b": lambda text, words: text.contains("b")}
    got = filter_audit.audit(
        rows, spark.createDataFrame([(2, True)], "id long, best boolean"), rules, None, {"best": F.col("best")}, "id", "body", "origin"
    )
    # labels are found by the documents' id column unless told otherwise
    assert sorted(map(tuple, got.where("part = 'p'").collect())) == [
        ("p", "bshort", 1, 1, 1, 0, 1, 0, 2), ("p", "bshort", 2, 0, 1, 0, 1, 1, 2),
        ("p", "shortb", 1, 1, 1, 0, 1, 1, 2), ("p", "shortb", 2, 0, 1, 0, 1, 0, 2),
    ]
    with pytest.raises(ValueError):
        filter_audit.audit(rows, rows, {}, None)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_its_sql(spark, sf):
    found = queries.op13_filter_audit(spark, sf).toPandas()
    assert difference(found, connect(sf).execute(queries.SQL_OP13).df()) is None
