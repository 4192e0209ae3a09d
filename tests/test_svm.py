"""The solver against a dense Newton method, and rows brought to the model of their key."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casewise.operators import hierarchy, routing, svm
from casewise.operators.dictionary import Sparse, weighted
from casewise.operators.hierarchy import HierarchicalClassifier


def made(n, width, classes, seed=0):
    """Unit-length sparse rows, with a term that tells the class, and their classes."""
    rng = np.random.default_rng(seed)
    places = np.concatenate([np.arange(classes), rng.integers(0, classes, n - classes)])
    idx = [np.unique(np.append(rng.integers(0, width, rng.integers(1, 12)), k % width)) for k in places]
    counts = np.array([len(i) for i in idx])
    weights = rng.random(counts.sum()) + 0.1
    row = np.repeat(np.arange(n), counts)
    return places, Sparse(counts, np.concatenate(idx), weights / np.sqrt(np.bincount(row, weights**2, n))[row])


def table(spark, spaces, path):
    found = [b for name, (places, rows) in spaces.items() for part in range(3) for b in svm.packed_blocks(
        name, places[part::3], rows.rows(np.arange(len(places))[part::3])
    )]
    spark.createDataFrame(pa.Table.from_batches(found)).repartition(5).write.parquet(path)
    return spark.read.schema(svm.BLOCKS).parquet(path)


def newton(places, rows, width, classes, k, C):
    """The objective's minimum by Newton steps over the whole Hessian."""
    x = np.zeros((len(places), width + 1))
    x[np.repeat(np.arange(len(places)), rows.counts), rows.idx] = rows.weights
    x[:, -1] = 1
    y = np.where(places == k, 1.0, -1.0)
    balanced = len(places) / (classes * np.bincount(places, minlength=classes))
    cost = C * np.where((places == k) | (classes == 2), balanced[places], 1.0)
    value = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    w = np.zeros(width + 1)
    for _ in range(100):
        short = np.maximum(0, 1 - y * (x @ w))
        on = short > 0
        g = w - 2 * x.T @ (cost * y * short)
        if np.abs(g).max() < 1e-11:
            break
        step = np.linalg.solve(np.eye(width + 1) + 2 * (x[on].T * cost[on]) @ x[on], -g)
        t = 1.0
        while value(w + t * step) > value(w) + 1e-4 * t * g @ step and t > 1e-12:
            t /= 2
        w = w + t * step
    return w


SPACES = {"many": (300, 40, 5), "two": (200, 30, 2), "three": (90, 12, 3)}


@pytest.fixture(scope="module")
def data():
    return {name: made(n, width, classes, i) for i, (name, (n, width, classes)) in enumerate(SPACES.items())}


@pytest.mark.parametrize("own_work, most_weights", [(1 << 24, 1 << 20), (0, 1 << 20), (0, 150), (1 << 24, 100), (4000, 200)])
def test_weights_equal_a_newton_solve(spark, data, tmp_path, own_work, most_weights):
    """In one task, in passes over all tasks, and in rounds and slices of classes."""
    blocks = table(spark, data, str(tmp_path / "blocks"))
    info = [(name, SPACES[name][1], np.bincount(places, minlength=SPACES[name][2]).tolist()) for name, (places, _) in data.items()]
    spaces = spark.createDataFrame(info, "space string, width int, sizes array<bigint>")
    found = svm.solve(blocks, spaces, (0.5, 2.0), 1e-7, 1000, most_weights, own_work).collect()
    assert sorted((r["space"], r["place"], r["c"]) for r in found) == sorted(
        (name, k, c) for name, (_, _, classes) in SPACES.items() for k in ([1] if classes == 2 else range(classes)) for c in (0, 1)
    )
    for r in found:
        places, rows = data[r["space"]]
        exact = newton(places, rows, *SPACES[r["space"]][1:], r["place"], (0.5, 2.0)[r["c"]])
        assert np.abs(np.append(r["weights"], r["intercept"]) - exact).max() < 1e-4


def test_blocks_of_solved_spaces_are_read_no_more(spark, data, tmp_path, monkeypatch):
    blocks = table(spark, data, str(tmp_path / "blocks"))
    info = [(name, SPACES[name][1], np.bincount(places, minlength=SPACES[name][2]).tolist()) for name, (places, _) in data.items()]
    spaces, seen, one_pass = spark.createDataFrame(info, "space string, width int, sizes array<bigint>"), [], svm._pass

    def noted(blocks, tasks, slices, *more):
        seen.append(({r["space"] for r in blocks.select("space").distinct().collect()}, {s.space for s in slices.values()}))
        return one_pass(blocks, tasks, slices, *more)

    monkeypatch.setattr(svm, "_pass", noted)
    svm.solve(blocks, spaces, (2.0,), 1e-3, 100, own_work=0).collect()
    assert seen[0][0] == set(SPACES) and len(seen[-1][0]) < len(SPACES)
    assert all(read == open_ for read, open_ in seen)


def test_more_than_a_thousand_classes(spark, tmp_path):
    classes, width = 1_100, 1_100
    places = np.repeat(np.arange(classes), 2)
    rows = Sparse(np.ones(len(places), int), places % width, np.ones(len(places)))
    blocks = table(spark, {"all": (places, rows)}, str(tmp_path / "blocks"))
    spaces = spark.createDataFrame([("all", width, [2] * classes)], "space string, width int, sizes array<bigint>")
    found = svm.solve(blocks, spaces, (2.0,), 1e-3).collect()
    assert sorted(r["place"] for r in found) == list(range(classes))
    for r in found:
        assert int(np.argmax(r["weights"])) == r["place"] and r["weights"][r["place"]] + r["intercept"] > 0


def test_more_than_a_thousand_categories_and_labels(spark, rows):
    """Every category is a class of the first level and a level of its own; the plan is the same as for two."""
    def calls(n):
        words = F.concat_ws(" ", F.concat(F.lit("word"), (F.col("id") % n).cast("string")), F.concat(F.lit("kind"), (F.col("k") % 2).cast("string")))
        made_ = spark.range(n * 6).withColumn("k", (F.col("id") / n).cast("int"))
        return made_.select(words.alias("question"), F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("category"), F.concat(F.lit("q"), (F.col("k") % 2).cast("string")).alias("query_type"))

    model = HierarchicalClassifier(max_iter=15).fit(calls(1_050))
    found = model.predict(calls(1_050))
    assert found.where("pred_category = category").count() == 6_300
    assert found.where("pred_query_type = query_type").count() == 6_300
    few = HierarchicalClassifier(max_iter=15).fit(calls(2)).predict(calls(2))
    nodes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert nodes(found) == nodes(few)


@pytest.fixture(scope="module")
def model(spark):
    texts = {("a", "x"): "rust leaf spot", ("a", "y"): "market price rate", ("b", "x"): "rain wind cloud", ("b", "y"): "seed rate sowing", ("b", "z"): "loan bank form", ("c", "only"): "cow milk feed"}
    data = [(f"{t} {k % 5}{k % 3} extra{k}", c, q) for (c, q), t in texts.items() for k in range(9)]
    return HierarchicalClassifier().fit(spark.createDataFrame(data, "question string, category string, query_type string"))


def test_routing_gives_the_labels_of_one_pass(spark, model, rows):
    texts = ["rust leaf", "price of seed", "rain", "milk", "bank form", None, "", "nothing known", "rate"] * 40
    asked = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, question string, space string").repartition(6)
    at_once = rows(model.predict(asked))
    assert "Exchange" not in model.predict(asked.coalesce(1))._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    routed = HierarchicalClassifier(terms=model.terms, classes=model.classes, plan=model.plan, broadcast_bytes=0, part_rows=7)
    assert rows(routed.predict(asked)) == at_once and len(at_once) == len(texts)
    assert routed.predict(asked).columns == ["id", "question", "space", "pred_category", "pred_query_type", "category_confidence", "query_type_confidence"]
    assert rows(routed.predict(asked.where("id < 0"))) == rows(model.predict(asked.where("id < 0"))) == []


def test_fitting_by_routing_gives_the_same_model(spark, model):
    texts = [(f"{w} {k % 5}{k % 3} extra{k}", c, q) for c, q, w in [("a", "x", "rust leaf"), ("a", "y", "price rate"), ("b", "x", "rain wind")] for k in range(8)]
    calls = spark.createDataFrame(texts, "question string, category string, query_type string")
    one = HierarchicalClassifier(tolerance=1e-6).fit(calls)
    two = HierarchicalClassifier(tolerance=1e-6, broadcast_bytes=0, part_rows=3).fit(calls)
    weights = lambda m: {(r["space"], r["place"]): r["weights"] for r in m.classes.collect()}
    a, b = weights(one), weights(two)
    assert a.keys() == b.keys()
    for key in a:
        assert (a[key] is None) == (b[key] is None) and (a[key] is None or np.allclose(a[key], b[key], atol=1e-3))


def test_training_tables_without_rows_or_with_one_class(spark, rows):
    schema = "question string, category string, query_type string"
    asked = spark.createDataFrame([("rust",), (None,)], "question string")
    empty = HierarchicalClassifier().fit(spark.createDataFrame([], schema))
    assert rows(empty.predict(asked)) == sorted([("rust", None, "UNKNOWN", None, None), (None, None, "UNKNOWN", None, None)], key=repr)
    one = HierarchicalClassifier().fit(spark.createDataFrame([("rust leaf", "a", "x")] * 4, schema))
    assert rows(one.predict(asked), "pred_category", "pred_query_type", "category_confidence") == [("a", "x", 0.5)] * 2
    blank = HierarchicalClassifier().fit(spark.createDataFrame([("", "a", "x"), (None, "a", "x"), ("", "b", "x"), ("", "b", "x"), ("", "b", "x")], schema))
    assert blank.predict(asked).where("pred_category IS NULL").count() == 0


def test_hot_key_is_cut_into_parts(spark):
    """A key with most rows is shared out, each part with a copy of the model, and rows without a model are kept."""
    data = spark.range(3000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").otherwise("none").alias("space"), "id")
    models = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 5)], "space string, add int")
    sizes = models.groupBy("space").agg(F.lit(10).alias("bytes"))

    def run(model, batch):
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array([sum(model)] * batch.num_rows, pa.int64()), pa.array([batch.num_rows] * batch.num_rows, pa.int64())
        ], ["id", "add", "rows"])

    prepare = lambda found: [r["add"] for r in found]
    schema = "id bigint, add bigint, rows bigint"
    for most, parts in ((0, 100), (1000, 100)):
        got = {r["id"]: (r["add"], r["rows"]) for r in routing.routed(data, models, sizes, prepare, run, schema, most, parts).collect()}
        assert {i: a for i, (a, _) in got.items()} == {i: 3 if i % 10 < 8 else 5 if i % 10 == 8 else 0 for i in range(3000)}
        if not most:
            assert max(n for _, n in got.values()) < 250


def test_weighted_rows_and_margins():
    hashes, idx, idf = np.array([-5, 2, 9]), np.array([2, 0, 1]), np.array([1.0, 2.0, 3.0])
    rows = weighted(np.array([9, 9, 2, 7, 7, -5]), np.array([3, 2, 0, 1]), hashes, idx, idf)
    a, b = 2.0, (1 + np.log(2)) * 3
    assert rows.counts.tolist() == [2, 0, 0, 1] and rows.idx.tolist() == [0, 1, 2]
    assert np.allclose(rows.weights, [a / np.hypot(a, b), b / np.hypot(a, b), 1.0])
    level = hierarchy.Level([
        {"place": None, "label": None, "weights": None, "hashes": hashes, "idx": idx, "idf": idf},
        *({"place": k, "label": f"l{k}", "weights": w, "intercept": 0.5 * k, "hashes": None} for k, w in enumerate([[1, 0, 0], [0, 1, 0], [0, 0, 2]])),
    ])
    assert np.allclose(level.margins(rows), [[rows.weights[0], rows.weights[1] + 0.5, 1.0], [0, 0.5, 1], [0, 0.5, 1], [0, 0.5, 3]])
