"""Two-level text classification: category first, then query type within the category.

Linear support vector machines over TF-IDF, one per class against the rest. A level is a *space*: a vocabulary, its
classes and their weights. All spaces are rows of three tables, so a model has any number of categories, classes and
terms, and no step's plan grows with them: vocabularies are ranked together (``dictionary``), all problems are solved in
the same passes (``svm``), and rows are labelled by the model of their category, sent to all tasks where the models are
small together and shuffled to it where they are not (``routing``).

Texts are known to the model by the hashes of their terms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.functions.text import term_counts
from casewise.operators import grams, svm, tfidf
from casewise.operators.dictionary import Sparse, packed_terms, ranked_terms, weighted
from casewise.operators.joins import lookup
from casewise.operators.metrics import per_class, summary
from casewise.operators.routing import BROADCAST_BYTES, FEW_KEYS, PART_ROWS, routed
from casewise.session import durable

UNKNOWN = "UNKNOWN"
#: The space of the categories; that of a category's query types has the category after ``WITHIN``.
TOP, WITHIN = "categories", "within "
#: Terms of the category level and of a category, and the least number of texts that have them.
TOP_TERMS, TOP_MIN_DF, TERMS, MIN_DF = 6000, 2, 3000, 1
#: Margins (rows by classes) computed at once.
MARGINS = 1 << 21
PREDICTED = "pred_category string, category_confidence double, pred_query_type string, query_type_confidence double"


def level2_plan(df: DataFrame, category: str, query_type: str, min_class_count: int = 3) -> DataFrame:
    """L3: per category, whether to train and otherwise which label to fall back to.

    Classes below the count are dropped first. Fewer than two classes or four rows: the most
    frequent class, the lowest on a tie; nothing left: no label.
    """
    return _plan(df.groupBy(category, query_type).agg(F.count(F.lit(1)).alias("n")), category, query_type, min_class_count)


def _plan(sizes: DataFrame, category: str, query_type: str, min_class_count: int) -> DataFrame:
    enough = (F.col("n") >= min_class_count) & F.col(query_type).isNotNull()
    plan = sizes.groupBy(category).agg(
        F.count_if(enough).alias("n_classes"),
        F.sum(F.when(enough, F.col("n")).otherwise(0)).alias("n_rows"),
        F.min(F.when(enough, F.struct((-F.col("n")).alias("rarity"), F.col(query_type).alias("label")))).alias("top"),
    )
    train = (F.col("n_classes") >= 2) & (F.col("n_rows") >= 4)
    return plan.select(
        F.col(category).alias("category"),
        "n_classes",
        "n_rows",
        F.when(train, "train").when(F.col("n_rows") > 0, "fallback").otherwise("none").alias("decision"),
        F.when(~train, F.col("top.label")).alias("fallback_label"),
    )


def _within(category: Column) -> Column:
    return F.concat(F.lit(WITHIN), category)


def _hashes(text: Column, terms: DataFrame) -> Column:
    """Hashes of the terms of a text: of those that the vocabularies have, or of all where tasks cannot hold these."""
    known = grams.known_hashes(terms, text)
    return F.transform(tfidf.text_terms(text), lambda t: F.xxhash64(t)) if known is None else known


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column without nulls as (flat values, lengths)."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


# -- labelling --------------------------------------------------------------------------------


class Level:
    """One space as a task sees it; without weights it has one label for all rows, or none."""

    def __init__(self, rows: list[dict]):
        self.fallback = next((r["label"] for r in rows if r["place"] == -1), None)
        terms = [r for r in rows if r["place"] is None]
        classes = sorted((r for r in rows if r["place"] is not None and r["place"] >= 0), key=lambda r: r["place"])
        self.labels = np.array([r["label"] for r in classes], object)
        own = [r for r in classes if r["weights"] is not None]
        hashes, idx, idf = ([], [], []) if not terms else (terms[0][c] for c in ("hashes", "idx", "idf"))
        self.terms = np.array(hashes, np.int64), np.array(idx, np.int64), np.array(idf, np.float64)
        self.weights = np.array([r["weights"] for r in own], np.float64).reshape(len(own), len(hashes)).T.copy()
        self.intercepts = np.array([r["intercept"] for r in own], np.float64)

    def margins(self, rows: Sparse) -> np.ndarray:
        out = np.tile(self.intercepts, (len(rows.counts), 1))
        if len(rows.idx):
            filled = np.flatnonzero(rows.counts)
            starts = (np.cumsum(rows.counts) - rows.counts)[filled]
            out[filled] += np.add.reduceat(self.weights[rows.idx] * rows.weights[:, None], starts, axis=0)
        return out

    def decide(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(label, confidence) of each row (M2, M3); nan stands for no confidence. The first of equal margins wins."""
        n = len(counts)
        if not len(self.labels):
            return np.full(n, self.fallback, object), np.full(n, np.nan)
        if len(self.labels) == 1:
            return np.full(n, self.labels[0], object), np.full(n, 0.5)
        place, sure = np.zeros(n, np.int64), np.zeros(n)
        ends, row = np.cumsum(counts), 0
        while row < n:  # a bounded number of products at once
            done = ends[row - 1] if row else 0
            to = max(row + 1, min(n, int(np.searchsorted(ends, done + MARGINS // max(1, len(self.intercepts)), "right"))))
            m = self.margins(weighted(flat[done : ends[to - 1]], counts[row:to], *self.terms))
            if len(self.labels) == 2:
                place[row:to] = m[:, 0] > 0
                sure[row:to] = 1.0 / (1.0 + np.exp(-np.abs(m[:, 0])))
            else:
                place[row:to] = m.argmax(1)
                sure[row:to] = 1.0 / np.exp(m - m.max(1, keepdims=True)).sum(1)
            row = to
        return self.labels[place], sure


def _one_pass(batch: pa.RecordBatch, level) -> list[pa.Array]:
    """The columns ``PREDICTED``; ``level(space)`` gives the model of a space."""
    flat, counts = _lists(batch.column("hashes"))
    category, sure = level(TOP).decide(flat, counts)
    kind, type_sure = np.full(len(counts), None, object), np.full(len(counts), np.nan)
    starts = np.cumsum(counts) - counts
    names, codes = np.unique(np.array([c or "" for c in category], object).astype(str), return_inverse=True)
    for code, name in enumerate(names):
        own = np.flatnonzero((codes == code) & (category != None))  # noqa: E711
        if len(own):
            at = np.repeat(starts[own] - (np.cumsum(counts[own]) - counts[own]), counts[own]) + np.arange(counts[own].sum())
            kind[own], type_sure[own] = level(WITHIN + str(name)).decide(flat[at], counts[own])
    return _answers(category, sure, kind, type_sure)


def _answers(category, sure, kind, type_sure) -> list[pa.Array]:
    kind = np.where(kind == None, UNKNOWN, kind)  # noqa: E711
    numbers = [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in (sure, type_sure)]
    return [pa.array(category, pa.string()), numbers[0], pa.array(kind, pa.string()), numbers[1]]


# -- the classifier ------------------------------------------------------------------------------


@dataclass
class HierarchicalClassifier:
    """L1, L4-L6. A fitted model is three tables.

    ``terms``: space, term, idx, idf. ``classes``: space, place, label, weights, intercept; of two classes the first has no
    weights, and the positive side is the second. ``plan``: category, decision, fallback_label.
    """

    min_class_count: int = 3
    C: float = 2.0
    max_iter: int = 100
    tolerance: float = svm.TOLERANCE
    terms: DataFrame | None = None
    classes: DataFrame | None = None
    plan: DataFrame | None = None
    broadcast_bytes: int = BROADCAST_BYTES
    part_rows: int = PART_ROWS

    def fit(
        self, df: DataFrame, text: str = "question", category: str = "category", query_type: str = "query_type"
    ) -> HierarchicalClassifier:
        fitted = self.fit_grid(df, (self.C,), text, category, query_type)[0]
        self.terms, self.classes, self.plan = fitted.terms, fitted.classes, fitted.plan
        return self

    def fit_grid(
        self, df: DataFrame, grid: Sequence[float], text: str = "question", category: str = "category", query_type: str = "query_type"
    ) -> list[HierarchicalClassifier]:
        """One model for each C, from one vocabulary, one packing of the rows and the same passes."""
        docs = df.select(
            grams.lowered(F.col(text)).alias("text"), F.col(category).alias("category"), F.col(query_type).alias("query_type"),
        ).where(F.col("category").isNotNull())
        sizes = durable(docs.groupBy("category", "query_type").agg(F.count(F.lit(1)).alias("n")))
        plan = durable(_plan(sizes, "category", "query_type", self.min_class_count))
        classes = durable(self._classes(sizes, plan))
        # read once for the vocabularies and the vectors; a lost part is computed again from the input
        docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            terms, blocks = self._packed(docs, classes)
        finally:
            docs.unpersist()
        sizes = F.transform(F.sort_array(F.collect_list(F.struct("place", "n"))), lambda x: x.n)
        widths = terms.groupBy("space").agg(F.count(F.lit(1)).cast("int").alias("width"))
        spaces = classes.groupBy("space").agg(sizes.alias("sizes")).where(F.size("sizes") > 1).join(widths, "space", "left").withColumn(
            "width", F.coalesce("width", F.lit(0))
        )
        found = svm.solve(blocks, spaces, grid, self.tolerance, self.max_iter)
        models = []
        for place, C in enumerate(grid):
            weights = found.where(F.col("c") == place).drop("c")
            own = durable(classes.select("space", "place", "label").join(weights, ["space", "place"], "left"))
            models.append(HierarchicalClassifier(
                self.min_class_count, C, self.max_iter, self.tolerance, terms.select("space", "term", "idx", "idf"), own,
                plan.select("category", "decision", "fallback_label"), self.broadcast_bytes, self.part_rows,
            ))
        return models

    def _classes(self, sizes: DataFrame, plan: DataFrame) -> DataFrame:
        """(space, place, label, n, category): the classes of all spaces, in the order of their labels."""
        top = sizes.groupBy("category").agg(F.sum("n").alias("n")).select(
            F.lit(TOP).alias("space"), F.col("category").alias("label"), "n", F.lit(None).cast("string").alias("category")
        )
        trained = plan.where("decision = 'train'").select("category")
        low = sizes.where((F.col("n") >= self.min_class_count) & F.col("query_type").isNotNull()).join(trained, "category").select(
            _within(F.col("category")).alias("space"), F.col("query_type").alias("label"), "n", "category"
        )
        place = F.row_number().over(Window.partitionBy("space").orderBy("label")) - 1
        return top.unionByName(low).select("space", place.cast("int").alias("place"), "label", "n", "category")

    def _packed(self, docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The terms of all spaces, and the rows as vectors of their spaces."""
        top = classes.where(F.col("space") == TOP).select(F.col("label").alias("category"), F.col("place").alias("top"))
        low = classes.where(F.col("space") != TOP).select("category", F.col("label").alias("query_type"), F.col("place").alias("low"))
        tagged = lookup(lookup(docs, top, ["category"], stored=True), low, ["category", "query_type"], stored=True)
        is_top = F.col("space") == TOP
        limits = classes.groupBy("space").agg(F.sum("n").alias("n_docs")).select(
            "space", "n_docs", F.when(is_top, TOP_TERMS).otherwise(TERMS).alias("max_features"),
            F.when(is_top, TOP_MIN_DF).otherwise(MIN_DF).alias("min_df"),
        )
        limits = durable(limits)
        stats = grams.group_terms(tagged.withColumn("kept", F.col("low").isNotNull()), limits, TOP, _within)
        terms = durable(ranked_terms(self._all_terms(tagged) if stats is None else stats, limits))
        packed = durable(packed_terms(terms))
        spaces = F.array(
            F.struct(F.lit(TOP).alias("space"), F.col("top").alias("place")),
            F.struct(_within(F.col("category")).alias("space"), F.col("low").alias("place")),
        )
        rows = tagged.withColumn("hashes", _hashes(F.col("text"), terms)).select(F.inline(spaces), "hashes").where("place IS NOT NULL")

        def prepare(found: list[dict]):
            return found[0] if found else None

        def run(model, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            flat, counts = _lists(batch.column("hashes"))
            own = [np.array(model[c] if model else [], k) for c, k in (("hashes", np.int64), ("idx", np.int64), ("idf", np.float64))]
            places = batch.column("place").to_numpy(zero_copy_only=False)
            yield from svm.packed_blocks(batch.column("space")[0].as_py(), places, weighted(flat, counts, *own))

        size = packed.select("space", (F.size("hashes") * 20).alias("bytes"))
        return terms, durable(routed(rows, packed, size, prepare, run, svm.BLOCKS, self.broadcast_bytes, self.part_rows))

    def _all_terms(self, tagged: DataFrame) -> DataFrame:
        """(space, term, cf, df) of all terms, a stored table."""
        counted = durable(
            tagged.select("category", F.col("low").isNotNull().alias("kept"), F.inline(term_counts(tfidf.text_terms(F.col("text")))))
            .groupBy("category", "kept", "term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
        )
        sums = [F.sum(c).alias(c) for c in ("cf", "df")]
        top_counts = durable(counted.groupBy("term").agg(*sums).where(F.col("df") >= TOP_MIN_DF))
        return top_counts.select(F.lit(TOP).alias("space"), "term", "cf", "df").unionByName(
            counted.where("kept").select(_within(F.col("category")).alias("space"), "term", "cf", "df")
        )

    def labels(self, category: str | None = None) -> list[str]:
        """The labels of a level in order: the categories, or a category's query types."""
        space = TOP if category is None else WITHIN + category
        return [r["label"] for r in self.classes.where(F.col("space") == space).orderBy("place").collect()]

    def _models(self) -> tuple[DataFrame, DataFrame]:
        """(the rows that make up each space, bytes of each space)."""
        terms = packed_terms(self.terms.withColumn("hash", F.xxhash64("term")))
        null = lambda kind: F.lit(None).cast(kind)
        classes = self.classes.select("space", "place", "label", "weights", "intercept")
        fallbacks = self.plan.where(F.col("fallback_label").isNotNull()).select(
            _within(F.col("category")).alias("space"), F.lit(-1).alias("place"), F.col("fallback_label").alias("label"),
            null("array<double>").alias("weights"), null("double").alias("intercept"),
        )
        rows = durable(
            classes.unionByName(fallbacks)
            .withColumns({"hashes": null("array<bigint>"), "idx": null("array<int>"), "idf": null("array<double>")})
            .unionByName(terms.withColumns({
                "place": null("int"), "label": null("string"), "weights": null("array<double>"), "intercept": null("double"),
            }))
        )
        held = F.coalesce(F.array_size("hashes"), F.lit(0)) * 20 + F.coalesce(F.array_size("weights"), F.lit(0)) * 8 + 100
        return rows, rows.groupBy("space").agg(F.sum(held).alias("bytes"))

    def predict(self, df: DataFrame, text: str = "question") -> DataFrame:
        """Add predicted category and query type with their confidences.

        Confidence is null where a fallback label answered.
        """
        models, sizes = self._models()
        rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), _hashes(F.col(text), self.terms).alias("hashes"))
        row = rows.schema["row"].dataType.simpleString()
        if (sizes.agg(F.sum("bytes")).first()[0] or 0) <= self.broadcast_bytes:
            found = _labelled_at_once(rows, models, f"row {row}, {PREDICTED}")
        else:
            found = self._labelled_by_routing(rows, models, sizes, row)
        return found.select("row.*", "pred_category", "pred_query_type", "category_confidence", "query_type_confidence")

    def _labelled_by_routing(self, rows: DataFrame, models: DataFrame, sizes: DataFrame, row: str) -> DataFrame:
        def top(level: Level, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            category, sure = level.decide(*_lists(batch.column("hashes")))
            columns = [batch.column("row"), batch.column("hashes"), pa.array(category, pa.string()), pa.array(sure, mask=np.isnan(sure))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "hashes", "pred_category", "category_confidence"])

        def low(level: Level, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            kind, sure = level.decide(*_lists(batch.column("hashes")))
            category = batch.column("pred_category").to_numpy(zero_copy_only=False)
            answers = _answers(category, np.zeros(len(sure)), kind, sure)
            answers[1] = batch.column("category_confidence")
            yield pa.RecordBatch.from_arrays([batch.column("row"), *answers], ["row", *(c.split()[0] for c in PREDICTED.split(", "))])

        is_top = F.col("space") == TOP
        how = (self.broadcast_bytes, self.part_rows, FEW_KEYS)
        first = routed(
            rows.withColumn("space", F.lit(TOP)), models.where(is_top), sizes.where(is_top), Level, top,
            f"row {row}, hashes array<bigint>, pred_category string, category_confidence double", *how,
        )
        first = durable(first).withColumn("space", _within(F.col("pred_category")))
        return routed(first, models.where(~is_top), sizes.where(~is_top), Level, low, f"row {row}, {PREDICTED}", *how)

    # -- S6: the model as tables -------------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as parquet tables: vocabularies, classes with their weights, plan, settings."""
        settings = spark.createDataFrame(
            [(self.min_class_count, float(self.C), self.max_iter, float(self.tolerance))],
            "min_class_count int, C double, max_iter int, tolerance double",
        )
        for name, table in {"terms": self.terms, "classes": self.classes, "plan": self.plan, "settings": settings}.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> HierarchicalClassifier:
        terms, classes, plan = (spark.read.parquet(f"{path}/{n}") for n in ("terms", "classes", "plan"))
        s = spark.read.parquet(f"{path}/settings").first()
        return HierarchicalClassifier(s["min_class_count"], s["C"], s["max_iter"], s["tolerance"], terms, classes, plan)


def _labelled_at_once(rows: DataFrame, models: DataFrame, schema: str) -> DataFrame:
    """Both levels in one pass, with all models in each task."""
    held: dict[str, list[dict]] = {}
    for r in models.collect():  # their size has been measured
        held.setdefault(r["space"], []).append(r.asDict())
    shared = rows.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Level] = {}

        def level(space: str) -> Level:
            if space not in made:
                made[space] = Level(shared.value.get(space, []))
            return made[space]

        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *_one_pass(batch, level)], ["row", *(c.split()[0] for c in PREDICTED.split(", "))]
            )

    return rows.mapInArrow(run, schema)


def evaluate_against_gold(
    model: HierarchicalClassifier, gold: DataFrame, text: str = "question", category: str = "category",
    query_type: str = "query_type",
) -> DataFrame:
    """Accuracy and macro-F1 of both levels, from one labelling of the rows."""
    pairs = F.array(
        F.struct(F.lit("category").alias("level"), F.col(category).alias("truth"), F.col("pred_category").alias("guess")),
        F.struct(F.lit("query_type").alias("level"), F.col(query_type).alias("truth"), F.col("pred_query_type").alias("guess")),
    )
    counts = durable(
        model.predict(gold.select(text, category, query_type), text).select(F.inline(pairs))
        .groupBy("level", F.col("truth").alias("true_label"), F.col("guess").alias("pred_label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parts = [
        summary(per_class(counts.where(F.col("level") == level).drop("level"))).select(
            F.lit(level).alias("level"), "n", "accuracy", "macro_f1"
        )
        for level in ("category", "query_type")
    ]
    return parts[0].unionByName(parts[1])


def tune_C(
    train: DataFrame, id_col: str, grid: Sequence[float] = (0.5, 1.0, 2.0, 4.0), text: str = "question",
    category: str = "category", query_type: str = "query_type", seed: int = 42, **settings,
) -> tuple[float, list[tuple[float, float]]]:
    """The C with the best query-type macro-F1 on a split of the training rows only."""
    from casewise.operators.sampling import stratified_split

    fit_part, check_part = stratified_split(train, category, id_col, seed=seed)
    results = []
    models = HierarchicalClassifier(**settings).fit_grid(fit_part, grid, text, category, query_type)
    for C, model in zip(grid, models):
        row = evaluate_against_gold(model, check_part, text, category, query_type).where("level = 'query_type'").first()
        results.append((C, row["macro_f1"]))
    return max(results, key=lambda r: (r[1], -r[0]))[0], results
