"""Merging near-duplicate labels by average-linkage clustering of their spelling.

Two clusters merge while their mean similarity is above a floor. A mean is never above its
largest part, so clusters of labels never leave the components of the graph that links
labels above the floor, and each component is clustered by itself. The links come from one
sparse similarity join: terms are put in rare-first order, a label is filed under its first
terms up to the point at which the rest of its vector is too short to reach the floor, and
two linked labels share one of these terms.

Components of up to ``TASK_LABELS`` labels are clustered inside tasks from their matrix of
similarities. In a larger one the mean similarity of two clusters is the inner product of
their mean vectors, so a cluster is one vector and no pair table is needed. Both ways take
rounds in which all pairs merge that are each other's nearest; average linkage is reducible,
so this gives the same clusters as merging the closest pair at a time. Similarities are
rounded to nine places before they are compared, and the lower name wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.functions.numeric import sparse_dot
from casewise.functions.text import char_ngrams, term_counts
from casewise.operators.joins import lookup, split_join
from casewise.operators.topk import DIGITS, top_k
from casewise.session import durable

DISTANCE = 0.3
#: Labels of a component that one task clusters.
TASK_LABELS = 2_000
#: Room for rounding where a bound is compared with the floor.
SLACK = 1e-8


def label_vectors(labels: DataFrame) -> DataFrame:
    """Unit TF-IDF vectors of the character n-grams of each ``label``.

    Terms are named by a 64-bit hash of the n-gram. ``prefix`` holds them in rare-first order.
    """
    grams = labels.select("label", F.inline(term_counts(char_ngrams(F.col("label")))))
    n_labels = labels.agg(F.count(F.lit(1))).scalar()
    seen = grams.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = split_join(grams, seen, ["term"], "inner").select(
        "label",
        F.xxhash64("term").alias("term"),
        "df",
        (F.col("tf") * (F.log((1 + n_labels) / (1 + F.col("df"))) + 1)).alias("w"),
    )
    return (
        weighted.groupBy("label")
        .agg(
            F.sort_array(F.collect_list(F.struct("term", "w"))).alias("v"),
            F.sort_array(F.collect_list(F.struct("df", "term", "w"))).alias("rare"),
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        )
        .select(
            "label",
            F.col("v.term").alias("indices"),
            F.transform("v.w", lambda x: x / F.col("norm")).alias("weights"),
            F.transform("rare", lambda x: F.struct(x.term.alias("term"), (x.w / F.col("norm")).alias("w"))).alias("rare"),
        )
    )


def candidate_pairs(vectors: DataFrame, min_similarity: float) -> DataFrame:
    """(a, b), a < b: labels that share a term of their prefixes, all that reach the similarity among them.

    What lies after the prefix has a length below the floor, and the other vector has length one.
    """
    start = F.struct(F.lit(0.0).alias("square"), F.array().cast("array<bigint>").alias("terms"))
    floor = max(0.0, min_similarity - SLACK)

    def longer(acc, x):  # from the most frequent term on: what is too long to be left out is filed
        square = acc.square + x.w * x.w
        terms = F.when(square < floor * floor, acc.terms).otherwise(F.concat(acc.terms, F.array(x.term)))
        return F.struct(square.alias("square"), terms.alias("terms"))

    filed = vectors.select("label", F.explode(F.aggregate(F.reverse("rare"), start, longer).terms).alias("term"))
    sizes = filed.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("term")
    shared = durable(split_join(filed, sizes, ["term"], "inner"))
    left, right = (shared.select("term", F.col("label").alias(side)) for side in ("a", "b"))
    return split_join(left, right, ["term"], "inner").where("a < b").select("a", "b").distinct()


def similar_pairs(vectors: DataFrame, min_similarity: float) -> DataFrame:
    """M5: (a, b, similarity), a < b: the labels above the similarity; the distance is 1 - similarity."""
    side = lambda name: vectors.select(F.col("label").alias(name), F.col("indices").alias(f"{name}_i"), F.col("weights").alias(f"{name}_w"))
    both = candidate_pairs(vectors, min_similarity).join(side("a"), "a").join(side("b"), "b")
    cosine = sparse_dot(F.col("a_i"), F.col("a_w"), F.col("b_i"), F.col("b_w"))
    return both.select("a", "b", cosine.alias("similarity")).where(F.col("similarity") > min_similarity - SLACK)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(label, component): the lowest label that links lead to.

    Labels take the lowest one around them, then the one that this one has, until none changes.
    """
    around = durable(links.select("a", "b").union(links.select("b", "a")))
    found = durable(nodes.select("label", F.col("label").alias("component")))
    while True:
        named = found.select(F.col("label").alias("b"), "component")
        low = split_join(around, named, ["b"], "inner").groupBy(F.col("a").alias("label")).agg(F.min("component").alias("low"))
        stepped = found.join(low, "label", "left").select("label", "component", F.least("component", F.coalesce("low", "component")).alias("next"))
        jump = found.select(F.col("label").alias("next"), F.col("component").alias("far"))
        moved = durable(split_join(stepped, jump, ["next"], "inner").select("label", "component", F.least("next", "far").alias("next")))
        if moved.where("next != component").isEmpty():
            return moved.select("label", "component")
        found = moved.select("label", F.col("next").alias("component"))


def _linked(labels: np.ndarray, similar: np.ndarray, min_similarity: float) -> np.ndarray:
    """The cluster (its lowest label) of each label, from the matrix of similarities; labels are in order."""
    clusters, sums, sizes = np.arange(len(labels)), similar.copy(), np.ones(len(labels))
    owner = np.arange(len(labels))
    while len(clusters) > 1:
        means = np.round(sums / np.outer(sizes, sizes), DIGITS)
        np.fill_diagonal(means, -np.inf)
        near = means.argmax(1)  # the lowest of equal ones
        fits = means[np.arange(len(clusters)), near] > min_similarity
        mutual = fits & fits[near] & (near[near] == np.arange(len(clusters))) & (near > np.arange(len(clusters)))
        into = np.flatnonzero(mutual)
        if not len(into):
            break
        gone = near[into]
        sums[into] += sums[gone]
        sums[:, into] += sums[:, gone]
        sizes[into] += sizes[gone]
        renamed = dict(zip(clusters[gone].tolist(), clusters[into].tolist()))
        owner = np.array([renamed.get(c, c) for c in owner.tolist()])
        kept = np.setdiff1d(np.arange(len(clusters)), gone)
        clusters, sums, sizes = clusters[kept], sums[np.ix_(kept, kept)], sizes[kept]
    return labels[owner]


def _cluster_in_task(min_similarity: float):
    def run(table: pa.Table) -> pa.Table:
        labels = np.array(table.column("label").to_pylist(), object)
        # as the shuffled way orders them, by their bytes
        order = np.array(sorted(range(len(labels)), key=lambda i: labels[i].encode()))
        terms = [table.column("indices")[int(i)].as_py() for i in order]
        flat, place = np.unique(np.concatenate([np.array(t, np.int64) for t in terms]), return_inverse=True)
        rows = np.repeat(np.arange(len(order)), [len(t) for t in terms])
        dense = np.zeros((len(order), len(flat)))
        dense[rows, place] = np.concatenate([table.column("weights")[int(i)].as_py() for i in order])
        found = _linked(labels[order], dense @ dense.T, min_similarity)
        return pa.table({"label": pa.array(labels[order], pa.string()), "cluster": pa.array(found, pa.string())})

    return run


def _mutual_pairs(clusters: DataFrame, min_similarity: float) -> DataFrame:
    """(cluster, absorbed): clusters that are each other's nearest above the similarity."""
    means = clusters.select(
        F.col("cluster").alias("id"), "indices", F.transform("weights", lambda x: x / F.col("size")).alias("weights")
    )
    nearest = top_k(means, means, 1, skip_self=True).where(F.col("similarity") > min_similarity)
    pairs = nearest.select(
        F.least("query_id", "id").alias("cluster"), F.greatest("query_id", "id").alias("absorbed")
    )
    return pairs.groupBy("cluster", "absorbed").agg(F.count(F.lit(1)).alias("n")).where("n = 2").drop("n")


def _merge(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add the vectors of the absorbed clusters to their new cluster."""
    named = clusters.join(pairs.withColumnsRenamed({"cluster": "into", "absorbed": "cluster"}), "cluster", "left").select(
        F.coalesce("into", "cluster").alias("cluster"), "size", "indices", "weights"
    )
    sizes = named.groupBy("cluster").agg(F.sum("size").alias("size"))
    summed = (
        named.select("cluster", F.inline(F.arrays_zip("indices", "weights")))
        .groupBy("cluster", "indices")
        .agg(F.sum("weights").alias("w"))
        .groupBy("cluster")
        .agg(F.sort_array(F.collect_list(F.struct("indices", "w"))).alias("v"))
    )
    return sizes.join(summed, "cluster").select(
        "cluster", "size", F.col("v.indices").alias("indices"), F.col("v.w").alias("weights")
    )


def _cluster_in_rounds(vectors: DataFrame, min_similarity: float) -> DataFrame:
    """(label, cluster) of components that are too large for a task."""
    clusters = durable(vectors.select(F.col("label").alias("cluster"), F.lit(1).cast("long").alias("size"), "indices", "weights"))
    members = vectors.select("label", F.col("label").alias("cluster"))
    while True:
        pairs = durable(_mutual_pairs(clusters, min_similarity))
        if pairs.isEmpty():
            return members
        clusters = durable(_merge(clusters, pairs))
        renamed = pairs.withColumnsRenamed({"cluster": "into", "absorbed": "cluster"})
        members = durable(
            members.join(renamed, "cluster", "left").select("label", F.coalesce("into", "cluster").alias("cluster"))
        )


def cluster_labels(labels: DataFrame, distance_threshold: float = DISTANCE, task_labels: int = TASK_LABELS) -> DataFrame:
    """X11: (label, cluster) for a table of distinct labels.

    Two clusters merge while their mean distance is below the threshold; at it they do not.
    """
    floor = 1 - distance_threshold
    vectors = durable(label_vectors(labels))
    pairs = durable(similar_pairs(vectors, floor))
    linked = pairs.select(F.explode(F.array("a", "b")).alias("label")).distinct()
    parts = durable(components(linked, pairs))
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    placed = durable(lookup(parts, sizes, ["component"], "inner"))
    in_tasks = placed.where(F.col("n") <= task_labels).join(vectors, "label").select("component", "label", "indices", "weights")
    found = in_tasks.groupBy("component").applyInArrow(_cluster_in_task(floor), "label string, cluster string")
    large = durable(placed.where(F.col("n") > task_labels).join(vectors, "label").select("label", "indices", "weights"))
    if not large.isEmpty():
        found = found.unionByName(_cluster_in_rounds(large, floor))
    return labels.select("label").join(found, "label", "left").select("label", F.coalesce("cluster", "label").alias("cluster"))


def label_map(df: DataFrame, column: str, distance_threshold: float = DISTANCE) -> DataFrame:
    """(raw_label, canonical): the most frequent label of its cluster, ties by name."""
    counts = durable(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    members = durable(cluster_labels(counts.select("label"), distance_threshold).join(counts, "label"))
    chosen = members.groupBy("cluster").agg(
        F.min_by("label", F.struct((-F.col("n")).alias("rarity"), F.col("label"))).alias("canonical")
    )
    return members.join(chosen, "cluster").select(F.col("label").alias("raw_label"), "canonical")


def merge_near_duplicate_labels(
    df: DataFrame, column: str = "query_type", distance_threshold: float = DISTANCE
) -> DataFrame:
    """X11, JN7: replace each label by its canonical one and keep the old one as ``*_raw``."""
    names = label_map(df, column, distance_threshold).withColumnRenamed("raw_label", f"{column}_raw")
    kept = df.withColumnRenamed(column, f"{column}_raw")
    joined = lookup(kept, names, [f"{column}_raw"])
    order = [F.col("canonical").alias(c) if c == column else F.col(c) for c in df.columns]
    return joined.select(*order, f"{column}_raw")
