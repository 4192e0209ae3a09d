import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casewise.operators import labels

NAMES = [
    "Plant Protection", "Plant  Protection", "plant protection", "Plant Protections", "Nutrient Management",
    "Nutrient Managment", "Weather", "Weather Report", "Weather Reports", "Market Information", "a", "b",
]


def grams(label):
    out = Counter()
    for word in label.lower().split():
        padded = f" {word} "
        for n in (2, 3, 4):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def linkage(names, threshold):
    """Average linkage, closest pair first, over the full distance matrix."""
    counts = {n: grams(n) for n in names}
    df = Counter(g for c in counts.values() for g in c)
    vectors = {}
    for n, c in counts.items():
        w = {g: k * (math.log((1 + len(names)) / (1 + df[g])) + 1) for g, k in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vectors[n] = {g: x / norm for g, x in w.items()}

    def distance(a, b):
        return max(0.0, 1 - sum(x * vectors[b].get(g, 0) for g, x in vectors[a].items()))

    clusters = [[n] for n in names]
    while len(clusters) > 1:
        d, i, j = min(
            (sum(distance(a, b) for a in clusters[i] for b in clusters[j]) / (len(clusters[i]) * len(clusters[j])), i, j)
            for i in range(len(clusters)) for j in range(i)
        )
        if d >= threshold:
            break
        clusters[j] += clusters.pop(i)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6, 0.9])
def test_X11_equals_sequential_average_linkage(spark, threshold):
    table = spark.createDataFrame([(n,) for n in NAMES], "label string")
    groups = {}
    for r in labels.cluster_labels(table, threshold).collect():
        groups.setdefault(r["cluster"], set()).add(r["label"])
    assert {frozenset(g) for g in groups.values()} == linkage(NAMES, threshold)


def test_W8_most_frequent_label_wins_ties_by_name(spark):
    data = ["Weather Reports"] * 3 + ["Weather Report"] * 3 + ["Nutrient Managment"] * 5 + ["Nutrient Management"] * 2 + [None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(data)], "id int, query_type string")
    merged = labels.merge_near_duplicate_labels(df, "query_type", 0.5)
    found = {r["query_type_raw"]: r["query_type"] for r in merged.collect()}
    assert found["Weather Reports"] == "Weather Report"
    assert found["Nutrient Management"] == "Nutrient Managment"
    assert found[None] is None and merged.count() == len(data)


def test_X11_one_label_maps_to_itself(spark):
    df = spark.createDataFrame([("only",)], "query_type string")
    assert [tuple(r) for r in labels.label_map(df, "query_type").collect()] == [("only", "only")]


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_X11_components_too_large_for_a_task_give_the_same_clusters(spark, threshold):
    table = spark.createDataFrame([(n,) for n in NAMES], "label string")
    for most in (1, 2, 3):
        groups = {}
        for r in labels.cluster_labels(table, threshold, most).collect():
            groups.setdefault(r["cluster"], set()).add(r["label"])
        assert {frozenset(g) for g in groups.values()} == linkage(NAMES, threshold)


@pytest.mark.parametrize("floor", [0.05, 0.4, 0.7])
def test_M5_similar_pairs_equal_all_pairs(spark, floor):
    """The prefixes of two similar labels share a term, whatever the floor."""
    names = sorted({f"{a} {b}{k}" for a in ("rust", "rusty", "seed", "market") for b in ("leaf", "leaves", "price") for k in ("", "s", " x")})
    counts = {n: grams(n) for n in names}
    df = Counter(g for c in counts.values() for g in c)
    vectors = {}
    for n, c in counts.items():
        w = {g: k * (math.log((1 + len(names)) / (1 + df[g])) + 1) for g, k in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vectors[n] = {g: x / norm for g, x in w.items()}
    expected = {}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            s = sum(x * vectors[b].get(g, 0) for g, x in vectors[a].items())
            if s > floor:
                expected[a, b] = s
    found = labels.similar_pairs(labels.label_vectors(spark.createDataFrame([(n,) for n in names], "label string")), floor).collect()
    assert {(r["a"], r["b"]): r["similarity"] for r in found} == pytest.approx(expected)


def test_JN11_candidates_grow_with_the_labels(spark):
    """100,000 made labels in groups of five: about as many candidates for each label as for a tenth of them."""
    def per_label(n):
        # words over 10,000 letters, so that the n-grams are as many as the labels ask for
        letters = "".join(chr(0x4E00 + i) for i in range(10_000))
        word = lambda c: F.concat(*(
            F.substring(F.lit(letters), F.pmod(F.xxhash64(c, F.lit(k)), F.lit(10_000)).cast("int") + 1, 1) for k in range(6)
        ))
        group = F.floor(F.col("id") / 5)
        made = spark.range(n).select(F.concat_ws(" ", word(group), word(group + 10_000_000), F.substring(word(F.col("id") + 7), 1, 2)).alias("label"))
        return labels.candidate_pairs(labels.label_vectors(made), 0.7).count() / n

    small, large = per_label(10_000), per_label(100_000)
    assert 2 <= small and large < 3 * small and large < 40


def test_components_of_a_long_chain(spark):
    names = [f"n{i:03d}" for i in range(200)]
    nodes = spark.createDataFrame([(n,) for n in [*names, "z1", "z2"]], "label string")
    edges = spark.createDataFrame([*zip(names[1:], names), ("z1", "z2")], "a string, b string")
    found = {r["label"]: r["component"] for r in labels.components(nodes, edges).collect()}
    assert found == {**{n: "n000" for n in names}, "z1": "z1", "z2": "z1"}
