"""Dense search in blocks around pivots against the search that scores every row."""

import numpy as np
import pyarrow as pa
import pytest

from casewise.operators import pivots, topk
from casewise.operators.topk import top_k

SCHEMA = "id int, values array<double>"


def frame(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, x.tolist()) for i, x in enumerate(matrix)], SCHEMA).repartition(4)


def clustered(n, centres, dim=16, seed=1, width=0.05):
    rng = np.random.default_rng(seed)
    around = rng.standard_normal((centres, dim))
    return around[np.arange(n) % centres] + width * rng.standard_normal((n, dim))


@pytest.mark.parametrize("unit", [True, False])
@pytest.mark.parametrize("k", [1, 4])
def test_same_rows_as_scoring_all(spark, rows, tmp_path, unit, k):
    x = np.concatenate([clustered(700, 9, width=0.5), np.zeros((2, 16)), np.ones((30, 16))])
    if unit:
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    asked = np.concatenate([x[:50], 3 * clustered(20, 4, seed=2), np.zeros((1, 16))])
    corpus, queries = frame(spark, x), frame(spark, asked, 5000)
    index = pivots.build(corpus, str(tmp_path / "index"), n_pivots=20, block=16)
    expected = rows(top_k(corpus, queries, k, dense=True))
    assert rows(index.top_k(queries, k)) == expected
    assert rows(index.top_k(queries, k, most=9)) == expected  # slices of the queries


def test_most_blocks_of_clustered_vectors_are_skipped(spark, rows, tmp_path):
    x = clustered(6000, 60)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    corpus, queries = frame(spark, x), frame(spark, x[:100], 10_000)
    index = pivots.build(corpus, str(tmp_path / "index"), n_pivots=60, block=50)
    assert rows(index.top_k(queries, 5)) == rows(top_k(corpus, queries, 5, dense=True))
    assert index.n_scored(queries, 5) < 0.2 * index.n_blocks() * 100


def test_empty_corpus_null_vectors_and_few_rows(spark, rows, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], SCHEMA)
    assert pivots.build(empty, str(tmp_path / "a")).top_k(asked, 2).collect() == []
    index = pivots.build(spark.createDataFrame([(7, [0.0, 2.0]), (8, None), (9, [-1.0, 5.0])], SCHEMA), str(tmp_path / "b"))
    assert rows(index.top_k(asked, 3)) == [(1, 7, 0.0, 1), (1, 9, -1.0, 2)]
    assert index.top_k(empty, 3).collect() == []


def test_few_cells_become_rows(spark, rows, monkeypatch):
    rng = np.random.default_rng(5)
    corpus, queries = rng.integers(-3, 4, (1500, 4)) / 4.0, rng.integers(-3, 4, (60, 4)) / 4.0
    corpus[7, 2] = np.nan
    tables = [pa.table({"id": np.arange(len(m)), "values": list(m)}) for m in (corpus, queries)]
    held = []

    def best(found, k):
        held.append(len(found))
        return plain_best(found, k)

    plain_best = topk._best
    monkeypatch.setattr(topk, "_best", best)
    monkeypatch.setattr(topk, "WORK", 60 * 100)  # slices of 100 rows
    for skip_self in (False, True):
        held.clear()
        found = topk._k_best(topk.DenseBlock(tables[1]), [tables[0]], 5, skip_self)
        for q in range(60):
            sims = np.round(corpus @ queries[q], topk.DIGITS)
            order = [int(i) for i in np.lexsort((np.arange(1500), -sims)) if not np.isnan(sims[i]) and not (skip_self and i == q)][:5]
            own = found[found["query_id"] == q]
            assert own["id"].tolist() == order and own["similarity"].tolist() == sims[order].tolist()
        if not skip_self:
            assert max(held) < 60 * 100 / 2  # not all cells of the first slice
