"""The inverted index against the search that scores every row."""

import random

import pyarrow as pa
import pytest

from casewise.operators import inverted
from casewise.operators.topk import top_k

SCHEMA = "id int, indices array<int>, weights array<double>"


def vectors(n, draw, terms, popular=0.5):
    """Unit vectors: a few popular terms that half of the rows have, and rare ones."""
    out = []
    for i in range(n):
        own = {t for t in range(5) if draw.random() < popular} | {draw.randrange(5, terms) for _ in range(draw.randint(0, 4))}
        weights = [round(draw.choice([0.1, 0.5, 1.0, draw.random()]), 3) + 0.01 for _ in own]
        length = sum(w * w for w in weights) ** 0.5
        out.append((i, sorted(own), [w / length for w in weights]))
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
def test_same_rows_as_scoring_all(spark, rows, tmp_path, k):
    draw = random.Random(k)
    corpus = vectors(600, draw, 60)
    corpus += [(1000 + i, *corpus[i][1:]) for i in range(0, 200, 2)]  # ties
    corpus += [(2000, [], [])]
    asked = vectors(40, draw, 80) + [(900, [], []), (901, [77], [1.0]), (902, [0], [1.0])]
    frames = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (corpus, asked)]
    index = inverted.build(frames[0], str(tmp_path / "index"), block=8)
    assert rows(index.top_k(frames[1], k)) == rows(top_k(*frames, k))
    assert 0 < index.n_read and index.n_postings() == sum(len(i) for _, i, _ in corpus)


def test_rare_terms_read_a_small_part(spark, rows, tmp_path):
    """A query of a rare and two popular terms reads the tops of the popular lists only."""
    draw = random.Random(9)
    corpus = []
    for i in range(6000):
        own = {0: draw.uniform(0.05, 0.4), 1: draw.uniform(0.05, 0.4), 10 + i % 200: 1.0}
        length = sum(w * w for w in own.values()) ** 0.5
        corpus.append((i, sorted(own), [own[t] / length for t in sorted(own)]))
    asked = [(q, [0, 1, 10 + q], [0.2, 0.2, 0.96]) for q in range(20)]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (corpus, asked)]
    index = inverted.build(frames[0], str(tmp_path / "index"), block=16)
    assert rows(index.top_k(frames[1], 3)) == rows(top_k(*frames, 3))
    lists = sum(1 for _, i, _ in corpus for t in i if t in (0, 1)) * 20 + 20 * 30  # postings of the queries' lists
    assert index.n_read < 0.2 * lists


def test_no_rows_or_no_common_term(spark, tmp_path):
    corpus = spark.createDataFrame([(1, [1, 2], [0.6, 0.8])], SCHEMA)
    index = inverted.build(corpus, str(tmp_path / "index"))
    assert index.top_k(spark.createDataFrame([(7, [5], [1.0])], SCHEMA), 2).collect() == []
    assert index.top_k(spark.createDataFrame([], SCHEMA), 2).collect() == []
    empty = inverted.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert empty.top_k(corpus, 2).collect() == []


def test_repeated_ids_are_rows_of_their_own(spark, rows, tmp_path):
    """Rows of one id do not add up to a bound that none of them has; rows without an id are no match."""
    corpus = [(1, [0], [0.5]), (1, [0], [0.5]), (2, [0], [0.9]), (3, [0], [0.8]), (None, [0], [1.0])]
    frames = [spark.createDataFrame(x, SCHEMA).coalesce(1) for x in (corpus, [(7, [0], [1.0])])]
    found = inverted.build(frames[0], str(tmp_path / "index")).top_k(frames[1], 2)
    assert rows(found) == rows(top_k(frames[0].where("id IS NOT NULL"), frames[1], 2))
    assert sorted(r["id"] for r in found.collect()) == [2, 3]


def test_shards_hold_each_row_once(monkeypatch):
    monkeypatch.setattr(inverted, "SHARD_TERMS", 50)
    draw = random.Random(3)
    corpus = vectors(200, draw, 40) + [(500, list(range(120)), [0.1] * 120)]
    names = ("id", "indices", "weights")
    batches = pa.table({n: [row[i] for row in corpus] for i, n in enumerate(names)}).to_batches(max_chunksize=33)
    shards = [s.to_pylist()[0] for s in inverted._sharded(iter(batches))]
    assert [i for s in shards for i in s["ids"]] == [row[0] for row in corpus if row[1]]
    assert all(len(s["terms"]) <= 50 or len(s["ids"]) == 1 for s in shards) and len(shards) > 5
    for s in shards:
        lists = [(s["terms"][at], -s["weights"][at]) for at in s["lists"]]
        assert lists == sorted(lists) and sorted(s["lists"]) == list(range(len(lists)))


def test_nothing_but_the_best_rows_is_shuffled(spark, rows, tmp_path, monkeypatch):
    """Queries beyond those that travel at once are asked in blocks; no list is shuffled for any of them."""
    draw = random.Random(5)
    frames = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (vectors(300, draw, 60), vectors(40, draw, 60))]
    index = inverted.build(frames[0], str(tmp_path / "index"), block=8)
    assert "Exchange" not in index._best(frames[1], 3)._jdf.queryExecution().executedPlan().toString()
    once = rows(index.top_k(frames[1], 3))
    monkeypatch.setattr(inverted, "MAX_QUERIES", 7)
    assert rows(index.top_k(frames[1], 3)) == once == rows(top_k(*frames, 3))
