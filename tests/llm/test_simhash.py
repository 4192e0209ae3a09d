"""SimHash near duplicates against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casewise.llm import queries, simhash
from tests.llm.test_operators import docs, nothing, plain_words  # noqa: F401


def plain_fingerprint(text, n=3):
    words = plain_words(text)
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    """Smallest place of each component."""
    own, x = list(range(len(fps))), np.array(fps, np.uint64)
    while True:
        new = [min(own[j] for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= radius)) for i in range(len(fps))]
        if new == own:
            return own
        own = new


def test_near_duplicates_equal_brute_force(docs, nothing):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    least = {}
    for (i, _), root in zip(rows, roots):
        least[root] = min(i, least.get(root, i))
    expected = sorted((i, f"{fp:016x}", least[root]) for (i, _), fp, root in zip(rows, fps, roots))
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == expected
    assert simhash.near_duplicates(nothing).collect() == []


def test_null_ids_are_passed_over(spark):
    rows = [(None, "only null ids here now"), (None, "Only NULL ids here now"), (None, "a b c d"), (4, "a  b c\td"), (None, None), (9, " ")]
    got = simhash.near_duplicates(spark.createDataFrame(rows * 50, "doc_id bigint, text string"))
    zero = "0" * 16
    same = lambda t: f"{plain_fingerprint(t):016x}"
    expected = [
        (None, same("only null ids here now"), None), (None, same("only null ids here now"), None), (None, same("a b c d"), 4),
        (4, same("a b c d"), 4), (None, zero, 9), (9, zero, 9),
    ]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected * 50))


def cloud(draw, centre, n, most):
    return [centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("crowded_at", [1024, 3, -1])
@pytest.mark.parametrize("radius", [3, 2, 0])
def test_links_connect_all_components_at_every_level(spark, crowded_at, radius):
    """Clouds of fingerprints, and a half that hundreds share; with few rows in a cell the deeper levels take over."""
    draw = random.Random(5)
    fps = [draw.getrandbits(64) for _ in range(300)]
    for centre in fps[:6]:
        fps += cloud(draw, centre, 60, 5)
    fps += [fps[0] & ~0xFFFFFFFF | draw.getrandbits(32) for _ in range(200)] + cloud(draw, fps[0] & ~0xFFFFFFFF | 0xFFFF, 100, 6)
    fps = sorted({*fps, 0, 2**64 - 1, 7})
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    found = simhash.links(spark.createDataFrame(signed, "fp bigint").repartition(4), radius, crowded_at=crowded_at).collect()
    mask = 2**64 - 1
    place = {x: i for i, x in enumerate(fps)}
    own = list(range(len(fps)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for a, b in found:
        assert a != b
        i, j = sorted((root(place[a & mask]), root(place[b & mask])))
        own[j] = i
    assert [root(i) for i in range(len(fps))] == plain_components(fps, radius)


def test_crowded_keys_are_dealt_by_more_bits():
    """A key that holds thousands of fingerprints is left by all of them, and the last level's keys hold few."""
    rng = np.random.default_rng(1)
    fps = np.unique((np.uint64(77) << np.uint64(32)) | rng.integers(0, 1 << 32, 5000, np.uint64))
    high = next(p for p in simhash._paths(0) if p[0][0] == 32)
    full = np.zeros(simhash.CELLS, bool)
    full[simhash._cell(simhash._keys(fps, high))] = True
    assert full.sum() == 1
    for path in simhash._paths(1):
        filed = simhash._filed(fps, path, [full])
        assert len(filed) == (5000 if path[0] == high[0] else 0)
        if len(filed):
            assert np.unique(simhash._keys(filed, path), return_counts=True)[1].max() < 10


def test_forest_keeps_components():
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    a, b = (np.array(c, np.uint64) for c in zip(*edges))
    low, high = simhash.forest(a, b)
    parent = dict(zip(low.tolist(), high.tolist()))
    assert len(parent) == len(low)
    own = {x: parent.get(x, x) for x in range(300)}
    todo = {x: x for x in range(300)}
    for _ in range(300):
        for x, y in edges:
            todo[x] = todo[y] = min(todo[x], todo[y])
    for x, y in zip(range(300), range(1, 300)):
        assert (own[x] == own[y]) == (todo[x] == todo[y])
    for x, y in edges:
        assert own[x] == own[y]


def test_query_runs_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op12_simhash(spark, sf).collect()}
    assert len(got) == len(rows)
    assert all(got[i].fingerprint == f"{plain_fingerprint(t):016x}" for i, t in rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    roots, least = plain_components(fps), {}
    for (i, _), root in zip(rows, roots):
        least[root] = min(i, least.get(root, i))
    assert [got[i].component_id for i, _ in rows] == [least[r] for r in roots]
    assert re.fullmatch("[0-9a-f]{16}", got[rows[0][0]].fingerprint)
    assert queries.op12_simhash(spark, sf).select(F.count(F.lit(1))).first()[0] == len(rows)
