"""Hard negatives against a plain search in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.llm import negatives, queries
from checks.compare import connect, difference

SCHEMA = "id bigint, label bigint, vector array<bigint>, score int, number string, cell int"


def plain(rows, asks, positives=5, most=3, band=(50, 95)):
    """rows: (id, label, vector). One list of (anchor, positive, rank, negative, scores), sorted."""
    dim = max((len(v) for _, _, v in rows if v is not None), default=0)
    rows = [(i, y, (v + [0] * dim)[:dim]) for i, y, v in rows if y is not None and v is not None and None not in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda p: (-p[0], p[1] is None, p[1])
    out = []
    for i, label, v in rows:
        if i is None or not asks(i):
            continue
        good = sorted(((dot(v, w), j) for j, y, w in rows if y == label and j != i), key=order)[:positives]
        bad = sorted(((dot(v, w), j) for j, y, w in rows if y != label), key=order)
        for p, j in good:
            fit = [(n, k) for n, k in bad if band[0] * p <= 100 * n <= band[1] * p][:most]
            out += [(i, j, r, k, p, n) for r, (n, k) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def rows_of(n, dim, labels, spread, seed=1):
    draw = random.Random(seed)
    centres = [[draw.randint(-40, 40) for _ in range(dim)] for _ in range(labels)]
    return [(i, i % labels, [c + draw.randint(-spread, spread) for c in centres[draw.randrange(labels)]]) for i in range(n)]


def mined(spark, rows, asks="id % 5 = 0", parts=7, **more):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, negatives.hard_negatives(frame, F.expr(asks), **more).collect()), key=repr)


@pytest.mark.parametrize("dim", [1, 3, 64, 70])
def test_equal_to_plain_search(spark, dim):
    rows = rows_of(300, dim, 4, 30)
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_nulls_ties_repeated_rows_and_groups_of_anchors(spark):
    rows = rows_of(120, 5, 3, 2)
    rows += [(200, None, [1] * 5), (205, 1, None), (210, 1, [1, None, 2, 3, 4]), (None, 1, [9, 8, 7, 6, 5]), (None, 2, [9, 8, 7, 6, 5])]
    rows += [(215, 1, [3]), (220, 2, []), (225, 7, [5, 5, 5, 5, 5]), rows[7], rows[7], rows[10], (11, 2, rows[10][2]), (-5, 0, [0] * 5)]
    rows += [(300 + i, i % 3, [4, 4, 4, 4, 4]) for i in range(150)]  # one vector many times
    got = mined(spark, rows, cell_anchors=9)
    assert got == plain(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows, positives=2, negatives=4, band=(10, 100)) == plain(rows, lambda i: i % 5 == 0, 2, 4, (10, 100))


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1, 2]), (2, 1, [1, 2])], "false") == []
    assert mined(spark, [(5, 1, [1, 2])]) == []


def test_scores_beyond_56_bits_end_in_an_error(spark):
    with pytest.raises(Exception, match="56 bits"):
        mined(spark, [(5, 1, [1 << 40, 1]), (6, 1, [1 << 40, 2]), (7, 2, [1, 1])])
    big = 1 << 25
    rows = [(i, i % 2, [big + i, -big, big - 3 * i]) for i in range(20)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def clustered(n, dim=64, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    return np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)


def test_intervals_hold_and_filter():
    """Every score lies in its interval, and most rows are never scored."""
    ints = clustered(12_000)
    a = negatives.Anchors(np.arange(40), np.arange(40), np.arange(40) % 3, ints[:40])
    codes, alignment, lengths = negatives.coded(ints)
    low, high = a.interval(slice(0, 40), codes, alignment, lengths)
    exact = ints[:40] @ ints.T
    assert (low <= exact).all() and (exact <= high).all()
    assert np.mean(high - low) < 0.35 * np.ptp(exact)
    labels = np.arange(12_000) % 3
    order = np.argsort(labels[:40], kind="stable")
    sorted_ = negatives.Anchors(np.arange(40)[order], np.arange(40)[order], labels[:40][order], ints[:40][order])
    search = negatives.Positives(sorted_, 5)
    for at in range(0, 12_000, 1000):
        own = slice(at, at + 1000)
        search.meet({
            "ids": np.arange(12_000)[own], "lost": np.zeros(1000, bool), "labels": labels[own], "ints": ints[own], "codes": codes[own],
            "alignment": alignment[own], "lengths": lengths[own],
        })
    assert search.scored < 0.15 * search.seen
    for slot, number in enumerate(sorted_.number):
        own = [(-exact[number, j], j) for j in range(12_000) if j % 3 == number % 3 and j != number]
        assert search.best.id[slot].tolist() == [j for _, j in sorted(own)[:5]]


def test_alignment_and_rests():
    ints = clustered(50, 100)
    codes, alignment, lengths = negatives.coded(ints)
    turned = negatives._rotated(ints)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(ints, axis=1))
    rest = turned.copy()
    for k in range(negatives.CODES):
        signs = np.unpackbits(codes[:, k].copy().view(np.uint8), axis=1, bitorder="little").astype(float) * 2 - 1
        unit = signs / math.sqrt(signs.shape[1])
        assert np.allclose((rest * unit).sum(1), alignment[:, k])
        rest -= alignment[:, k, None] * unit
    assert np.allclose(np.linalg.norm(rest, axis=1), lengths[:, 1])
    assert (lengths[:, 1] < 0.3 * np.linalg.norm(ints, axis=1)).all()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, sf):
    found = queries.op11_hard_negatives(spark, sf).toPandas()
    assert difference(found, connect(sf).execute(queries.SQL_OP11).df()) is None
