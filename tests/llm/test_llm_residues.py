"""Residue products and hard-negative mining against plain arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchtrace.llm import residue_mining as M


@pytest.mark.parametrize("width, top", [(1, 3), (64, 300), (64, 2_000_000), (700, 5000), (5000, 40)])
def test_products_are_exact(width, top):
    rng = np.random.default_rng(width + top)
    a, b = rng.integers(-top, top + 1, (9, width)), rng.integers(-top, top + 1, (13, width))
    a[0], b[0], a[1] = top, top, -top
    moduli = M.choose_moduli(width, width * top * top)
    assert len(set(moduli)) == len(moduli) and all(width * (p // 2) ** 2 <= 1 << 24 for p in moduli)
    got = M.exact_products(M.residues(a, moduli), M.residues(b, moduli), moduli)
    assert got.tolist() == (a.astype(object) @ b.T.astype(object)).tolist()


def test_scores_beyond_the_system_are_an_error():
    with pytest.raises(ValueError):
        M.choose_moduli(64, 1 << 62)


def plain(rows, every=4, n_pos=5, n_neg=10):
    kept = [(i, y, [math.floor(256 * c) for c in v]) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, y, v in kept:
        if a % every:
            continue
        score = [(sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in kept]
        ranked = sorted(score, key=lambda t: (-t[0], t[1]))
        for s, p, _ in [t for t in ranked if t[2] == y and t[1] != a][:n_pos]:
            fit = [t for t in ranked if t[2] != y and 30 * s <= 100 * t[0] <= 90 * s][:n_neg]
            out += [(a, p, k, n, s, t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed, n=160, width=8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.choice([-1, 1]) * round(rng.random(), 2) if rng.random() < .9 else 0.5 for _ in range(width)]
        rows.append((i, v, rng.randrange(3)))
    common = [0.5] * width
    rows += [(n + j, common, j % 2) for j in range(40)]  # one vector many times, ties by id
    rows += [(n + 50, None, 1), (n + 51, common, None), (n + 52, [None] * width, 1), (n + 53, [math.nan] * width, 1),
             (n + 54, [math.inf] + common[1:], 1), (None, common, 1), (n + 55, [], 2), (n + 56, common[:3], 2), (n + 57, [0.25], 0)]
    return rows + [rows[8], rows[9], (9, rows[3][1], 1)]  # repeated rows and ids


@pytest.mark.parametrize("seed, blocks", [(1, (4096, 1024)), (2, (7, 13))])
def test_mining_equals_plain_arithmetic(spark, seed, blocks):
    rows = vectors(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
        .withColumns({"score": F.lit("extra"), "list": F.lit("x"), "rank": F.lit(1), "parts": F.lit("y")}).repartition(5)
    got = M.mine(M.prepare(df), anchor_every=4, block_anchors=blocks[0], slice_rows=blocks[1])
    assert sorted(map(tuple, got.collect())) == plain([(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v], y)
                                                       for i, v, y in rows])


def test_empty_and_useless_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(100, None, 1)], [(100, [1.0], 1)], [(100, [], 1), (1, [], 1), (2, [], 2)]):
        got = M.mine(M.prepare(spark.createDataFrame(rows, kind)))
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert got.count() == (1 if len(rows) == 3 else 0)  # scores of 0 lie in the window of a 0


def test_best_keeps_ties_by_id():
    best = M.Best(2, 3)
    best.add(np.array([0, 0, 0, 0, 1]), np.array([5, 5, 5, 5, 1]), np.array([9, 3, 7, 1, 4]))
    best.add(np.array([0, 0]), np.array([6, 5]), np.array([8, 2]))
    assert best.ids[0].tolist() == [8, 1, 2] and best.known[1].tolist() == [True, False, False]
    assert best.floor().tolist() == [5, np.iinfo(np.int64).min]
