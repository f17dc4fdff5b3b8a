import math

import numpy as np
import pytest

from orderloom.llm import nearest
from orderloom.llm.common import table

LARGEST = 2**63 - 1
COLUMNS = "vec_id long, embedding array<float>, label int, row string, rank string, score string, `a.b` string"


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], COLUMNS).repartition(3)

    return build


def brute(rows, k=20, every=20, scale=64):
    """Lists of (score, id) of every query; copies of a row count each."""
    fine = []
    for number, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            clip = [max(-LARGEST, min(LARGEST, math.floor(scale * float(np.float32(x))))) for x in v]
            fine.append((number, i, clip))
    out = []
    for number, i, v in fine:
        if i is not None and i % every == 0:
            scored = [
                (max(-LARGEST, min(LARGEST, sum(a * b for a, b in zip(v, w, strict=True)))), j)
                for other, j, w in fine
                if other != number and len(w) == len(v)
            ]
            scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
            out += [(i, rank + 1, j, s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()], key=str)


def test_table_as_brute_force(spark):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert result(nearest.top_k(vectors)) == brute(rows)


def test_odd_vectors(vectors):
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(5).tolist()) for k in range(90)]
    rows += [
        (100, None), (120, []), (140, [None, 1.0, 1.0, 1.0, 1.0]), (160, [math.nan] * 5),
        (180, [math.inf] + [0.0] * 4), (200, [0.0] * 5), (220, [1.0, 2.0]), (240, [2.0, 1.0]),
        (None, rows[3][1]), (None, [9.0] * 5), (2**62, rows[4][1]), (2**62 + 4, rows[4][1]), (-20, [1.0] * 5),
        (40, rows[40][1]), (41, rows[41][1]), (260, [-0.001, 0.001, 0.5, -0.5, 0.0]), (280, [1.0] * 9),
    ]
    assert result(nearest.top_k(vectors(rows))) == brute(rows)
    assert result(nearest.top_k(vectors([]))) == []
    assert result(nearest.top_k(vectors([(7, [1.0])]))) == []


def test_numbers_beyond_64_bits(vectors):
    rows = [(20, [3e38, -1.0]), (1, [3e38, 0.0]), (2, [-3e38, 1e9]), (3, [1.0, 1.0]), (4, [1e10, 1e12]), (40, [1e9, -7.0])]
    assert result(nearest.top_k(vectors(rows))) == brute(rows)


def test_ties_and_copies(vectors):
    rows = [(k, [1.0, 0.0, -1.0, 0.5]) for k in range(300)] + [(k, [1.0, 0.1 * (k % 3), 0.0, 0.0]) for k in range(300, 400)]
    assert result(nearest.top_k(vectors(rows))) == brute(rows)


def test_many_cells(vectors, monkeypatch):
    """Small blocks: queries and candidates meet in many cells, with fewer seeds than rows."""
    for name, value in {"QUERIES": 7, "CANDIDATES": 40, "CHUNK": 9, "SEEDS": 30}.items():
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((6, 24)) * 3
    rows = [(k, (centres[k % 6] + rng.standard_normal(24) * 0.2).tolist()) for k in range(700)]
    assert result(nearest.top_k(vectors(rows))) == brute(rows)


@pytest.mark.parametrize("length", [1, 2, 4, 16, 30])
def test_statistics_bound_products(length):
    rng = np.random.default_rng(length)
    a = nearest.whole(rng.standard_normal((40, 30)) * rng.exponential(1, (40, 1)), 64)
    bound = nearest._most(nearest.statistics(a, length), nearest.statistics(a, length))
    assert (bound >= a @ a.T).all()
    if length == 1:  # segments of one coordinate leave nothing open
        assert np.allclose(bound, a @ a.T, rtol=1e-6, atol=1e-2)


def test_bounds_leave_out_far_vectors(monkeypatch):
    """Vectors apart in level: the coarse level settles all but the own cluster."""
    sizes = []
    exact = nearest.products
    monkeypatch.setattr(nearest, "products", lambda a, b: sizes.append(len(a) * len(b)) or exact(a, b))
    levels = np.repeat(np.array([9, 0, 0, 0, 0, 0, 0, 0]), 256)[:, None] * np.ones((1, 32), np.int64)
    vectors = levels + np.random.default_rng(0).integers(0, 2, levels.shape)
    rows = np.arange(len(vectors))
    found = nearest.search_block(vectors[:20], rows[:20], np.full(20, -LARGEST), vectors, rows, rows, 5)
    assert sum(sizes) < 20 * len(vectors) / 2
    product = vectors[:20] @ vectors.T
    product[rows[:20], rows[:20]] = -LARGEST
    best = np.sort(product, axis=1)[:, ::-1][:, :5]
    assert (found[:, 1].reshape(20, 5) == best).all()
