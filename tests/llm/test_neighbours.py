"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from dossierlake.llm import neighbours

KINDS = "vec_id bigint, embedding array<float>, score string, rank string"


def vectors(n=300, dim=16, seed=3):
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]
    hot = rows[7][1]
    rows += [(n + i, hot) for i in range(80)]  # a common vector
    rows += [(n + 100 + i, [2 * x for x in rows[i][1]]) for i in range(5)]  # cosine 1 at another length
    rows += [(1, rows[1][1]), (50, rows[50][1])]  # repeated rows
    rows += [(900, None), (901, [0.0] * dim), (902, [None] + [1.0] * (dim - 1)), (903, [math.nan] * dim)]
    rows += [(950, [math.inf] + [1.0] * (dim - 1)), (None, hot), (904, [1.0, 2.0]), (1000, [2.0, 1.0]), (905, [])]
    return rows


def plain(rows, every=50, k=5):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    out = set()
    for q, x in good:
        if q % every:
            continue
        found = set()
        for i, y in good:
            if i != q and len(x) == len(y):
                # the same order of sums as in the operator
                dot = xx = yy = 0.0
                for a, b in zip(x, y, strict=True):
                    dot, xx, yy = dot + a * b, xx + a * a, yy + b * b
                found.add((-(dot / (math.sqrt(xx) * math.sqrt(yy))), i))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)}
    return out


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 3)
    monkeypatch.setattr(neighbours, "EXACT_PAIRS", 50)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "?", "?") for r in rows], KINDS).repartition(3)
    got = [tuple(r) for r in neighbours.nearest(frame, frame.where("vec_id % 50 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_few_and_no_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (1, [1.0, 1.0], "", "")], KINDS)
    rows = neighbours.nearest(frame, frame.where("vec_id % 50 = 0")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 1)]
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert neighbours.nearest(frame, frame.limit(0)).count() == 0


def test_bounds_hold():
    r = np.random.default_rng(5)
    x, y = r.normal(size=(50, 24)), r.normal(size=(60, 24)) * 100
    (xi, xs, xn, xe), (yi, ys, yn, ye) = neighbours.rounded(x), neighbours.rounded(y)
    near = (xi.astype(float) @ yi.astype(float).T) * xs[:, None] * ys
    room = xn[:, None] * ye + xe[:, None] * yn + xe[:, None] * ye
    true = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1))
    assert (np.abs(true - near) <= room + 1e-12).all()
