"""Whitening against numpy over exact whole numbers."""

import math
import random

import numpy as np
import pytest

from dossierlake.llm import whitening as w
from dossierlake.llm.queries import op13_whitening

ROW = "vec_id bigint, embedding array<float>, x string, index string, v int, y string, whitened string"
SMALL = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "?", "?", 0, "?", "?") for i, v in rows], ROW).repartition(3)


def whole(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def plain(vectors, components=16):
    """n, deviations, eigenvalue shares and absolute whitened components of float32 vectors."""
    x = [whole(v) for v in vectors]
    fit = sorted({tuple(r) for r in x})
    n, dims = len(fit), len(fit[0])
    s = [sum(r[i] for r in fit) for i in range(dims)]
    deviations = [sum((n * r[i] - s[i]) ** 2 for i in range(dims)) for r in x]
    centred = lambda rows: np.array([[(n * r[i] - s[i]) / n for i in range(dims)] for r in rows])
    c = centred(fit)
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-10 * values[0]).sum()))
    white = np.abs(centred(x) @ (axes[:, :k] / np.sqrt(values[:k])))
    return n, deviations, values[:k] / values.sum(), white


def check(frame, ids, vectors):
    n, deviations, shares, white = plain(vectors)
    got = {}
    for r in frame.collect():
        got.setdefault(r.vec_id, []).append(r)
    assert sorted(got) == sorted(set(ids))
    for i, d, row in zip(ids, deviations, white, strict=True):
        mine = sorted(got[i], key=lambda r: r.component)
        assert {(r.n, r.deviation) for r in mine} == {(n, d)}
        assert sorted({r.component for r in mine}) == list(range(1, len(shares) + 1))
        for r in mine:
            assert abs(r.explained - shares[r.component - 1]) < 1e-9
            assert abs(abs(r.whitened) - row[r.component - 1]) < 1e-6
            assert r.identity_error < 1e-8


def test_the_query(spark):
    frame = op13_whitening(spark, SMALL)
    assert dict(frame.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check(frame, [r.vec_id for r in rows], [r.embedding for r in rows])
    signs = {}
    for r in frame.where("component <= 2").collect():
        signs.setdefault(r.component, []).append(r.whitened)
    assert all(min(s) < 0 < max(s) for s in signs.values())


def test_a_vector_with_a_third_of_all_rows(spark):
    r = random.Random(3)
    some = [[r.gauss(0, 1 + j) for j in range(5)] for _ in range(60)]
    rows = [(i, some[0] if i % 3 == 0 else some[i % 60]) for i in range(4000)]
    check(w.whiten(table(spark, rows)), [i for i, _ in rows], [v for _, v in rows])


def test_rows_that_are_left_out_and_rows_that_repeat(spark):
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [0.5, 0.25]), (3, [0.5, 0.25]), (4, [0.5, 0.25]), (5, [-3.0, 1e3])]
    bad = [(6, None), (7, []), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [1.0, float("-inf")]), (11, [1e18, 0.0]), (12, [1.0, 2.0, 3.0])]
    frame = w.whiten(table(spark, good + bad))
    assert sorted(r.vec_id for r in frame.where("component = 1").collect()) == [1, 2, 3, 3, 4, 5]
    check(frame, [i for i, _ in good], [v for _, v in good])
    assert frame.where("n <> 4").isEmpty()


def test_a_null_id_has_its_rows(spark):
    frame = w.whiten(table(spark, [(None, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.0, 0.0])]))
    assert frame.where("vec_id IS NULL").count() == 2


def test_fewer_components_than_asked_for(spark):
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]
    check(w.whiten(table(spark, line)), [i for i, _ in line], [v for _, v in line])
    assert w.whiten(table(spark, line)).count() == 9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_whiten(spark, rows):
    frame = w.whiten(table(spark, rows))
    assert frame.collect() == [] and frame.columns == [c.split()[0] for c in w.RESULT.split(", ")]


def test_deviation_without_room_is_null(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 2.0])]
    found = {r.vec_id: r.deviation for r in w.whiten(table(spark, rows), components=1).collect()}
    assert found[1] is None and found[2] is None
