"""Whitening against a dense eigensolver."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartsight.llm import whitening


def vectors(spark, rows, extra=None):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return table.withColumns(extra or {}).repartition(3)


def whole_numbers(rows, width):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept], np.int64)
    return [i for i, _ in kept], x.reshape(len(kept), width)


def agrees(spark, rows, width, components):
    got = whitening.whitened(vectors(spark, rows)).collect()
    ids, x = whole_numbers(rows, width)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - sums) / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    assert len(got) == len(ids) * components
    projected = ((n * x - sums) / n) @ turned / np.sqrt(values)
    expected = sorted((i, int(((n * row - sums) ** 2).sum()), *z) for i, row, z in zip(ids, x, np.abs(projected)))
    by_row, found = {}, []
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(abs(r["whitened"]))
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], values[r["component"] - 1] / np.trace(centred.T @ centred / n), rel_tol=1e-9)
    for (i, deviation), parts in by_row.items():
        found += [(i, deviation, *z) for z in zip(*(parts[k] for k in range(1, components + 1)))]
    assert [e[:2] for e in expected] == [f[:2] for f in sorted(found)]
    np.testing.assert_allclose([f[2:] for f in sorted(found)], [e[2:] for e in expected], atol=1e-8)


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((300, 6)) * [9, 5, 3, 2, 1, 0.5])]
    agrees(spark, rows + [(400, rows[0][1])] * 2 + [(500, rows[1][1])], 6, 6)


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((200, 20)) * np.geomspace(20, 1, 20))]
    agrees(spark, rows, 20, 16)


def test_dropped_dependent_and_short_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(b), float(a), 1.0]) for i, (a, b) in enumerate(rng.integers(-50, 50, (80, 2)))]  # rank 2 of 4
    rows += [(100, None), (101, [1.0, None, 1.0, 1.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [float("inf"), 0.0, 0.0, 0.0])]
    agrees(spark, rows, 4, 2)
    agrees(spark, rows[:50] + [(200, [3.0])], 4, 3)


def test_no_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [])]):
        assert whitening.whitened(vectors(spark, rows)).collect() == []


def test_clashing_columns_and_large_entries(spark):
    rows = [(None, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 0.5])]
    clash = {c: F.lit(7) for c in ("x", "n", "component", "_vector", "i", "part")}
    got = whitening.whitened(vectors(spark, rows, clash)).collect()
    assert {r["vec_id"] for r in got} == {None, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] != 3)


@pytest.mark.parametrize("values", [[5.0, 5.0, 5.0, 1.0], [3.0, 3.0, 0.0, 0.0], [1.0], [0.0, 0.0]])
def test_bidiagonal_form(values):
    """Repeated and missing singular values are found; the right vectors are orthonormal."""
    rng = np.random.default_rng(4)
    width = len(values)
    turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
    x = np.linalg.qr(rng.standard_normal((30, width)))[0] * values @ turn.T

    def product(c):
        u = x @ c
        return np.append(x.T @ u, u @ u)

    right, alpha, beta = whitening.bidiagonalised(product, width)
    np.testing.assert_allclose(right.T @ right, np.eye(width), atol=1e-12)
    np.testing.assert_allclose(np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))[1], sorted(values, reverse=True), atol=1e-8)
