"""Embedding whitening: exact parts against plain integer arithmetic, components against numpy."""

import random
from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F

from arbiter.llm.whitening import (
    characteristic_polynomial,
    integer_vector,
    largest_roots,
    polynomial_modulo,
    primes_beyond,
    whiten,
)


def plain_polynomial(m):
    """det(x - m), constant first, by the Faddeev-LeVerrier recurrence in fractions."""
    d = len(m)
    a = [[Fraction(c) for c in row] for row in m]
    out, b = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        b = [[sum(a[i][t] * b[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(a[i][t] * b[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in reversed(out)]


def scatter(rng, d, n, size):
    x = [[rng.randint(-size, size) for _ in range(d)] for _ in range(n)]
    s = [sum(c) for c in zip(*x, strict=True)]
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


def test_polynomial_is_exact(spark):
    rng = random.Random(1)
    for d, n, size in ((1, 3, 5), (2, 9, 10 ** 9), (5, 3, 40), (8, 40, 10 ** 17), (6, 30, 1)):
        m = scatter(rng, d, n, size)
        assert characteristic_polynomial(spark, m) == plain_polynomial(m)
    zeros = [[0, 0, 0], [0, 4, 0], [0, 0, 4]]
    assert characteristic_polynomial(spark, zeros) == plain_polynomial(zeros)


def test_polynomial_modulo_swaps_rows():
    m = np.array([[2, 0, 3, 1], [0, 5, 1, 0], [3, 1, 7, 2], [1, 0, 2, 4]])
    p = primes_beyond(10)[0]
    assert [c - p if c > p // 2 else c for c in polynomial_modulo(m, p)] == plain_polynomial(m.tolist())


@pytest.mark.parametrize("roots", [(1, 2, 3), (7, 7, 7, 2), (5, 0, 0), (0, 0), (9, 9, 1, 1, 0), (10 ** 20, 10 ** 20 + 1, 1)])
def test_roots_are_isolated(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = [Fraction(y + 1, 1 << shift) for y, shift, times in largest_roots(poly, 3) for _ in range(times)]
    want = sorted((r for r in roots if r), reverse=True)
    assert all(abs(a - b) <= Fraction(1, 1 << 200) for a, b in zip(found, want, strict=False))
    assert len(found) >= min(3, len(want))


def table(spark, rows):
    """Columns of other names, one that clashes with an output and one with an inner name."""
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, n string, x int")


def plain(rows, k=4, scale=256):
    """{(id, component): (n, deviation, |whitened|, explained)} by numpy in doubles, integers exact."""
    kept = [(i, [int(np.floor(scale * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, float) - np.array(s, float) / n
    e, q = np.linalg.eigh(x.T @ x / n)
    out = {}
    for i, v in kept:
        for c in range(k):
            w = (np.array(v, float) - np.array(s, float) / n) @ q[:, -1 - c] / np.sqrt(e[-1 - c])
            out[i, c + 1] = (n, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), abs(w), e[-1 - c] / e.sum())
    return out


def test_whitening_against_numpy(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + d) / 10 for d in range(7)]) for i in range(60)]
    rows += [(100, rows[3][1]), (101, list(rows[4][1])), (100, rows[3][1])]                  # copies count once in the fit
    rows += [(200, None), (201, [0.1] * 6 + [None]), (202, [0.1] * 6 + [float("nan")]), (203, [float("inf")] + [0.1] * 6),
             (204, [-0.0] * 7), (205, [0.1] * 6), (None, [0.2] * 7)]
    got = whiten(table(spark, rows)).collect()
    want = plain([r for r in rows if r[0] != 205])
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted(
        (i is None, i or 0, c) for i, _ in rows if i is None or i < 200 or i == 204 for c in (1, 2, 3, 4))
    for r in got:
        n, deviation, white, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - white) < 1e-9 and abs(r.explained - share) < 1e-9 and r.identity_error < 1e-12


def test_repeated_variances_and_flat_spaces(spark):
    corners = [[s / 16 if i == j else 0.0 for j in range(5)] for i in range(3) for s in (-1, 1)]   # three equal variances, two of none
    got = whiten(table(spark, list(enumerate(corners)))).collect()
    assert {r.component for r in got} == {1, 2, 3} and all(abs(r.explained - 1 / 3) < 1e-12 for r in got)
    assert all(r.identity_error < 1e-12 for r in got)
    for i in range(6):  # whitened, the six corners lie on one sphere
        assert abs(sum(r.whitened ** 2 for r in got if r.vec_id == i) - 3) < 1e-9


def test_sizes_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [float("nan")])]):
        out = whiten(table(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.collect() == []
    two = whiten(table(spark, [(1, [0.0]), (2, [1.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened)) for r in two) == [(1, 1, 2, 256 ** 2, 1.0), (2, 1, 2, 256 ** 2, 1.0)]


def test_very_large_entries(spark):
    rows = [(1, [1e14, 3.0]), (2, [-1e14, 1.0]), (3, [5e13, -2.0]), (4, [0.25, 1e300])]
    got = whiten(table(spark, rows), components=2).collect()
    kept = table(spark, rows).select("vec_id", integer_vector(F.col("embedding"), 256).alias("v")).collect()
    s = [sum(r.v[i] for r in kept) for i in range(2)]
    for r in got:
        v = next(k.v for k in kept if k.vec_id == r.vec_id)
        exact = sum((4 * a - b) ** 2 for a, b in zip(v, s, strict=True))
        assert r.deviation == (exact if exact < 10 ** 38 else None)
    assert all(r.identity_error < 1e-9 for r in got) and next(r for r in kept if r.vec_id == 4).v[1] == 2 ** 63 - 1
