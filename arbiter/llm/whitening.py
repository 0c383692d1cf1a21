"""Embedding whitening with components taken from the exact characteristic polynomial of the scatter.

Vectors are made integer (``floor(scale * c)``), so that their scatter matrix is one of integers, summed exactly. Its
characteristic polynomial is computed modulo many primes (Hessenberg reduction, one Spark row a prime) and put
together by Chinese remaindering. All its roots are real, so the sign changes of a shifted copy count the
roots above a place exactly, repeated ones included; that isolates the largest ones. Inverse iteration in long
decimals at a root gives the null space of ``scatter - root``: the components.
"""

from __future__ import annotations

import decimal
import math
import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import stage

#: Integers are cut into limbs of so many bits, so that 512 products add up exactly in a double.
LIMB_BITS, LIMB_ROWS = 22, 512
#: Bits of a digit of the sums that tasks hand on.
DIGIT_BITS = 48
#: Bits to which a root is known beyond its first; roots that agree in all of them count as one repeated root.
ROOT_BITS = 256


def integer_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every entry as long; null when the vector or an entry is null or not finite.

    Entries beyond 64 bits become the largest or smallest long.
    """
    wide = F.transform(vector, lambda c: c.cast("double"))
    whole = F.forall(wide, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return F.when(whole, F.transform(wide, lambda c: F.floor(c * scale).cast("long")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as doubles of few bits: x = sum of limb[k] << (k * LIMB_BITS)."""
    if not x.size or max(abs(int(x.max())), abs(int(x.min()))) < 1 << LIMB_BITS:
        return [x.astype(np.float64)]
    low = (1 << LIMB_BITS) - 1
    return [(x & low).astype(np.float64), (x >> LIMB_BITS & low).astype(np.float64), (x >> 2 * LIMB_BITS).astype(np.float64)]


def _gram(x: np.ndarray) -> np.ndarray:
    """x^T x of up to LIMB_ROWS rows, in Python integers."""
    limbs, out = _limbs(x), 0
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            out = out + (a.T @ b).astype(np.int64).astype(object) * (1 << (i + j) * LIMB_BITS)
    return out


def exact_sums(vectors: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and the sums of products of the rows of ``x`` (arrays of ``dim`` longs), all exact.

    A task hands on one row per pair of dimensions and digit, whatever its rows; the driver gets (dim + 1) ** 2 / 2 sums.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
            for at in range(0, len(x), LIMB_ROWS):
                total = total + _gram(x[at:at + LIMB_ROWS])
        out = []
        for i in range(dim + 1):
            for j in range(i, dim + 1):
                rest, sign, k = abs(total[i, j]), 1 if total[i, j] > 0 else -1, 0
                while rest:
                    out.append((i, j, k, sign * (rest & (1 << DIGIT_BITS) - 1)))
                    rest, k = rest >> DIGIT_BITS, k + 1
        if out:
            i, j, k, digit = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()),
                                              pa.array(digit, pa.int64())], names=["i", "j", "k", "digit"])

    sums = (vectors.select("x").mapInArrow(partial, "i int, j int, k int, digit long")
            .groupBy("i", "j", "k").agg(F.sum(F.col("digit").cast("decimal(20,0)")).alias("digit")).collect())
    both = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in sums:
        both[r.i][r.j] += int(r.digit) << DIGIT_BITS * r.k
    for i in range(dim + 1):
        for j in range(i):
            both[i][j] = both[j][i]
    return both[dim][dim], both[dim][:dim], [row[:dim] for row in both[:dim]]


def _is_prime(n: int) -> bool:
    """Miller-Rabin; the bases 2, 3, 5 and 7 decide every number below 2 ** 31."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2 ** 31, falling, whose product exceeds ``bound``."""
    out, product, n = [], 1, 2 ** 31 - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo the prime ``p`` < 2 ** 31."""
    a, d = matrix % p, len(matrix)
    for m in range(1, d - 1):
        at = np.flatnonzero(a[m:, m - 1])
        if not len(at):
            continue
        i = m + int(at[0])
        if i != m:
            a[[m, i]] = a[[i, m]]
            a[:, [m, i]] = a[:, [i, m]]
        factor = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - factor[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * factor % p).sum(axis=1)) % p
    # the polynomials of the leading blocks, each from those before
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        row = -(a[k - 1, k - 1] * poly[k - 1] % p)
        row[1:] += poly[k - 1, :-1]
        path, weights = 1, []
        for i in range(k - 1, 0, -1):
            path = path * int(a[i, i - 1]) % p
            weights.append(path * int(a[i - 1, k - 1]) % p)
        if weights:
            row = row - (np.array(weights[::-1], np.int64)[:, None] * poly[:k - 1] % p).sum(axis=0)
        poly[k] = row % p
    return poly[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, constant first, of det(x - matrix) of a matrix without negative eigenvalues.

    A coefficient is at most (1 + trace / d) ** d, as the eigenvalues' mean is trace / d. Every prime is one row.
    """
    d = len(matrix)
    primes = primes_beyond(2 * (2 + sum(matrix[i][i] for i in range(d)) // d) ** d + 1)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                small = np.array([[c % p for c in row] for row in matrix], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([polynomial_modulo(small, p)], pa.list_(pa.int64()))],
                                                 names=["p", "c"])

    slices = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(slices)
    value, modulus = [0] * (d + 1), 1
    for r in rows.mapInArrow(reduce, "p long, c array<long>").collect():
        inverse = pow(modulus, -1, r.p)
        value = [v + modulus * ((c - v) * inverse % r.p) for v, c in zip(value, r.c, strict=True)]
        modulus *= r.p
    return [v - modulus if 2 * v > modulus else v for v in value]


def _roots_above(poly: list[int], y: int) -> int:
    """Roots greater than ``y`` of a polynomial with real roots only, repeated ones counted: sign changes of poly(x + y)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += y * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], most: int) -> list[tuple[int, int, int]]:
    """(y, shift, times) of the largest positive roots, falling: the root lies in (y, y + 1] / 2 ** shift, ``times`` times.

    Roots are returned until ``most`` are there, counted with repetition. ``poly`` has no negative root.
    """
    d = len(poly) - 1
    zero = next(i for i, c in enumerate(poly) if c)
    poly, d = poly[zero:], d - zero
    if not d:
        return []
    trace = -poly[d - 1]
    # the product of the k largest roots is at least 1 / binomial(d, k): no root wanted is smaller than that over trace ** (k - 1)
    shift = ROOT_BITS + most * trace.bit_length() + d
    wide = [c << shift * (d - i) for i, c in enumerate(poly)]
    out, spans = [], [(0, trace << shift, d, 0)]
    while spans and sum(t for _, _, t in out) < most:
        low, high, above_low, above_high = spans.pop()
        times = above_low - above_high
        if not times:
            continue
        if times == 1:  # one simple root: the sign tells the side
            at_high = 0
            for c in reversed(wide):
                at_high = at_high * high + c
            if not at_high:
                out.append((high - 1, shift, 1))
                continue
            while high - low > 1:
                mid, value = (low + high) // 2, 0
                for c in reversed(wide):
                    value = value * mid + c
                if value and (value > 0) != (at_high > 0):
                    low = mid
                else:
                    high = mid
            out.append((low, shift, 1))
        elif high - low == 1:
            out.append((low, shift, times))
        else:
            mid = (low + high) // 2
            above = _roots_above(wide, mid)
            spans += [(low, mid, above_low, above), (mid, high, above, above_high)]
    return out


def null_space(matrix: list[list[int]], root: decimal.Decimal, times: int, digits: int) -> list[np.ndarray]:
    """``times`` orthonormal vectors that ``matrix - root`` sends to zero, by inverse iteration in ``digits`` digits."""
    d = len(matrix)
    with decimal.localcontext() as ctx:
        ctx.prec, ctx.Emax, ctx.Emin = digits, decimal.MAX_EMAX, decimal.MIN_EMIN
        a = np.array([[decimal.Decimal(c) for c in row] for row in matrix], dtype=object)
        for i in range(d):
            a[i, i] -= root
        tiny = max(abs(v) for v in a.ravel()) * decimal.Decimal(10) ** (4 - digits) or decimal.Decimal(1)
        order = list(range(d))
        for k in range(d):
            i = max(range(k, d), key=lambda r: abs(a[r, k]))
            if i != k:
                a[[k, i]] = a[[i, k]]
                order[k], order[i] = order[i], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        rng = random.Random(d)
        basis = [np.array([decimal.Decimal(rng.randrange(1, 10 ** 6)) for _ in range(d)], dtype=object) for _ in range(times)]
        for _ in range(4):
            done: list[np.ndarray] = []
            for v in basis:
                x = v[order]
                for k in range(1, d):
                    x[k] -= a[k, :k].dot(x[:k])
                for k in range(d - 1, -1, -1):
                    x[k] = (x[k] - (a[k, k + 1:].dot(x[k + 1:]) if k + 1 < d else 0)) / a[k, k]
                x = x / max(abs(c) for c in x)
                for u in done + done:
                    x = x - u * u.dot(x)
                done.append(x / x.dot(x).sqrt())
            basis = done
        return basis


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n fit vectors with sums S, ``weights`` (dim x components), the components' variances and shares."""

    n: int
    sums: list[int]
    weights: np.ndarray
    variances: list[float]
    explained: list[float]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: 64-bit integers, or Python's where those could overflow."""
        largest = max((abs(int(x.max())), abs(int(x.min()))), default=0) if x.size else 0
        if self.n * largest + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(np.float64) @ self.weights

    def deviation(self, x: np.ndarray) -> list[int]:
        away = self.centred(x)
        largest = max(abs(int(away.max())), abs(int(away.min()))) if away.size else 0
        if largest ** 2 * max(1, x.shape[1]) >= 1 << 63:
            away = away.astype(object)
        return [int(v) for v in (away * away).sum(axis=1)]


def fit(vectors: DataFrame, dim: int, components: int) -> Whitening:
    """The whitening of distinct integer vectors ``x``; it has fewer components where the variance has fewer dimensions."""
    n, sums, products = exact_sums(vectors, dim)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    trace = sum(scatter[i][i] for i in range(dim))
    weights, variances, explained = [], [], []
    if trace:
        roots = largest_roots(characteristic_polynomial(vectors.sparkSession, scatter), components)
        for y, shift, times in roots:
            digits = 40 + math.ceil((y.bit_length() + 2 * ROOT_BITS) * math.log10(2))
            with decimal.localcontext() as ctx:
                ctx.prec = digits
                root = decimal.Decimal(2 * y + 1) / decimal.Decimal(1 << shift + 1)
                for v in null_space(scatter, root, times, digits):
                    weights.append([float(c / root.sqrt()) for c in v])
                    variances.append(float(root / n / n))
                    explained.append(float(root / trace))
    made = np.array(weights[:components], np.float64).reshape(-1, dim).T
    return Whitening(n, sums, made, variances[:components], explained[:components])


def _dimension(sizes: Iterable) -> int:
    return max(((r["count"], r["dim"]) for r in sizes), default=(0, 0))[1]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4,
           scale: int = 256) -> DataFrame:
    """``id_col``, component, n, deviation, whitened, explained, identity_error: per row and component, numbered from 1.

    Rows whose vector is null or holds a null or non-finite entry are dropped, and so are vectors of another length
    than the most frequent one (the longest of equally frequent ones). The whitening is fitted on each
    distinct integer vector once; rows that repeat, or have equal vectors, all come out. Components are numbered by falling variance, either
    sign; those of one repeated variance are any orthonormal ones of its space, the same for all rows. Fewer components
    come out where the variance has fewer dimensions; no row does when it has none (an empty
    table, one distinct vector, vectors of no entries). ``deviation`` is the exact sum of (n x - S) ** 2 as
    decimal(38,0), null beyond 38 digits. Null ids pass through; other columns aren't looked at.

    The driver holds (dim + 1) ** 2 sums and the polynomial, nothing that grows with the rows.
    """
    slim = rows.select(F.col(id_col).alias("_id"), integer_vector(F.col(vector_col), scale).alias("x")).filter("x is not null")
    dim = _dimension(slim.groupBy(F.size("x").alias("dim")).count().collect())  # one row per length
    slim = slim.filter(F.size("x") == dim)
    distinct = stage(slim.select("x").distinct(), "whitening-fit")
    model = fit(distinct, dim, components) if dim else Whitening(0, [], np.zeros((0, 0)), [], [])
    k = len(model.variances)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(_matrix(batch.column(0), dim))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)])

    error = None
    if k:
        white = distinct.select("x").mapInArrow(projected, ", ".join(f"w{i} double" for i in range(k)))
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        found = white.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.array(np.arange(1, k + 1, dtype=np.int32))
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            each = np.repeat(np.arange(len(x)), k)
            spread = pa.array([decimal.Decimal(v) if v < 10 ** 38 else None for v in model.deviation(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(ids.to_numpy(), len(x))), spread.take(pa.array(each)),
                pa.array(model.project(x).ravel()), pa.array(np.tile(np.array(model.explained), len(x)))], names=names)

    names = ["_id", "component", "deviation", "whitened", "explained"]
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    made = slim.mapInArrow(run, schema) if k else rows.sparkSession.createDataFrame([], schema)
    return made.select(F.col("_id").alias(id_col), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       "explained", F.lit(error).cast("double").alias("identity_error"))
