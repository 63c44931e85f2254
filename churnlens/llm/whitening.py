"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Vectors are quantised to integers, so n * sum(x x') - S S' is an integer matrix, n squared times the covariance
V. Its sums are gathered exactly (per task, then by Spark over 40-bit limbs). Its characteristic polynomial is
taken modulo as many primes as its coefficients need, each by reduction to Hessenberg form in a
task of its own, and put together by Chinese remaindering. All roots are real and none is negative,
so by Descartes' rule the sign changes of the polynomial shifted to a are exactly the roots above a, repeated
ones counted: bisection isolates every wanted root to some 300 bits. Components are found in the null space
of (matrix - root) by inverse iteration in fixed-point integers of that precision, roots that agree
throughout as one block. Only figures of the dimension's size (d x d sums, d + 1 coefficients, 16 vectors) reach
the driver; rows never do.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import map_arrow, ship
from .topk import usable

_LIMB = 40
_BITS = 320  # of the roots and of inverse iteration
_PRIME_BITS = 31
_ROWS = 4096


# --- exact sums -------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """Rows x d of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _gram(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact (column sums, x' x) of integers; in doubles where these are exact."""
    peak = float(np.abs(x.astype(np.float64)).max(initial=0.0))
    if peak * peak * len(x) < 2.0 ** 53:
        x = x.astype(np.float64)
        return [int(v) for v in x.sum(axis=0)], [[int(v) for v in row] for row in x.T @ x]
    x = x.astype(object)
    return list(x.sum(axis=0)), [list(row) for row in x.T @ x]


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield k, sign * (value & ((1 << _LIMB) - 1))
        value >>= _LIMB
        k += 1


def exact_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """(x array<long>) -> {length: (rows, sums per dimension, sums of products)}, exact."""
    def run(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            for d in np.unique(lengths):
                mine = column.filter(pa.array(lengths == d))
                for lo in range(0, len(mine), _ROWS):
                    part = mine.slice(lo, _ROWS)
                    s, g = _gram(_matrix(part))
                    have = totals.setdefault(int(d), [0, [0] * int(d), [[0] * int(d) for _ in range(int(d))]])
                    have[0] += len(part)
                    have[1] = [a + b for a, b in zip(have[1], s)]
                    have[2] = [[a + b for a, b in zip(x, y)] for x, y in zip(have[2], g)]
        rows = []
        for d, (n, s, g) in totals.items():
            entries = [(-1, -1, n), *((-1, j, v) for j, v in enumerate(s)),
                       *((i, j, g[i][j]) for i in range(d) for j in range(i, d))]
            rows += [(d, i, j, k, limb) for i, j, v in entries for k, limb in _limbs(v)]
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["d", "i", "j", "k", "limb"])

    parts = map_arrow(vectors, run, "d int, i int, j int, k int, limb long")
    # limbs of d * (d + 3) / 2 + 1 numbers: a bound that the table's rows don't enter
    found: dict[int, dict] = defaultdict(lambda: defaultdict(int))
    for r in parts.groupBy("d", "i", "j", "k").agg(F.sum("limb").alias("limb")).collect():
        found[r["d"]][r["i"], r["j"]] += r["limb"] << (_LIMB * r["k"])
    return {d: (v[-1, -1], [v[-1, j] for j in range(d)], [[v[min(i, j), max(i, j)] for j in range(d)] for i in range(d)])
            for d, v in found.items()}


# --- characteristic polynomial ----------------------------------------------------------

def charpoly_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (of x**0, x**1, ...) of det(x - matrix) modulo the prime p < 2**31, by reduction to
    Hessenberg form."""
    h, d = matrix.astype(np.int64) % p, len(matrix)
    for m in range(1, d - 1):
        rows = np.flatnonzero(h[m:, m - 1])
        if not len(rows):
            continue
        i = m + int(rows[0])
        if i != m:  # a similarity: rows and columns change places together
            h[[i, m]], h[:, [i, m]] = h[[m, i]], h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        if u.any():
            h[m + 1:] = (h[m + 1:] - u[:, None] * h[m][None, :] % p) % p
            for k in np.flatnonzero(u):
                h[:, m] = (h[:, m] + u[k] * h[:, m + 1 + k] % p) % p
    polys = [np.array([1], np.int64)]
    for m in range(1, d + 1):
        q = np.zeros(m + 1, np.int64)
        q[1:] = polys[-1]
        q[:-1] = (q[:-1] - h[m - 1, m - 1] * polys[-1] % p) % p
        below = 1
        for i in range(1, m):
            below = below * int(h[m - i, m - i - 1]) % p
            if not below:
                break
            factor = below * int(h[m - i - 1, m - 1]) % p
            lower = polys[m - i - 1]
            q[: len(lower)] = (q[: len(lower)] - factor * lower % p) % p
        polys.append(q % p)
    return polys[-1].tolist()


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n < 3,215,031,751."""
    if n % 2 == 0:
        return n == 2
    s = ((n - 1) & (1 - n)).bit_length() - 1
    for a in (2, 3, 5, 7):
        y = pow(a, (n - 1) >> s, n)
        if y not in (0, 1, n - 1) and all((y := y * y % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bits: int) -> list[int]:
    """The largest 31-bit primes whose product has more than ``bits`` bits."""
    out, n, have = [], (1 << _PRIME_BITS) - 1, 0.0
    while have <= bits + 1:
        if _is_prime(n):
            out.append(n)
            have += math.log2(n)
        n -= 2
    return out


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits of the largest coefficient: for eigenvalues that are not negative, the k-th elementary symmetric sum is at most
    C(d, k) * (trace / d)**k (Maclaurin)."""
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    return max(1, *(((math.comb(d, k) * trace ** k) // d ** k + 1).bit_length() for k in range(d + 1)))


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The integers, by Chinese remaindering, that leave ``residues`` (prime -> one per coefficient)."""
    values, modulus = [0] * len(next(iter(residues.values()))), 1
    for p, rest in residues.items():
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, rest)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - matrix), a prime per row of a Spark job."""
    primes = primes_beyond(coefficient_bits(matrix) + 1)

    def run(frames):
        for frame in frames:
            found = [(p, charpoly_modulo(np.array([[v % p for v in row] for row in matrix], np.int64), p))
                     for p in (primes[i] for i in frame["id"].tolist())]
            yield pd.DataFrame({"p": [p for p, _ in found], "c": [c for _, c in found]})

    ship(spark)
    rows = spark.range(0, len(primes), 1, min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    return remaindered({r["p"]: list(r["c"]) for r in rows.mapInPandas(run, "p long, c array<long>").collect()})


# --- roots and components --------------------------------------------------------------

def roots_above(poly: list[int], a: int, bits: int) -> int:
    """Roots above a / 2**bits, with multiplicity, of a polynomial whose roots are all real: the sign changes of
    its Taylor shift."""
    c = [v << (bits * (len(poly) - 1 - i)) for i, v in enumerate(poly)]  # in y = 2**bits * x
    n = len(c)
    for i in range(n - 1):
        for j in range(n - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_at(poly: list[int], a: int, bits: int) -> int:
    """2**(bits * degree) times the polynomial at a / 2**bits, exact."""
    total = 0
    for i, c in enumerate(reversed(poly)):
        total = total * a + (c << (bits * i))
    return total


def largest_roots(poly: list[int], count: int, digits: int = 72) -> list[tuple[int, int, int]]:
    """(numerator, bits, multiplicity): the ``count`` largest roots of a polynomial with real roots, none of them negative, and
    zero roots left out, each to ``digits`` bits of its own size. Roots that agree in these are one."""
    zeros = next(i for i, v in enumerate(poly) if v)
    poly = poly[zeros:]
    wanted = min(count, len(poly) - 1)
    if wanted <= 0:
        return []
    top = 1
    while roots_above(poly, top, 0):
        top <<= 1
    out: list[tuple[int, int, int]] = []
    # intervals (low, high] / 2**bits with their counts above, largest roots first
    stack = [(0, top, 0, len(poly) - 1, 0)]
    done = 0
    while stack and done < wanted:
        low, high, bits, above_low, above_high = stack.pop()
        if above_low == above_high:
            continue
        if low and (low >> digits) >= high - low:
            out.append((low + high, bits + 1, above_low - above_high))
            done += above_low - above_high
            continue
        middle = low + high
        low, high, bits = 2 * low, 2 * high, bits + 1
        if above_low - above_high == 1:  # one root: the sign at the middle tells its side
            sign = value_at(poly, middle, bits)
            above = above_high + (sign != 0 and (sign > 0) == (above_high % 2 == 1))
        else:
            above = roots_above(poly, middle, bits)
        stack.append((low, middle, bits, above_low, above))
        stack.append((middle, high, bits, above, above_high))
    return out


def refined(poly: list[int], root: tuple[int, int, int], bits: int) -> int:
    """The root in units of 2**-bits: Newton steps (for a root of its multiplicity) on exact values, until they no longer shrink."""
    value, have, times = root
    y = value << (bits - have) if bits >= have else value >> (have - bits)
    slope = [i * c for i, c in enumerate(poly)][1:]
    last = None
    while True:
        steep = value_at(slope, y, bits)
        if not steep:
            return y
        step = times * value_at(poly, y, bits) // steep  # of values in units of 2**(-bits * degree): one place more
        if not step or last is not None and abs(step) >= abs(last):
            return y
        y, last = y - step, step


def null_space(matrix: list[list[int]], root: int, bits: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors that (matrix - root / 2**bits) all but cancels, by inverse iteration in fixed point."""
    d, one = len(matrix), 1 << bits
    a = [[(v << bits) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    order, lower = [], []
    for k in range(d):  # LU with partial pivoting, factors kept as fixed-point integers
        i = max(range(k, d), key=lambda r: abs(a[r][k]))
        a[k], a[i] = a[i], a[k]
        order.append(i)
        pivot = a[k][k] or 1  # an exact zero is moved by the last place
        a[k][k] = pivot
        factors = []
        for r in range(k + 1, d):
            f = (a[r][k] << bits) // pivot
            factors.append(f)
            if f:
                top = a[k]
                a[r] = [x if j < k else x - (f * top[j] >> bits) for j, x in enumerate(a[r])]
        lower.append(factors)

    def solve(b: list[int]) -> list[int]:
        b = list(b)
        for k in range(d):
            b[k], b[order[k]] = b[order[k]], b[k]
            for r, f in enumerate(lower[k], k + 1):
                b[r] -= f * b[k] >> bits
        x = [0] * d
        for k in range(d - 1, -1, -1):
            rest = (b[k] << bits) - sum(a[k][j] * x[j] for j in range(k + 1, d))
            x[k] = rest // a[k][k]
        return x

    def orthonormal(vectors: list[list[int]]) -> list[list[int]]:
        out: list[list[int]] = []
        for v in vectors:
            high = max(1, max(abs(x) for x in v)).bit_length()
            v = [x << (bits - high) if high <= bits else x >> (high - bits) for x in v]
            for _ in range(2):
                for u in out:
                    dot = sum(x * y for x, y in zip(u, v)) >> bits
                    v = [y - (dot * x >> bits) for x, y in zip(u, v)]
                norm = math.isqrt(sum(x * x for x in v)) or 1
                v = [x * one // norm for x in v]
            out.append(v)
        return out

    # starting vectors: fixed pseudo-random integers, independent for every member of the block
    seed = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 30, (count, d))
    block = orthonormal([[int(x) << (bits - 30) for x in row] for row in seed])
    for _ in range(3):
        block = orthonormal([solve(v) for v in block])
    return [[x / one for x in v] for v in block]


def components(spark: SparkSession, n: int, sums: list[int], products: list[list[int]], count: int) -> list[tuple[float, float, list[float]]]:
    """(eigenvalue of the covariance, share of its trace, unit vector), by falling eigenvalue: the ``count`` largest that are not
    zero. The roots are isolated once, each one's vectors are found in a task of its own."""
    d = len(sums)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    if trace == 0:
        return []
    poly = characteristic_polynomial(spark, scatter)
    bits = _BITS + trace.bit_length()
    roots = largest_roots(poly, count)

    def run(frames):
        for frame in frames:
            found = []
            for at in frame["id"].tolist():
                y = refined(poly, roots[at], bits)
                found += [(at, m, str(y), v) for m, v in enumerate(null_space(scatter, y, bits, roots[at][2]))]
            yield pd.DataFrame(found, columns=["at", "m", "root", "vector"])

    rows = spark.range(0, len(roots), 1, len(roots))
    found = sorted(rows.mapInPandas(run, "at int, m int, root string, vector array<double>").collect())[:count]
    return [(int(r["root"]) / (n * n << bits), int(r["root"]) / (trace << bits), list(r["vector"])) for r in found]


# --- the operator ------------------------------------------------------------------------

def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 16,
           scale: int = 64) -> DataFrame:
    """One row per vector and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``.

    Entries become x = floor(scale * c); a constant added to all of them (1,000,000 in the contract) changes no figure here, so none
    is. The fit list holds each distinct x vector once. Vectors that are null, or hold
    null or non-finite entries, are dropped; null ids stay null and repeated rows are returned each time. Vectors
    of several lengths are fitted apart, each length by its own; empty vectors have no component. Eigenvalues that
    are exactly zero have no component either (a single vector, or fewer distinct vectors than dimensions), as nothing can be
    divided by them; where eigenvalues are equal any orthonormal vectors of their space are taken. ``deviation`` beyond a long is
    null. Entries beyond a long are held at its ends. An empty table gives an empty result. Other columns are not read.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
            .filter(usable(F.col("x")) & (F.size("x") > 0))
            .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("x")))
    rows = materialize(rows, "quantised")
    distinct = materialize(rows.select("x").distinct(), "fit-list")
    fits = {}
    for d, (n, sums, products) in exact_sums(distinct).items():
        found = components(vectors.sparkSession, n, sums, products, count)
        fits[d] = (n, sums, [f[0] for f in found], [f[1] for f in found], [f[2] for f in found])
    errors = _identity_errors(distinct, fits)

    def run(batches):
        for batch in batches:
            for part, d in _by_length(batch, 1):
                n, sums, values, shares, axes = fits[d]
                if not values:
                    continue
                ids = part.column(0)
                for lo in range(0, part.num_rows, _ROWS):
                    x = _matrix(part.column(1).slice(lo, _ROWS))
                    off, deviation = _offsets(x, n, sums)
                    w = _projected(off, n, values, axes)
                    m, k = w.shape
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, _ROWS).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, n, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                         pa.array(w.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, errors[d]))],
                        names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = "_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return map_arrow(rows, run, schema).withColumnRenamed("_id", id_col)


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    lengths = np.diff(batch.column(at).offsets.to_numpy())
    for d in np.unique(lengths):
        yield batch.filter(pa.array(lengths == d)), int(d)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(n * x - S as doubles, the exact sum of its squares per row or None beyond a long)."""
    peak = n * float(np.abs(x.astype(np.float64)).max(initial=0.0)) + max(abs(s) for s in sums)
    if peak < 2.0 ** 53 and peak * peak * x.shape[1] < 2.0 ** 62:
        off = n * x - np.array(sums, np.int64)
        return off.astype(np.float64), (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    total = (off * off).sum(axis=1).tolist()
    return off.astype(np.float64), [v if v < 1 << 63 else None for v in total]


def _projected(off: np.ndarray, n: int, values: list[float], axes: list[list[float]]) -> np.ndarray:
    return (off / n) @ np.array(axes).T / np.sqrt(np.array(values))


def _identity_errors(distinct: DataFrame, fits: dict) -> dict[int, float]:
    """Largest absolute entry of the whitened fit list's covariance less the identity, per length."""
    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, d in _by_length(batch, 0):
                n, sums, values, _, axes = fits[d]
                for lo in range(0, part.num_rows if values else 0, _ROWS):
                    w = _projected(_offsets(_matrix(part.column(0).slice(lo, _ROWS)), n, sums)[0], n, values, axes)
                    w = np.hstack([w, np.ones((len(w), 1))])
                    totals[d] = totals.get(d, 0.0) + w.T @ w
        rows = [(d, i, j, float(t[i, j])) for d, t in totals.items() for i in range(len(t)) for j in range(len(t))]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
                                         names=["d", "i", "j", "v"])

    out = {d: 0.0 for d in fits}
    sums: dict[int, dict] = defaultdict(dict)
    # (count + 1) squared numbers per length
    for r in map_arrow(distinct, run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["d"]][r["i"], r["j"]] = r["v"]
    for d, v in sums.items():
        k = math.isqrt(len(v)) - 1
        n = v[k, k]
        out[d] = max(abs(v[i, j] / n - v[i, k] / n * v[j, k] / n - (i == j)) for i in range(k) for j in range(k))
    return out
