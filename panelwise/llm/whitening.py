"""Whitening of vectors through the exact characteristic polynomial of their scatter matrix."""
from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import comb, gcd
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: An entry c is counted as floor(SCALE * c); a constant added to that, as callers may ask for, changes nothing below.
SCALE = 1024
#: Digits kept while components are computed; eigenvalues closer than this many bits are one.
DIGITS, SAME_BITS = 90, 90
#: Primes whose matrices a task reduces together.
_PRIMES = 16
_LIMB = 20
_ROWS = 8192
_TOP = 1 << 62


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * c) of vectors of ``dim`` finite entries; beyond 62 bits the nearest value within."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):  # scaled beyond a double: infinite, and clipped
        scaled = np.floor(values * SCALE)
    out = np.clip(scaled, -float(_TOP), float(_TOP))
    return out.astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles of at most 19 bits and a sign that add up to ``y``, each worth 2^20 of the one before."""
    out = []
    while y.any():
        low = ((y + (1 << (_LIMB - 1))) & ((1 << _LIMB) - 1)) - (1 << (_LIMB - 1))
        out.append(low.astype(np.float64))
        y = (y - low) >> _LIMB
    return out


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers. Products of limbs are exact in doubles: 2^38 each, 2^13 rows at a time."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), _ROWS):
        limbs = _limbs(y[at : at + _ROWS])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) * (1 << (_LIMB * (i + j)))
    return total


def _integers(values: np.ndarray) -> list[str]:
    return [str(int(v)) for v in values]


def _sum_products(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for batch in batches:
            y = _matrix(batch.column("vector"), dim)
            n += len(y)
            sums += y.astype(object).sum(axis=0) if len(y) else 0
            products += exact_products(y)
        if n:
            rows = [_integers(r) for r in products]
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(_integers(sums)), pa.array(rows, pa.list_(pa.string()))], names=["i", "n", "s", "products"])

    return run


def _add_rows(rows: pa.Table) -> pa.Table:
    """All tasks' rows of one dimension, added."""
    products = np.zeros(len(rows.column("products")[0]), dtype=object)
    for row in rows.column("products"):
        products += np.array([int(x) for x in row.as_py()], dtype=object)
    total = str(sum(map(int, rows.column("s").to_pylist())))
    return pa.table({"i": rows.column("i").slice(0, 1), "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()), "s": pa.array([total]), "products": pa.array([_integers(products)], pa.list_(pa.string()))})


def moments(vectors: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, products) of floor(SCALE * c), exact: each task adds up its rows, then one group per dimension."""
    parts = vectors.mapInArrow(_sum_products(dim), "i int, n long, s string, products array<string>")
    rows = sorted(parts.groupBy("i").applyInArrow(_add_rows, "i int, n long, s string, products array<string>").collect(), key=lambda r: r["i"])  # dim rows
    if not rows:
        return 0, [0] * dim, np.zeros((dim, dim), dtype=object)
    return rows[0]["n"], [int(r["s"]) for r in rows], np.array([[int(x) for x in r["products"]] for r in rows], dtype=object)


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test, certain below 3 * 10^9 with these bases."""
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


def _primes(above: int) -> list[int]:
    """Primes below 2^31, largest first, until their product is greater than ``above``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= above:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomials_modulo(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Characteristic polynomial modulo each prime, constant term first: similarity to Hessenberg form, then its recurrence."""
    dim, count = len(matrix), len(primes)
    p = np.array(primes, dtype=np.int64)
    m = np.array([(matrix % q).astype(np.int64) for q in primes], dtype=np.int64).reshape(count, dim, dim)
    every, p2, p3 = np.arange(count), p[:, None], p[:, None, None]
    for k in range(1, dim - 1):
        found = m[:, k:, k - 1] != 0
        pivot = k + found.argmax(axis=1)
        some = found.any(axis=1)
        for axis in (0, 1):  # exchange rows, then columns
            view = m if axis == 0 else m.transpose(0, 2, 1)
            held = view[every, pivot].copy()
            view[every, pivot] = view[:, k]
            view[:, k] = held
        inverse = np.array([pow(int(x), -1, q) if ok else 0 for x, q, ok in zip(m[:, k, k - 1], primes, some)], dtype=np.int64)
        f = m[:, k + 1 :, k - 1] * inverse[:, None] % p2
        m[:, k + 1 :, :] = (m[:, k + 1 :, :] - f[:, :, None] * m[:, k, None, :] % p3) % p3
        m[:, :, k] = (m[:, :, k] + (m[:, :, k + 1 :] * f[:, None, :] % p3).sum(axis=2)) % p2
    polys = np.zeros((dim + 1, count, dim + 1), dtype=np.int64)
    polys[0, :, 0] = 1
    for k in range(1, dim + 1):
        here = np.zeros((count, dim + 1), dtype=np.int64)
        here[:, 1:] = polys[k - 1, :, :-1]
        here -= m[:, k - 1, k - 1, None] * polys[k - 1] % p2
        below = np.ones(count, dtype=np.int64)
        for i in range(k - 2, -1, -1):
            below = below * m[:, i + 1, i] % p
            here -= (m[:, i, k - 1] * below % p)[:, None] * polys[i] % p2
        polys[k] = here % p2
    return polys[dim]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients, constant term first, of a symmetric matrix without negative eigenvalues.

    The k-th coefficient is at most C(dim, k) (trace / dim)^k, which says how many primes are needed. Tasks reduce the
    matrix modulo their primes; the residues, one row of ``dim`` numbers for each prime, are combined by Chinese remainders.
    """
    dim = len(matrix)
    mean = -(-int(np.trace(matrix)) // dim)
    bound = max(comb(dim, k) * mean**k for k in range(dim + 1))
    primes = _primes(2 * bound)
    sent = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.column("prime").to_pylist()
            for at in range(0, len(chosen), _PRIMES):
                part = chosen[at : at + _PRIMES]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(polynomials_modulo(sent.value, part).tolist(), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = -(-len(primes) // _PRIMES)
    table = spark.createDataFrame([(q,) for q in primes], "prime long").repartition(tasks)
    residues = {r["prime"]: r["residues"] for r in table.mapInArrow(run, "prime long, residues array<long>").collect()}
    product = 1
    for q in primes:
        product *= q
    out = [0] * (dim + 1)
    for q in primes:
        rest = product // q
        factor = rest * pow(rest, -1, q)
        out = [a + r * factor for a, r in zip(out, residues[q])]
    return [(a + product // 2) % product - product // 2 for a in out]


def _roots_above(poly: list[int], t: int) -> int:
    """How many roots of a polynomial with real roots only are greater than ``t``: sign changes after a shift by t."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], t: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * t + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int, int]]:
    """(numerator, bits, times): roots numerator / 2^bits above zero of a monic polynomial with real roots >= 0, largest first.

    ``times`` roots agree in ``SAME_BITS`` bits. They are isolated by counting the roots above a point, then halved by sign;
    the scale grows until the smallest has enough bits.
    """
    poly = poly[next(k for k, c in enumerate(poly) if c) :]  # roots that are exactly zero
    degree = len(poly) - 1
    count = min(count, degree)
    if not count:
        return []
    trace = -poly[-2]
    bits = max(0, 2 * SAME_BITS - trace.bit_length())
    while True:
        scaled = [c << (bits * (degree - k)) for k, c in enumerate(poly)]
        out: list[tuple[int, int, int]] = []
        todo = [(0, (trace + 1) << bits, degree, 0)]  # (low, high, roots above low, roots above high)
        while todo and sum(t for _, _, t in out) < count:
            low, high, above_low, above_high = todo.pop()
            inside = above_low - above_high
            if not inside:
                continue
            if high - low <= max(1, low >> SAME_BITS):
                out.append((high, bits, inside))
                continue
            middle = (low + high) // 2
            if inside == 1:
                side = _sign(scaled, high) or (-1 if above_high % 2 else 1)
                if _sign(scaled, middle) == side:
                    todo.append((low, middle, above_low, above_high))
                else:
                    todo.append((middle, high, above_high + 1, above_high))
                continue
            above = _roots_above(scaled, middle)
            todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
        if all(v.bit_length() > SAME_BITS for v, _, _ in out):
            return out
        bits += 2 * SAME_BITS


def null_space(matrix: np.ndarray, value: Decimal, times: int) -> np.ndarray:
    """``times`` orthonormal vectors (rows) that ``matrix - value`` sends to about zero, by inverse iteration."""
    dim = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        lu = np.array([[Decimal(int(x)) for x in row] for row in matrix], dtype=object)
        top = max(abs(x) for x in lu.ravel()) or Decimal(1)
        for i in range(dim):
            lu[i, i] -= value
        order = np.arange(dim)
        tiny = top.scaleb(-(DIGITS - 10))
        for k in range(dim):
            pivot = k + max(range(dim - k), key=lambda r: abs(lu[k + r, k]))
            if pivot != k:
                lu[[k, pivot]] = lu[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            if abs(lu[k, k]) < tiny:
                lu[k, k] = tiny
            lu[k + 1 :, k] = lu[k + 1 :, k] / lu[k, k]
            if k + 1 < dim:
                lu[k + 1 :, k + 1 :] = lu[k + 1 :, k + 1 :] - np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
        rng = np.random.default_rng(13)
        found = np.array([[Decimal(int(x)) for x in rng.integers(1, 1000, dim)] for _ in range(times)], dtype=object)
        for _ in range(3):
            solved = []
            for v in found:
                x = v[order].copy()
                for k in range(1, dim):
                    x[k] -= lu[k, :k].dot(x[:k])
                for k in range(dim - 1, -1, -1):
                    x[k] = (x[k] - (lu[k, k + 1 :].dot(x[k + 1 :]) if k + 1 < dim else 0)) / lu[k, k]
                for other in solved:
                    x = x - other * other.dot(x)
                solved.append(x / x.dot(x).sqrt())
            found = np.array(solved, dtype=object)
        return np.array([[float(x) for x in v] for v in found])


def components(spark: SparkSession, n: int, sums: list[int], products: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors by row, eigenvalues, shares of the trace) of the covariance, largest first; eigenvalues of zero are left out."""
    dim = len(sums)
    scatter = n * products - np.outer(np.array(sums, dtype=object), np.array(sums, dtype=object))  # n^2 times the covariance
    trace = int(np.trace(scatter))
    if not trace:
        return np.zeros((0, dim)), np.zeros(0), np.zeros(0)
    common = gcd(*(int(x) for x in scatter.ravel()))
    reduced = np.array([[int(x) // common for x in row] for row in scatter], dtype=object)
    vectors, values, shares = [], [], []
    for value, bits, times in largest_roots(characteristic_polynomial(spark, reduced), count):
        with localcontext() as context:
            context.prec = DIGITS
            exact = Decimal(value) / Decimal(1 << bits)
            eigenvalue, share = float(exact * common / (Decimal(n) * n)), float(exact * common / trace)
        found = null_space(reduced, exact, times)
        for v in found:
            vectors.append(v * (1 if v[np.abs(v).argmax()] > 0 else -1))
            values.append(eigenvalue)
            shares.append(share)
    return np.array(vectors[:count]), np.array(values[:count]), np.array(shares[:count])


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """((x - S / n) as doubles, sum over dimensions of (n x - S)^2, null beyond a long)."""
    if not len(y):
        return y.astype(np.float64), []
    most = max(int(np.abs(y).max()), 1) * n + max(abs(s) for s in sums)
    kind = np.int64 if most * most * y.shape[1] < 1 << 63 else object
    d = y.astype(kind) * n - np.array(sums, dtype=kind)
    total = (d * d).sum(axis=1)
    return (d / n).astype(np.float64), [int(t) if int(t) < 1 << 63 else None for t in total]


def whiten(df: DataFrame, column: str = "embedding", count: int = 8) -> DataFrame:
    """``df``'s rows with a usable vector, with ``whitening``: n, deviation, explained (shares), whitened (numbers), identity_error.

    An entry c counts as x = floor(1024 c), plus any constant, which cancels. Rows take no part whose vector is null, empty, holds null or
    non-finite entries, or has another length than most of the others (of equally many, the longer); |1024 c| above 2^62
    counts as that. ``whitened`` has up to ``count`` numbers: x - S / n projected on the components of the covariance
    (divisor n), largest eigenvalue first, over the square roots of the eigenvalues; components with eigenvalue zero are
    left out, so equal vectors, or one alone, give empty arrays. The entry of largest size of a component is positive.
    ``deviation`` is the exact sum of (n x - S)^2 (null beyond a long), ``identity_error`` the largest absolute entry of
    the covariance of ``whitened`` minus the identity, measured over all rows (0 without components). Repeated rows count
    each; a column ``whitening`` of ``df`` is replaced.

    Vectors are never shuffled: three scans add up lengths, exact products and products of the whitened numbers, whose
    sums (dim x dim) reach the driver; the rows are written in a fourth. Polynomials are reduced modulo primes in tasks.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c.lower() != "whitening"]
    usable = F.size(column) > 0
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(column).isNotNull() & usable & finite).select(F.struct(*keep).alias("row"), F.col(column).cast("array<double>").alias("vector"))
    kind = rows.schema["row"].dataType.simpleString()
    made = f"row {kind}, n long, deviation long, explained array<double>, whitened array<double>, identity_error double"
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        empty = spark.createDataFrame([], made)
        return empty.select("row.*", F.struct(*empty.columns[1:]).alias("whitening"))
    dim = common["dim"]
    rows = rows.where(F.size("vector") == dim)
    n, sums, products = moments(rows.select("vector"), dim)
    vectors, values, shares = components(spark, n, sums, products, count)
    scaled = (vectors / np.sqrt(values)[:, None]).T if len(values) else np.zeros((dim, 0))
    k = len(values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _deviations(_matrix(batch.column("vector"), dim), n, sums)[0] @ scaled
            total += w.sum(axis=0)
            square += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array([total.tolist(), *square.tolist()], pa.list_(pa.float64()))], names=["i", "sums"])

    error = 0.0
    if k:
        parts = rows.select("vector").mapInArrow(add, "i int, sums array<double>")
        added = parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # (k + 1) k rows
        table = np.zeros((k + 1, k))
        for r in added:
            table[r["i"], r["j"]] = r["v"] / n
        error = float(np.abs(table[1:] - np.outer(table[0], table[0]) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred, deviation = _deviations(_matrix(batch.column("vector"), dim), n, sums)
            size = batch.num_rows
            arrays: list[Any] = [batch.column("row"), pa.array([n] * size, pa.int64()), pa.array(deviation, pa.int64()), pa.array([shares.tolist()] * size, pa.list_(pa.float64())), pa.array((centred @ scaled).tolist(), pa.list_(pa.float64())), pa.array([error] * size, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n", "deviation", "explained", "whitened", "identity_error"])

    found = rows.mapInArrow(project, made)
    return found.select("row.*", F.struct("n", "deviation", "explained", "whitened", "identity_error").alias("whitening"))
