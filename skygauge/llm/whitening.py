"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Vectors are integers.  Their scatter n * sum(x x') - S S' is a matrix of integers, n
squared times the covariance, and its characteristic polynomial has integer
coefficients: these are found modulo many primes, by reduction to Hessenberg form, and
put together by the Chinese remainder theorem.  All roots are real, so that the sign
changes of the polynomial shifted by t count the roots above t exactly (Descartes);
bisection on this count isolates the greatest roots, repeated ones included, and the
sign of the polynomial alone refines a root that is single.  A component spans the
null space of scatter - root: inverse iteration in high precision finds it.

Spark sums the scatter over all distinct vectors, one partial sum for each task, reduces
modulo primes in tasks, and projects the rows.  Only the d x d scatter and the
polynomial's residues reach the driver, whatever the number of rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge.llm.common import slices, stored
from skygauge.llm.vectors import EXACT, integer_vectors, largest, matrix

#: Components by falling eigenvalue.
COMPONENTS = 4
#: Leading bits to which a root is refined, and decimal digits of the inverse iteration
#: beyond those of the scatter's entries.
ROOT_BITS, DIGITS = 160, 70
#: Rows that a task multiplies at once.
ROWS = 4096


# --- the scatter ----------------------------------------------------------------

def _moments(x: np.ndarray) -> np.ndarray:
    """Sums of all products of two columns of [x, 1], as Python integers."""
    wide = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    most = max(1, largest(wide)) ** 2
    if most >= EXACT:
        return wide.astype(object).T @ wide.astype(object)
    total = np.zeros((wide.shape[1],) * 2, object)
    step = max(1, min(ROWS, (EXACT - 1) // most))
    for start in range(0, len(wide), step):
        some = wide[start: start + step].astype(np.float64)
        total += (some.T @ some).astype(np.int64)
    return total


@dataclass(frozen=True)
class Scatter:
    """n vectors, their sums by dimension, and n * sum(x x') - S S'."""

    n: int
    sums: list[int]
    values: list[list[int]]

    @property
    def trace(self) -> int:
        return sum(row[i] for i, row in enumerate(self.values))


def scatter(fit: DataFrame) -> Scatter:
    """Of the column ``x`` of all rows, exact."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, ROWS):
            found = _moments(matrix(batch.column(0)))
            total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]])],
                ["i", "j", "s"])

    rows = fit.select("x").mapInArrow(add, "i int, j int, s string").groupBy("i", "j").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # (d + 1) (d + 2) / 2 rows
    if not rows:
        return Scatter(0, [], [])
    d = max(r["i"] for r in rows)
    found = {(r["i"], r["j"]): int(r["s"]) for r in rows}
    n, sums = found[d, d], [found[i, d] for i in range(d)]
    return Scatter(n, sums, [[n * found[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)]
                             for i in range(d)])


# --- the characteristic polynomial ------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide all n below 3.2 billion."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if n == base:
            return True
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, greatest first, whose product is greater than ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix of zeros below the subdiagonal that is similar to ``a`` modulo p."""
    h = a.copy()
    for k in range(len(h) - 2):
        nonzero = np.flatnonzero(h[k + 1:, k])
        if not len(nonzero):
            continue
        pivot = k + 1 + int(nonzero[0])
        if pivot != k + 1:
            h[[pivot, k + 1]] = h[[k + 1, pivot]]
            h[:, [pivot, k + 1]] = h[:, [k + 1, pivot]]
        factors = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factors[:, None] * h[k + 1] % p) % p
        # Products are reduced before they are summed: at most d summands below 2^31.
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factors % p).sum(axis=1)) % p
    return h


def characteristic_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo p, the constant first."""
    h, d = hessenberg(a, p), len(a)
    known = np.zeros((d + 1, d + 1), np.int64)  # of the leading k rows and columns
    known[0, 0] = 1
    for k in range(1, d + 1):
        known[k, 1:] = known[k - 1, :-1]
        below, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
        known[k] = (known[k] - (weights[:, None] * known[:k] % p).sum(axis=0)) % p
    return known[d]


def coefficient_bound(found: Scatter) -> int:
    """No coefficient is greater: the k-th is a symmetric function of roots that are not
    negative and sum to the trace, so at most binomial(d, k) (trace / d)^k."""
    d = len(found.values)
    return max(math.comb(d, k) * found.trace ** k // d ** k + 1 for k in range(d + 1))


def chinese_remainder(residues: dict[int, list[int]]) -> list[int]:
    """The integers nearest to zero with the residues of each prime."""
    product = math.prod(residues)
    answer = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = product // p
        unit = rest * pow(rest, -1, p)
        answer = [(a + unit * v) % product for a, v in zip(answer, values, strict=True)]
    return [a - product if 2 * a > product else a for a in answer]


def characteristic_polynomial(spark: SparkSession, found: Scatter) -> list[int]:
    """Coefficients of det(x - scatter), the highest first; primes are shared out to tasks."""
    values = found.values

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(values, dtype=object)
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            rows = [characteristic_modulo((whole % p).astype(np.int64), p).tolist() for p in numbers]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["p", "c"])

    primes = primes_beyond(2 * coefficient_bound(found))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").mapInArrow(reduce, "p long, c array<long>").collect()
    return chinese_remainder({r["p"]: r["c"] for r in rows})[::-1]


# --- its greatest roots ------------------------------------------------------------

def roots_above(polynomial: list[int], t: int) -> int:
    """Roots greater than t of a polynomial whose roots are all real: the sign changes
    of its coefficients at x + t."""
    shifted = list(polynomial)
    for stop in range(len(shifted), 1, -1):
        carried = shifted[0]
        for j in range(1, stop):
            carried = shifted[j] = shifted[j] + t * carried
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value_at(polynomial: list[int], t: int) -> int:
    total = 0
    for c in polynomial:
        total = total * t + c
    return total


def scaled(polynomial: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times as great."""
    return [c << bits * k for k, c in enumerate(polynomial)]


def root(polynomial: list[int], k: int, low: int, high: int) -> int:
    """The least integer that is not below the k-th greatest root, which is in (low, high]."""
    above, beyond = roots_above(polynomial, low), roots_above(polynomial, high)
    while high - low > 1:
        middle = (low + high) // 2
        if above - beyond == 1:
            # One root in (low, high]: its side follows from the sign at the middle.
            value = value_at(polynomial, middle)
            right = value != 0 and (value > 0) == (beyond % 2 == 1)
            low, high = (middle, high) if right else (low, middle)
            continue
        count = roots_above(polynomial, middle)
        if count >= k:
            low, above = middle, count
        else:
            high, beyond = middle, count
    return high


def greatest_roots(polynomial: list[int], count: int, guesses: list[float]) -> list[tuple[int, int]]:
    """(m, bits) of the greatest roots above zero, each m / 2^bits to ``ROOT_BITS`` leading bits.

    ``guesses`` only narrow where a root is looked for; the count of roots decides.
    """
    rank = len(polynomial) - 1
    while rank and polynomial[rank] == 0:
        rank -= 1  # as many roots are zero as coefficients at the end
    body, answer = polynomial[: rank + 1], []
    bound = 1 - min(0, body[1]) if rank else 1  # above their sum, which is minus the second coefficient
    for k in range(1, min(count, rank) + 1):
        bits = max(0, ROOT_BITS - max(0, int(max(guesses[k - 1], 1.0)).bit_length()))
        while True:
            wide = scaled(body, bits)
            guess = int(Decimal(max(guesses[k - 1], 0.0)) * (1 << bits))
            low, high = guess - (guess >> 30) - 1, guess + (guess >> 30) + 1
            if low < 0 or roots_above(wide, low) < k or roots_above(wide, high) >= k:
                low, high = 0, bound << bits
            m = root(wide, k, low, high)
            if m.bit_length() >= ROOT_BITS:
                break
            bits += ROOT_BITS - m.bit_length() + 8  # a small root: finer steps
        answer.append((m, bits))
    return answer


# --- components ----------------------------------------------------------------------

def _solver(a: list[list[Decimal]], tiny: Decimal):
    """Solves a v = b by triangular factors with pivoting; a zero pivot counts as ``tiny``."""
    d, rows, order = len(a), [list(r) for r in a], list(range(len(a)))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot], order[k], order[pivot] = rows[pivot], rows[k], order[pivot], order[k]
        head = rows[k]
        if abs(head[k]) < tiny:
            head[k] = tiny
        for i in range(k + 1, d):
            row = rows[i]
            if row[k]:
                row[k] = f = row[k] / head[k]
                row[k + 1:] = [x - f * y for x, y in zip(row[k + 1:], head[k + 1:], strict=True)]

    def solve(b: list[Decimal]) -> list[Decimal]:
        v = [b[i] for i in order]
        for i in range(d):
            v[i] -= sum(x * y for x, y in zip(rows[i][:i], v[:i], strict=True))
        for i in range(d - 1, -1, -1):
            v[i] = (v[i] - sum(x * y for x, y in zip(rows[i][i + 1:], v[i + 1:], strict=True))) / rows[i][i]
        return v

    return solve


def _unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    """Orthogonal to the others, of length 1."""
    for _ in range(2):
        for u in others:
            along = sum(x * y for x, y in zip(u, v, strict=True))
            v = [x - along * y for x, y in zip(v, u, strict=True)]
    length = sum(x * x for x in v).sqrt()
    return [x / length for x in v]


def null_vectors(values: list[list[int]], roots: list[tuple[int, int]]) -> list[list[Decimal]]:
    """A unit vector of the null space of values - root for each root, orthogonal to the ones
    before it; its entry of greatest size is positive."""
    digits = DIGITS + max(len(str(abs(v))) for row in values for v in row)
    found: list[list[Decimal]] = []
    with decimal.localcontext(prec=digits):
        for m, bits in roots:
            at = Decimal(m) / (1 << bits)
            shifted = [[Decimal(v) - at if i == j else Decimal(v) for j, v in enumerate(row)]
                       for i, row in enumerate(values)]
            solve = _solver(shifted, at.scaleb(-digits))
            # Whatever the matrix, some start of this family is not orthogonal to the null space.
            v = _unit([Decimal(1) / (1 + (7 * i + 3 * len(found)) % 23) + i for i in range(len(values))], found)
            for _ in range(12):
                after = _unit(solve(v), found)
                moved = min(max(abs(x - s * y) for x, y in zip(after, v, strict=True)) for s in (1, -1))
                v = after
                if moved < Decimal(10) ** -25:
                    break
            sign = 1 if max(v, key=abs) > 0 else -1
            found.append([sign * x for x in v])
    return found


@dataclass(frozen=True)
class Whitening:
    """What a row's coordinates are made with: axes are unit vectors over root(eigenvalue) n."""

    n: int
    sums: list[int]
    axes: list[list[float]]
    explained: list[float]


def whitening(spark: SparkSession, found: Scatter, count: int = COMPONENTS) -> Whitening:
    """Up to ``count`` components; directions in which nothing varies have none."""
    if not found.trace:
        return Whitening(found.n, found.sums, [], [])
    guesses = np.linalg.eigvalsh(np.array([[float(v) for v in row] for row in found.values]))[::-1].tolist()
    roots = greatest_roots(characteristic_polynomial(spark, found), count, guesses)
    vectors = null_vectors(found.values, roots)
    with decimal.localcontext(prec=60):
        sizes = [Decimal(m) / (1 << bits) for m, bits in roots]
        return Whitening(
            found.n, found.sums,
            [[float(x / e.sqrt()) for x in v] for v, e in zip(vectors, sizes, strict=True)],
            [float(e / found.trace) for e in sizes])


# --- rows --------------------------------------------------------------------------

def project(rows: DataFrame, known: Whitening) -> DataFrame:
    """vec_id, deviation, w (coordinates by component) of each row of (vec_id, x)."""
    n, sums, axes = known.n, known.sums, known.axes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = np.array(axes).T
        for batch in slices(batches, ROWS):
            x = matrix(batch.column(1))
            small = x.shape[1] * (n * largest(x) + max(map(abs, sums))) ** 2 < 1 << 63
            away = x * n - np.array(sums) if small else x.astype(object) * n - np.array(sums, dtype=object)
            squares = (away * away).sum(axis=1).tolist()
            places = away.astype(np.float64) @ directions
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * places.shape[1], pa.int32()),
                                          pa.array(places.ravel()))], ["vec_id", "deviation", "w"])

    return rows.select("vec_id", "x").mapInArrow(place, "vec_id long, deviation long, w array<double>")


def identity_error(fit: DataFrame, known: Whitening) -> float:
    """Greatest absolute entry of the coordinates' covariance over the fit list, less the identity."""
    count = len(known.axes)
    placed = project(fit.select(F.lit(None).cast("long").alias("vec_id"), "x"), known)
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = placed.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def whiten(embeddings: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row.

    Entries become floor(256 * entry).  The fit list holds each distinct vector once;
    n is its length.  Rows with a null vector, a null or non-finite entry, or another
    length than most are left out (see ``integer_vectors``).  Repeated rows and null
    vec_ids are answered row by row.  Components are numbered from 1 by falling
    eigenvalue; equal eigenvalues share their space in any orthogonal way.  A direction
    in which the vectors do not differ has no coordinate: with less than ``count``
    others there are fewer components, and none for a single or repeated vector or an
    empty table.  ``deviation`` is null where it does not fit a long.  Other columns
    are not read.
    """
    spark = embeddings.sparkSession
    rows = integer_vectors(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector), vector)
    fit = stored(rows.select("x").distinct(), "distinct-vectors").table
    known = whitening(spark, scatter(fit), count)
    kinds = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
    if not known.axes:
        return spark.createDataFrame([], kinds)
    error = identity_error(fit, known)
    shares = F.array(*[F.lit(s) for s in known.explained])
    return project(rows, known).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(known.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
