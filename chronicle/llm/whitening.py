"""Principal components and whitening of embeddings by exact arithmetic.

Vectors are rounded to whole numbers, so their scatter matrix is exact. Its
characteristic polynomial is found modulo many primes, one prime at a time in
Spark tasks, and put together by Chinese remaindering. Roots are isolated by
counting sign changes, and components come from inverse iteration at a root.
"""

from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicle.shared import staged

SCALE = 256
COMPONENTS = 4
#: Significant bits of a root, and decimal digits of the arithmetic on components.
ROOT_BITS = 160
DIGITS = 100
#: Entries are multiplied in pieces of so many bits; sums of 2 ** 12 products are then exact in doubles.
_PIECE, _ROWS = 20, 1 << 12
#: Exact sums travel in pieces of so many bits, which add up in a long over millions of tasks.
_PART = 40


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums``; ``roots`` of the scatter n * sum(x x') - S S' are n * n times the
    eigenvalues of the covariance. Its size depends on the vectors' length only."""

    n: int
    sums: list[int]
    roots: list[Decimal]
    vectors: np.ndarray
    trace: int


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(values * float(SCALE)) + 0.0


def integer_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the floor of 256 times each entry, of the rows that can be used.

    Left out are vectors that are null, empty, hold null or non-finite entries or
    ones whose ``x`` is beyond a long, and, as they cannot share a covariance,
    those whose length is not the commonest one (of equally common ones the largest).
    """

    def rounded(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            values = lists.flatten()
            own = pc.list_parent_indices(lists).to_numpy()
            x = _whole(values.cast(pa.float64()).to_numpy(zero_copy_only=False))
            with np.errstate(invalid="ignore"):
                bad = ~(np.abs(x) < 2.0**62)
            lengths = np.bincount(own, minlength=len(lists))
            good = (lengths > 0) & (np.bincount(own[bad], minlength=len(lists)) == 0)
            kept = x[good[own]].astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(lengths[good]))).astype(np.int32)
            yield pa.record_batch([ids.filter(pa.array(good)), pa.ListArray.from_arrays(pa.array(ends), pa.array(kept))], ["vec_id", "x"])

    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    vectors = staged(rows.mapInArrow(rounded, "vec_id long, x array<long>"), "whole-vectors")
    length = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return vectors.where(F.size("x") == (length.d if length else 0))


def _matrix(lists: pa.Array) -> np.ndarray:
    values = lists.flatten().to_numpy()
    return values.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _gram(x: np.ndarray) -> np.ndarray:
    """The exact products of all columns, Python integers."""
    pieces, most = [], int(np.abs(x).max())
    while most >> _PIECE:
        pieces.append(x & ((1 << _PIECE) - 1))
        x, most = x >> _PIECE, most >> _PIECE
    pieces = [p.astype(np.float64) for p in [*pieces, x]]
    total = 0
    for a, left in enumerate(pieces):
        for b, right in enumerate(pieces):
            total = total + ((left.T @ right).astype(np.int64).astype(object) << (_PIECE * (a + b)))
    return total


def _scatter_parts(batches):
    """Rows ``i, j, part, value``: products of each vector with a leading 1, summed over a task."""
    total = 0
    for batch in batches:
        x = _matrix(batch.column(0))
        for start in range(0, len(x), _ROWS):
            some = x[start : start + _ROWS]
            total = total + _gram(np.hstack((np.ones((len(some), 1), np.int64), some)))
    if isinstance(total, int):
        return
    rows = []
    for i, j in zip(*np.triu_indices(len(total))):
        value, part = total[i, j], 0
        while not -(1 << _PART) <= value < 1 << _PART:
            rows.append((i, j, part, value & ((1 << _PART) - 1)))
            value, part = value >> _PART, part + 1
        rows.append((i, j, part, value))
    yield pa.RecordBatch.from_arrays([pa.array([int(r[k]) for r in rows], pa.int64()) for k in range(4)], ["i", "j", "part", "value"])


def _scatter(fit_list: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums, and n * sum(x x') - S S'. What the driver gets has the size of the matrix."""
    parts = fit_list.select("x").mapInArrow(_scatter_parts, "i long, j long, part long, value long")
    rows = parts.groupBy("i", "j", "part").agg(F.sum("value").alias("value")).collect()
    if not rows:
        return 0, [], []
    d = max(r.j for r in rows) + 1
    products = [[0] * d for _ in range(d)]
    for r in rows:
        products[r.i][r.j] += r.value << (_PART * r.part)
    n, sums = products[0][0], products[0][1:]
    scatter = [[n * products[min(i, j)][max(i, j)] - sums[i - 1] * sums[j - 1] for j in range(1, d)] for i in range(1, d)]
    return n, sums, scatter


def _primes(above: int) -> list[int]:
    """The largest primes under 2 ** 31 whose product exceeds ``above``."""

    def prime(n):
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        # These three bases decide every number under 2 ** 32.
        for base in (2, 7, 61):
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

    found, product, n = [], 1, (1 << 31) - 1
    while product <= above:
        if prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def _polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo a prime, highest power first.

    The matrix is brought to Hessenberg form by similarities; polynomials of
    its leading blocks follow from one another.
    """
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for m in range(1, d - 1):
        pivots = np.flatnonzero(h[m:, m - 1])
        if not len(pivots):
            continue
        at = m + pivots[0]
        if at != m:
            h[[m, at]] = h[[at, m]]
            h[:, [m, at]] = h[:, [at, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    blocks = np.zeros((d + 1, d + 1), np.int64)  # by size of the block, lowest power first
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - (weights[:, None] * blocks[:k] % p).sum(axis=0)) % p
    return blocks[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - ``matrix``), highest power first, of a positive semidefinite matrix of integers.

    Coefficient k is, but for its sign, a sum of products of k eigenvalues; all
    of them together stay under (1 + trace / d) ** d. Each prime is a row that
    some task works on; a row returns d + 1 residues.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    primes = _primes((1 - (-trace // d)) ** d)
    texts = [[str(v) for v in row] for row in matrix]

    def residues(batches):
        own = [[int(v) for v in row] for row in texts]
        for batch in batches:
            ps = batch.column(0).to_pylist()
            rows = [_polynomial_modulo(own, p) for p in ps]
            yield pa.record_batch([pa.array(ps, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["p", "residues"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(residues, "p long, residues array<long>").collect()
    whole = prod(primes)
    shares = [whole // r.p * pow(whole // r.p, -1, r.p) for r in rows]
    found = []
    for k in range(d + 1):
        sign = -1 if k % 2 else 1  # what stands behind it is not negative
        value = sum(share * (sign * r.residues[k]) for share, r in zip(shares, rows)) % whole
        found.append(sign * value)
    return found


def _roots_above(poly: list[int], at: int, bits: int) -> int:
    """Number of roots above ``at`` / 2 ** ``bits``, repeated ones counted as often, of a polynomial that has only
    real roots: the sign changes of its coefficients moved to that place."""
    a = [c << (bits * k) for k, c in enumerate(poly)]
    for stop in range(len(a) - 1, 0, -1):
        for k in range(1, stop + 1):
            a[k] += at * a[k - 1]
    signs = [c > 0 for c in a if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int, bits: int) -> int:
    value = 0
    for k, c in enumerate(poly):
        value = value * at + (c << (bits * k))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, precision: int = ROOT_BITS) -> list[tuple[int, int]]:
    """The ``count`` largest roots, falling, as ``(a, b)``: the root lies in (a - 1, a] / 2 ** b.

    All roots are real and not negative, and ``count`` of them are positive.
    Ranges are halved by counting roots until one is alone in its range, then by
    the polynomial's sign; repeated roots are counted to the end.
    """
    top = -poly[1]  # the sum of all roots
    found = []
    for k in range(1, count + 1):
        bits, low, high, low_count, high_count = 0, 0, top, None, 0
        while high - low > 1 or high.bit_length() <= precision:
            if high - low == 1:
                bits, low, high = bits + 64, low << 64, high << 64
            middle = (low + high) // 2
            if low_count == k and high_count == k - 1:
                # Above all roots the sign is plus; it turns at each.
                above = _sign(poly, middle, bits) * (-1) ** (k - 1) < 0
            else:
                n = _roots_above(poly, middle, bits)
                above = n >= k
                low_count, high_count = (n, high_count) if above else (low_count, n)
            low, high = (middle, high) if above else (low, middle)
        found.append((high, bits))
    return found


def _solver(matrix: list[list[int]], shift: Decimal):
    """Solves (matrix - shift) y = b by elimination with row exchanges; a vanishing pivot is made tiny."""
    d = len(matrix)
    rows = [[Decimal(v) - shift if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    tiny = (abs(shift) + 1).scaleb(-DIGITS)
    order = list(range(d))
    for k in range(d):
        at = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[at], order[k], order[at] = rows[at], rows[k], order[at], order[k]
        if abs(rows[k][k]) < tiny:
            rows[k][k] = tiny
        pivot = rows[k]
        for i in range(k + 1, d):
            row = rows[i]
            if row[k]:
                f = row[k] = row[k] / pivot[k]
                for j in range(k + 1, d):
                    row[j] -= f * pivot[j]

    def solve(b):
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum((rows[i][j] * y[j] for j in range(i)), Decimal(0))
        for i in range(d - 1, -1, -1):
            y[i] = (y[i] - sum((rows[i][j] * y[j] for j in range(i + 1, d)), Decimal(0))) / rows[i][i]
        return y

    return solve


def _unit(v: list[Decimal], against: list[list[Decimal]]) -> list[Decimal]:
    """``v`` without its parts along earlier unit vectors, scaled to length 1."""
    for u in against:
        along = sum((a * b for a, b in zip(u, v)), Decimal(0))
        v = [b - along * a for a, b in zip(u, v)]
    length = sum((a * a for a in v), Decimal(0)).sqrt()
    return [a / length for a in v]


def eigenvectors(matrix: list[list[int]], roots: list[Decimal]) -> list[list[Decimal]]:
    """A unit vector for each root, orthogonal to those before, largest entry positive.

    Inverse iteration: a step multiplies the wanted direction by one over the
    root's tiny error. Repeated roots get independent vectors, as each is kept
    clear of those found before.
    """
    d, found, solvers = len(matrix), [], {}
    for k, root in enumerate(roots):
        if root not in solvers:
            solvers = {root: _solver(matrix, root)}
        # Any start that is not orthogonal to the component will do; this one is spread over all directions.
        v = _unit([Decimal(1 + (i * i * 7919 + (i + 1) * (k + 1) * 104729) % 1009) for i in range(d)], found)
        for _ in range(4):
            v = _unit(solvers[root](v), found)
        v = _unit(v, found)
        largest = max(v, key=abs)
        found.append([-a for a in v] if largest < 0 else v)
    return found


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors of ``x``, and these, stored.

    Components with eigenvalue 0 are left out, so there may be fewer than
    ``components``, or none: without rows, or with equal rows only.
    """
    fit_list = staged(vectors.select("x").distinct(), "distinct-vectors")
    n, sums, scatter = _scatter(fit_list)
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    if not trace:
        return Whitening(n, sums, [], np.zeros((0, len(sums))), 0), fit_list
    poly = characteristic_polynomial(vectors.sparkSession, scatter)
    rank = max(k for k, c in enumerate(poly) if c)
    with localcontext() as context:
        context.prec = DIGITS
        roots = [Decimal(a) / (1 << bits) for a, bits in largest_roots(poly, min(components, rank))]
        found = eigenvectors(scatter, roots)
    return Whitening(n, sums, roots, np.array([[float(a) for a in v] for v in found]), trace), fit_list


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs where they suffice, else Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors`` with ``deviation``, the exact squared length of n * x - S (null where a long cannot hold it),
    and ``whitened``, an entry for each component."""
    n, sums = model.n, model.sums
    scaled = model.vectors / np.array([[float(r.sqrt())] for r in model.roots]).reshape(-1, 1)

    def projected(batches):
        for batch in batches:
            away = _differences(_matrix(batch.column(1)), n, sums)
            squared = (away * away).sum(axis=1) if len(away) else []
            deviation = pa.array([int(v) if v < 1 << 63 else None for v in squared], pa.int64())
            values = away.astype(np.float64) @ scaled.T if len(away) else np.zeros((0, len(scaled)))
            ends = np.arange(len(away) + 1, dtype=np.int32) * len(scaled)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).reshape(-1)))
            yield pa.record_batch([batch.column(0), deviation, lists], ["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "x").mapInArrow(projected, "vec_id long, deviation long, whitened array<double>")


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    own = whitened(fit_list.withColumn("vec_id", F.lit(0).cast("long")), model)
    w = staged(own.select("whitened"), "whitened")
    size = range(len(model.roots))
    means = w.agg(*[F.avg(F.col("whitened")[i]) for i in size]).first()
    centred = [F.col("whitened")[i] - F.lit(means[i]) for i in size]
    pairs = [(i, j) for i in size for j in size if i <= j]
    products = w.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(products, pairs))


def whitening_rows(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector of ``df`` and component (from 1): ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    Repeated rows and rows without an id are each returned. Tables without a
    usable vector, or whose vectors are all equal, have no component and so no
    rows. Other columns are not read.
    """
    vectors = integer_vectors(df, column)
    model, fit_list = fit(vectors, components)
    if not model.roots:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    shares = F.array(*[F.lit(float(r / model.trace)) for r in model.roots])
    error = identity_error(fit_list, model)
    rows = whitened(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "value"))
    return rows.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        shares[F.col("k")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
