"""Operator 11: embedding whitening from an exact characteristic polynomial.

Vectors become whole numbers x = floor(256 * c).  The fit list is each distinct
x once: n vectors with per-dimension sums S.  Its scatter n * sum(x x') - S S'
(n^2 times the covariance) is an integer matrix, summed exactly on Spark.

The characteristic polynomial of the scatter is taken exactly: modulo each of
a list of primes by reduction to Hessenberg form (one Spark task per few
primes), then joined by the Chinese remainder theorem; one more prime checks
the result.  All roots are real, so the sign changes of the polynomial shifted
to a point count the roots above it (Descartes' rule is exact here): bisection
on dyadic points isolates the largest roots with their multiplicities and
narrows them to ``BITS`` bits below the largest possible root.  Each eigenvector
comes from inverse iteration on the scatter less its root, a Gaussian
elimination in whole-number fixed point, so that close roots cost no digits;
a root of multiplicity m gets m orthonormal vectors of its null space.  Roots
that agree to ``BITS`` bits count as one.

What the driver holds is bounded by the vector length d: the scatter, the
polynomial (d + 1 numbers of about d times 45 bits) and a few vectors; its
work grows with d^3 and does not grow with the rows.

Nulls and odd input: rows whose vector is null or holds null or non-finite
entries are dropped; a null ``vec_id`` is kept; all repeated rows are kept,
but count once in the fit.  Vectors of each length are a table of their own.
Entries beyond a long are held at its ends, as is a ``deviation``.  A component
whose eigenvalue is 0 (fewer distinct vectors than components, constant
dimensions) has ``whitened`` null and ``explained`` 0 (null if the trace is 0)
and no part in ``identity_error``, which is null if no component is left.
Vectors without entries have no components.  An empty table gives no rows.
Input columns named like an output column are replaced, others kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.llm.common import Scratch, read_table, without
from logscan.session import ship_package

SCALE = 256.0
TOP = 4
BITS = 256                # bits of a root below the largest possible one
WORK_BITS = 640           # fraction bits of the fixed-point elimination
PRIME_BELOW = 1 << 31     # products of two residues fit into 62 bits
PRIMES_PER_TASK = 8
LIMB = 32                 # partial sums travel as digits of 32 bits
LONG_MAX, LONG_MIN = (1 << 63) - 1, -(1 << 63)
WIDTHS = (np.int8, np.int16, np.int32, np.int64)


# ------------------------------------------------------------ whole vectors
def quantized(values: np.ndarray) -> np.ndarray:
    """floor(256 * c) as long, held to its range."""
    v = np.floor(SCALE * values.astype(np.float64))
    x = np.clip(v, -2.0**62, 2.0**62).astype(np.int64)
    x[v >= 2.0**63] = LONG_MAX
    x[v <= -(2.0**63)] = LONG_MIN
    inside = (np.abs(v) > 2.0**62) & (np.abs(v) < 2.0**63)
    x[inside] = [int(t) for t in v[inside]]
    return x


def usable_vectors(lists: pa.Array):
    """(row numbers, whole vectors as a matrix) of the usable lists, by length."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lens = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    first = np.cumsum(np.maximum(lens, 0)) - np.maximum(lens, 0)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    for d in np.unique(lens[lens >= 0]).tolist():
        rows = np.flatnonzero(lens == d)
        m = flat[first[rows][:, None] + np.arange(d)]
        fine = np.isfinite(m).all(axis=1)
        yield rows[fine], quantized(m[fine])


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in its narrowest width, after a byte that names it: one form
    per vector."""
    out = np.empty(len(x), dtype=object)
    low, high = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    left = np.ones(len(x), dtype=bool)
    for kind in WIDTHS:
        rows = np.flatnonzero(left & (low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max))
        left[rows] = False
        data, width = x[rows].astype(kind).tobytes(), np.dtype(kind).itemsize
        step = width * x.shape[1]
        out[rows] = [bytes([width]) + data[i * step:(i + 1) * step] for i in range(len(rows))]
    return out.tolist()


def unpacked(data: list[bytes]) -> np.ndarray:
    """The matrix of packed vectors of one length and width."""
    raw = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(len(data), -1)
    return np.ascontiguousarray(raw[:, 1:]).view(f"<i{data[0][0]}").astype(np.int64)


def packed_groups(column: pa.Array):
    """(row numbers, matrix) of a column of packed vectors."""
    data = column.to_pylist()
    groups = {}
    for i, v in enumerate(data):
        groups.setdefault((len(v), v[0]), []).append(i)
    for rows in groups.values():
        yield np.array(rows), unpacked([data[i] for i in rows])


def _pack_rows(column: str):
    def pack(batches):
        for batch in batches:
            for _, x in usable_vectors(batch.column(column)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], dtype=np.int32)),
                                                  pa.array(packed(x), pa.binary())], ["dim", "x"])
    return pack


# ------------------------------------------------------------- exact scatter
def _add_products(total: np.ndarray, x: np.ndarray) -> None:
    """total += x' x, exactly; float64 products while every sum stays below 2^53."""
    top = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    step = min(len(x), 2**53 // (top * top) if top else len(x))
    if step < 1:
        total += x.T.astype(object) @ x.astype(object)
        return
    for at in range(0, len(x), step):
        part = x[at:at + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)


def _limbs(value: int) -> list[int]:
    """Digits of 32 bits, the last one signed."""
    out = []
    while not -(1 << 62) < value < 1 << 62:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return out + [value]


def _partial_sums(batches):
    """(dim, i, j, limb, digit) of one partition: products i <= j, sums under
    j = -1 and the row count under i = -1."""
    state = {}
    for batch in batches:
        for _, x in packed_groups(batch.column("x")):
            d = x.shape[1]
            if d not in state:
                state[d] = [0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)]
            state[d][0] += len(x)
            state[d][1] += np.array([sum(c) for c in x.T.tolist()], dtype=object)
            _add_products(state[d][2], x)
    for d, (n, s, g) in state.items():
        cells = [(-1, -1, n), *((i, -1, int(v)) for i, v in enumerate(s)),
                 *((i, j, int(g[i, j])) for i in range(d) for j in range(i, d))]
        rows = [(i, j, k, digit) for i, j, v in cells for k, digit in enumerate(_limbs(v)) if digit]
        for at in range(0, len(rows), 1 << 16):
            part = list(zip(*rows[at:at + (1 << 16)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(part[0]), pa.int32()), *(pa.array(c, pa.int32()) for c in part[:3]),
                 pa.array(part[3], pa.int64())], ["dim", "i", "j", "limb", "digit"])


def exact_sums(distinct: DataFrame) -> dict:
    """{dim: (n, S, sum of x x')} of the distinct vectors, as Python numbers."""
    cells = (distinct.mapInArrow(_partial_sums, "dim int, i int, j int, limb int, digit long")
             .groupBy("dim", "i", "j", "limb").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")))
    out = {}
    for d, i, j, limb, digit in cells.collect():  # at most (d + 1)(d + 2) numbers of a few limbs
        n, s, g = out.setdefault(d, [0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)])
        value = int(digit) << (LIMB * limb)
        if i < 0:
            out[d][0] += value
        elif j < 0:
            s[i] += value
        else:
            g[i, j] += value
            if i != j:
                g[j, i] += value
    return out


# ------------------------------------------------- characteristic polynomial
def is_prime(n: int) -> bool:
    """Deterministic below 3.2e9: Miller and Rabin with bases 2, 3, 5, 7."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2^31 whose product exceeds ``2 * bound``, and one more."""
    out, product, at = [], 1, PRIME_BELOW
    while product <= 2 * bound:
        at -= 1
        if is_prime(at):
            out.append(at)
            product *= at
    at -= 1
    while not is_prime(at):
        at -= 1
    return [*out, at]


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``matrix`` modulo p, zero below its subdiagonal."""
    h = matrix.copy()
    d = len(h)
    for c in range(d - 2):
        rows = np.flatnonzero(h[c + 1:, c])
        if not len(rows):
            continue
        r = c + 1 + int(rows[0])
        if r != c + 1:
            h[[c + 1, r]] = h[[r, c + 1]]
            h[:, [c + 1, r]] = h[:, [r, c + 1]]
        inverse = pow(int(h[c + 1, c]), -1, p)
        f = h[c + 2:, c] * inverse % p
        h[c + 2:] = (h[c + 2:] - f[:, None] * h[c + 1][None, :]) % p
        # the same change of basis on the columns, product by product below 2^62
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2:] * f[None, :] % p).sum(axis=1)) % p
    return h


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo p of det(t - matrix), highest power last."""
    h = hessenberg(matrix, p)
    d = len(h)
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros(d + 1, dtype=np.int64)
        now[1:] = polys[k - 1, :-1]
        now = (now - h[k - 1, k - 1] * polys[k - 1]) % p
        run = 1
        for i in range(k - 1, 0, -1):
            run = run * int(h[i, i - 1]) % p
            if not run:
                break
            now = (now - (int(h[i - 1, k - 1]) * run % p) * polys[i - 1]) % p
        polys[k] = now
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Exact integer coefficients of det(t - scatter), highest power last.

    The scatter has no negative eigenvalue, so each coefficient is at most
    (1 + trace / d)^d in size (Maclaurin's inequality), which says how many
    primes are needed."""
    d = len(scatter)
    mean = -(-int(np.trace(scatter)) // d)
    primes = primes_for((1 + mean) ** d)
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in scatter])

    def run(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                m = np.array([[v % p for v in row] for row in shared.value], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()),
                                                  pa.array([polynomial_modulo(m, p)], pa.list_(pa.int64()))],
                                                 ["p", "c"])

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    found = dict(map(tuple, spark.createDataFrame([(p,) for p in primes], "p long")
                     .repartition(tasks, "p").mapInArrow(run, "p long, c array<long>").collect()))
    modulus, value = 1, [0] * (d + 1)
    for p in primes[:-1]:
        lift = pow(modulus, -1, p)
        value = [v + modulus * ((c - v) * lift % p) for v, c in zip(value, found[p])]
        modulus *= p
    value = [v - modulus if 2 * v > modulus else v for v in value]
    if [v % primes[-1] for v in value] != found[primes[-1]]:
        raise ArithmeticError("the characteristic polynomial fails its check prime")
    return value


# --------------------------------------------------------------------- roots
def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots of a polynomial with only real roots, with multiplicity,
    lie above at / 2^bits: the sign changes after a shift to that point."""
    d = len(poly) - 1
    c = [v << (bits * (d - k)) for k, v in enumerate(poly)]  # roots times 2^bits
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int, bits: int) -> int:
    total, shift = 0, 0
    for v in reversed(poly):
        total = total * at + (v << shift)
        shift += bits
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], top: int, bound: int, bits: int = BITS):
    """[(numerator, fraction bits, multiplicity)] of the largest positive
    roots, at least ``top`` of them with multiplicity if there are so many.
    ``bound`` is not below any root."""
    zeros = next(k for k, v in enumerate(poly) if v)
    poly = poly[zeros:]
    positive, out, seen = len(poly) - 1, [], 0
    ceiling = bound.bit_length()
    last = max(bits - ceiling, 16)
    while seen < min(top, positive):
        low, high, s = 0, 1 << ceiling, 0  # the wanted root is in (low, high] / 2^s
        above_low, above_high = positive, 0
        while high - low > 1 or s < last:
            if high - low == 1:
                low, high, s = 2 * low, 2 * high, s + 1
            mid = (low + high) // 2
            if above_low - above_high > 1:
                n = roots_above(poly, mid, s)
                if n > seen:
                    low, above_low = mid, n
                else:
                    high, above_high = mid, n
            # a single root: the sign at mid says on which side it lies
            elif _sign(poly, mid, s) * (-1) ** above_high >= 0:
                high = mid
            else:
                low = mid
        out.append((high, s, above_low - above_high))
        seen = above_low
    return out


# -------------------------------------------------------------- eigenvectors
def _solve(lower, upper, b, bits):
    """x with lower * upper * x = b, all with ``bits`` fraction bits."""
    x = list(b)
    for c, f in enumerate(lower):
        for k, v in enumerate(f):
            x[c + 1 + k] -= (v * x[c]) >> bits
    d = len(x)
    for i in range(d - 1, -1, -1):
        total = x[i] - (sum(int(a) * y for a, y in zip(upper[i, i + 1:], x[i + 1:])) >> bits)
        x[i] = (total << bits) // int(upper[i, i])
    return x


def null_space(scatter: np.ndarray, root: int, root_bits: int, many: int, bits: int = WORK_BITS) -> np.ndarray:
    """``many`` orthonormal vectors (rows) of the eigenvalue root / 2^root_bits,
    by inverse iteration in fixed point with ``bits`` fraction bits."""
    d = len(scatter)
    scale = max(1, max(abs(int(v)) for v in scatter.ravel()).bit_length())
    a = np.array([[(int(v) << bits) >> scale for v in row] for row in scatter], dtype=object)
    shift = (root << bits) >> (scale + root_bits)
    for i in range(d):
        a[i, i] -= shift
    lower, rows = [], []
    for c in range(d):
        r = c + max(range(d - c), key=lambda k: abs(a[c + k, c]))
        a[[c, r]] = a[[r, c]]
        if a[c, c] == 0:
            a[c, c] = 1  # an exact root: one unit of the last place instead
        f = np.array([(int(v) << bits) // int(a[c, c]) for v in a[c + 1:, c]], dtype=object)
        if len(f):
            a[c + 1:, c:] -= (f[:, None] * a[c, c:][None, :]) >> bits
        lower.append(f)
        rows.append(r)
    for c in range(d):  # multipliers in final row order
        for later in range(c + 1, d):
            k, r = later - c - 1, rows[later] - c - 1
            lower[c][[k, r]] = lower[c][[r, k]]
    order = list(range(d))
    for c, r in enumerate(rows):
        order[c], order[r] = order[r], order[c]
    def unit(v):
        """v less its parts along the basis, of length 1."""
        for _ in range(2):
            for u in basis:
                dot = sum(p * q for p, q in zip(u, v)) >> bits
                v = [p - ((dot * q) >> bits) for p, q in zip(v, u)]
        size = isqrt(sum(p * p for p in v))
        return [(p << bits) // size for p in v]

    rng = np.random.default_rng(11)
    basis = []
    for _ in range(many):
        v = [int(t) << bits for t in rng.integers(-(1 << 20), 1 << 20, d) * 2 + 1]
        for _ in range(3):
            v = unit(v)
            v = _solve(lower, a, [v[i] for i in order], bits)
        basis.append(unit(v))
    out = np.array([[p / (1 << bits) for p in v] for v in basis])
    flip = np.sign(out[np.arange(many), np.abs(out).argmax(axis=1)])
    return out * flip[:, None]


# ------------------------------------------------------------------- fitting
@dataclass
class Whitening:
    """A fitted transform for vectors of one length."""

    n: int
    sums: list            # exact per-dimension sums over the fit list
    components: np.ndarray  # unit rows, by falling eigenvalue
    eigenvalues: list     # of the covariance, float
    explained: list       # share of the trace, float or None
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> tuple[list, np.ndarray]:
        """(deviations, whitened) of whole vectors: centred exactly first."""
        top = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        small = 2 * self.n * max(top, 1) < 2**53 and all(abs(s) < 2**53 for s in self.sums)
        if small and (2 * self.n * max(top, 1)) ** 2 * max(1, x.shape[1]) < 2**62:
            centred = x * self.n - np.array(self.sums, dtype=np.int64)[None, :]
            deviation = np.square(centred).sum(axis=1).tolist()
        else:
            centred = x.astype(object) * self.n - np.array(self.sums, dtype=object)[None, :]
            deviation = [min(sum(int(v) * int(v) for v in row), LONG_MAX) for row in centred]
        values = np.array(centred / self.n, dtype=np.float64)
        roots = np.sqrt(np.array(self.eigenvalues, dtype=np.float64))
        with np.errstate(divide="ignore", invalid="ignore"):
            return deviation, np.einsum("rd,kd->rk", values, self.components) / roots[None, :]


def fit_exact(spark: SparkSession, n: int, sums, products: np.ndarray, components: int = TOP) -> Whitening:
    """Largest eigenvalues and eigenvectors of the covariance, from exact sums."""
    d = len(sums)
    scatter = n * products - np.outer(sums, sums)
    trace = int(np.trace(scatter))
    want = min(components, d)
    if not trace:
        return Whitening(n, list(sums), np.zeros((want, d)), [0.0] * want, [None] * want)
    poly = characteristic_polynomial(spark, scatter)
    vectors, values = [], []
    for root, bits, many in largest_roots(poly, want, trace):
        vectors.extend(null_space(scatter, root, bits, min(many, want - len(values))))
        values.extend([(root, bits)] * min(many, want - len(values)))
    missing = want - len(values)
    return Whitening(n, list(sums), np.array([*vectors, *np.zeros((missing, d))]),
                     [r / (n * n << b) for r, b in values] + [0.0] * missing,
                     [r / (trace << b) for r, b in values] + [0.0] * missing)


_RESULT = pa.struct([("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64())),
                     ("explained", pa.list_(pa.float64())), ("identity_error", pa.float64())])


def _applied(models: dict, n_rows: int, groups) -> pa.StructArray:
    """Result rows of the vectors in ``groups``; null for other rows."""
    size = np.zeros(n_rows, dtype=np.int64)
    parts = [(models[x.shape[1]], rows, x) for rows, x in groups if len(rows)]
    for model, rows, _ in parts:
        size[rows] = len(model.eigenvalues)
    offsets = np.concatenate([[0], np.cumsum(size)])
    n, deviation = np.zeros(n_rows, dtype=np.int64), np.zeros(n_rows, dtype=np.int64)
    whitened, explained = np.full(offsets[-1], np.nan), np.full(offsets[-1], np.nan)
    error, missing = np.full(n_rows, np.nan), np.ones(n_rows, dtype=bool)
    for model, rows, x in parts:
        missing[rows] = False
        n[rows] = model.n
        deviation[rows], w = model.project(x)
        at = offsets[rows][:, None] + np.arange(len(model.eigenvalues))
        whitened[at] = np.where(np.array(model.eigenvalues) > 0, w, np.nan)
        explained[at] = np.array(model.explained, dtype=np.float64)  # None becomes NaN, as null below
        error[rows] = np.nan if model.identity_error is None else model.identity_error

    def lists(values):
        return pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(values, mask=np.isnan(values)))

    return pa.StructArray.from_arrays([pa.array(n), pa.array(deviation), lists(whitened), lists(explained),
                                       pa.array(error, mask=np.isnan(error))], fields=list(_RESULT),
                                      mask=pa.array(missing))


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = TOP) -> dict:
    """{vector length: Whitening} of a table of vectors."""
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "whitening")
    distinct = scratch.save(vectors.select(column).mapInArrow(_pack_rows(column), "dim int, x binary").distinct(),
                            "distinct")
    models = {d: fit_exact(spark, n, s, g, components) for d, (n, s, g) in exact_sums(distinct).items()}
    shared = spark.sparkContext.broadcast(models)

    @F.arrow_udf("array<double>")
    def coordinates(x: pa.Array) -> pa.Array:
        return _applied(shared.value, len(x), packed_groups(x)).field("whitened")

    white = distinct.select("dim", coordinates("x").alias("whitened"))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    sums = white.groupBy("dim").agg(*[
        F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs])
    for row in sums.collect():  # one row per vector length
        model = models[row["dim"]]
        errors = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs
                  if j < len(model.eigenvalues) and model.eigenvalues[i] > 0 and model.eigenvalues[j] > 0]
        model.identity_error = max(errors, default=None)
    return models


NEW = ("n", "deviation", "whitened", "explained", "identity_error")


def whiten(vectors: DataFrame, models: dict, column: str = "embedding") -> DataFrame:
    """``vectors`` without its unusable rows, with n, deviation, the whitened
    coordinates and the explained shares (arrays by component) and
    identity_error."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    def applied(lists: pa.Array) -> pa.Array:
        return _applied(shared.value, len(lists), usable_vectors(lists))

    usable = (f"`{column}` IS NOT NULL AND forall(`{column}`, c -> c IS NOT NULL AND NOT isnan(c) "
              "AND abs(double(c)) < double('Infinity'))")
    names = without(vectors, (*NEW, "_applied"))
    return (vectors.where(usable).withColumn("_applied", applied(F.col(f"`{column}`")))
            .select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_applied.{c}").alias(c) for c in NEW]))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the four largest components, one row each."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = whiten(vectors, fit_whitening(vectors))
    return rows.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("k", "whitened")) \
        .select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened",
                F.get("explained", F.col("k")).alias("explained"), "identity_error")
