"""Embedding whitening with a covariance found by polarisation.

Entries become integers x = floor(64 * c) + 1000000. One pass sums every
dimension; a second sums, exactly, the squares of the centred values of every
dimension i and of the sum of every pair of dimensions i < j. Since
var(i + j) = var(i) + var(j) + 2 cov(i, j), differences of these variances give all
cross-covariances. The matrix (dimensions squared, whatever the number of rows) is decomposed by
``eigh`` on the driver; every vector is then projected on the first components
and scaled to unit variance. A further pass measures the covariance of the
whitened values against the identity.

Exactness: x is centred by the whole part of its mean, m = floor(S / n), z = x - m.
With r = S - n * m, the sum of (n * x - S)^2 is n^2 * sum(z^2) - n * r^2, so only sums
of small integers are needed; they are 64-bit integers within a batch where
that cannot overflow, else Python integers, and decimals in Spark.

Defined results: a vector that is null, empty, or holds null, non-finite or very large (2^34 or
more) entries is dropped, so is one whose length differs from the most frequent length (the longer one on a
tie); a null vec_id is kept; repeated rows are vectors of their own; components without variance (rank
deficiency) cannot be scaled and are left out; a deviation beyond a long is null; other columns
are ignored; an empty table, or one without a usable vector, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, stored, table

SCALE, OFFSET, COMPONENTS, LARGEST = 64, 1_000_000, 32, float(1 << 34)
SLICE = 4096  # vectors at a time
SINGULAR = 1e-12  # of the largest eigenvalue: below that a component has no variance


def fixed_points(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x): the usable vectors of the most frequent length, as integers; stored."""
    src = pick(vectors, id=id_col, v=vec_col).select("id", F.col("v").cast("array<double>").alias("v"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            whole = batch.filter(pc.is_valid(batch.column(1)))
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                lists = part.column(1)
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                value = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
                bad = ~(np.abs(value) < LARGEST)
                row = np.repeat(np.arange(len(size)), size)
                usable = (np.bincount(row[bad], minlength=len(size)) == 0) & (size > 0)
                x = np.floor(SCALE * value[usable[row]]).astype(np.int64) + OFFSET
                ends = np.concatenate([[0], np.cumsum(size[usable])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(pa.array(usable)), pa.array(size[usable].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(x))], ["id", "dims", "x"])

    kind = src.schema["id"].dataType.simpleString()
    made = stored(src.mapInArrow(run, f"id {kind}, dims int, x array<bigint>"), "whitening-points")
    most = made.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    return made.where(F.col("dims") == (most["dims"] if most else -1)).select("id", "x")


def _rows(batches: Iterator) -> Iterator:
    """(ids, matrix of x) in slices."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)


def _exact(values, most: int):
    """``values`` as Python integers where a result of up to ``most`` could leave 64 bits."""
    return values if most < 1 << 62 else values.astype(object)


def _summed(parts: DataFrame) -> list:
    """One row (i, j, n, total) a pair: at most dimensions * (dimensions + 1) / 2 rows."""
    return parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()


def _told(sums: dict, n: int):
    from decimal import Decimal

    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
         pa.array([n] * len(sums), pa.int64()), pa.array([Decimal(int(v)) for v in sums.values()], pa.decimal128(38, 0))],
        ["i", "j", "n", "total"])


_SUMS = "i int, j int, n bigint, total decimal(38,0)"


def sums(points: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and each dimension's exact sum."""

    def run(batches: Iterator) -> Iterator:
        total, n = None, 0
        for _, x in _rows(batches):
            add = x.sum(axis=0).astype(object)  # SLICE * 2^41 at most: no overflow
            total, n = add if total is None else total + add, n + len(x)
        if n:
            yield _told({(i, i): t for i, t in enumerate(total)}, n)

    rows = sorted(_summed(points.mapInArrow(run, _SUMS)), key=lambda r: r["i"])
    return (rows[0]["n"], [int(r["total"]) for r in rows]) if rows else (0, [])


def square_sums(points: DataFrame, middle: list[int]) -> dict[tuple[int, int], int]:
    """The exact sums of z_i^2, under (i, i), and of (z_i + z_j)^2, under (i, j), with z = x - middle."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        shift, out, n = np.array(middle, np.int64), {}, 0
        for _, x in _rows(batches):
            z = x - shift
            z = _exact(z, 4 * int(np.abs(z).max()) ** 2 * len(z))
            n += len(z)
            for i in range(z.shape[1]):
                both = z[:, i:] + z[:, i:i + 1]
                both[:, 0] = z[:, i]  # the dimension itself
                for j, t in enumerate((both * both).sum(axis=0).tolist(), i):
                    out[i, j] = out.get((i, j), 0) + t
        if n:
            yield _told(out, n)

    return {(r["i"], r["j"]): int(r["total"]) for r in _summed(points.mapInArrow(run, _SUMS))}


def covariance(n: int, total: list[int], squares: dict[tuple[int, int], int]):
    """The covariance matrix: variances of pair sums less those of the two dimensions, halved. Each entry is
    an exact fraction, rounded once."""
    import numpy as np

    rest = [s - n * (s // n) for s in total]
    # n^2 times the variance of dimension i, or of the sum of i and j
    own = [n * squares[i, i] - r * r for i, r in enumerate(rest)]
    out = np.empty((len(total), len(total)))
    for i, ri in enumerate(rest):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, len(rest)):
            pair = n * squares[i, j] - (ri + rest[j]) ** 2
            out[i, j] = out[j, i] = (pair - own[i] - own[j]) / (2 * n * n)
    return out


@dataclass
class Whitening:
    """What ``fit`` finds: n and S, the first components (columns of ``axes``), their eigenvalues, and the trace."""

    n: int
    total: list[int]
    axes: object
    values: object
    trace: float

    def apply(self, x):
        """(whitened rows, deviations as a list of integers)."""
        import numpy as np

        middle = [s // self.n for s in self.total]
        rest = np.array([s - self.n * m for s, m in zip(self.total, middle)])
        z = x - np.array(middle, np.int64)
        white = (z - rest / self.n) @ (self.axes / np.sqrt(self.values))
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        apart = _exact(z, most * most * z.shape[1]) * self.n - rest
        return white, (apart * apart).sum(axis=1).tolist()


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    import numpy as np

    n, total = sums(points)
    if not n:
        return None
    matrix = covariance(n, total, square_sums(points, [s // n for s in total]))
    value, axis = np.linalg.eigh(matrix)
    value, axis = value[::-1], axis[:, ::-1]
    keep = [k for k in range(min(components, len(value))) if value[k] > SINGULAR * max(value[0], 0) and value[k] > 0]
    axis = axis[:, keep]
    axis = axis * np.sign(axis[np.abs(axis).argmax(axis=0), np.arange(len(keep))])  # largest entry positive
    return Whitening(n, total, axis, value[keep], float(np.trace(matrix)))


def identity_error(points: DataFrame, found: Whitening) -> float:
    """The largest entry, in size, of the whitened values' covariance less the identity."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        k = len(found.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in _rows(batches):
            white, _ = found.apply(x)
            first += white.sum(axis=0)
            second += white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([second.ravel()])], ["first", "second"])

    k = len(found.values)
    if not k:
        return 0.0
    parts = points.mapInArrow(run, "first array<double>, second array<double>")
    add = parts.select(F.posexplode(F.concat("first", "second"))).groupBy("pos").agg(F.sum("col").alias("s"))
    at = {r["pos"]: r["s"] for r in add.collect()}  # components * (components + 1) rows
    flat = np.array([at[i] for i in range(k + k * k)]) / found.n
    mean, second = flat[:k], flat[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    points = fixed_points(vectors, id_col, vec_col)
    kind = points.schema["id"].dataType.simpleString()
    shape = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    found = fit(points, components)
    if found is None:
        return points.sparkSession.createDataFrame([], shape)
    error, explained = identity_error(points, found), found.values / found.trace if found.trace else found.values

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k = len(found.values)
        for ids, x in _rows(batches):
            white, apart = found.apply(x)
            apart = pa.array([d if d < 1 << 63 else None for d in apart], pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, found.n)), apart.take(each), pa.array(white.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return points.mapInArrow(run, shape)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
