"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of one label link when their cosine is at least ``least`` (0.98). For unit
vectors that is a squared distance of at most 2 - 2 * least. The vectors are
rotated by one fixed random rotation and cut into b blocks of few dimensions:
a linked pair has a block whose squared distance is at most a b-th of that.
Each block is range-joined: a grid of cells as wide as twice the block's
radius, every vector indexed under its own cell and probing the cells that
its ball meets (a pair finds itself from the side with the smaller cell key, so
once in a block). A row of a cell also carries the block's coordinates, 16 bits
each in units of the radius / 1024, so the join itself tells whether the block's distance
is within the budget (widened by what rounding to these units can hide) and only then
gives a candidate. The union of the blocks' candidates is verified
by the exact cosine in double precision. No link is lost, none is made up.

Equal vectors of one label (by a 128-bit hash) form one class: copies are
never paired, they only count. Pairs are between different vectors, one row
per candidate, as every direct link has to be counted.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and all vectors without a label, link with nothing; vectors of
different lengths do not link; repeated rows are separate vectors that link;
a null vec_id is never a component's smallest id unless all are null; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, pick, stored, table

LEAST, BLOCK_DIMS, SEED = 0.98, 8, 6
UNITS = 1024  # coordinates in a cell's row are in units of the block's radius / UNITS, modulo 2**16
_ODD = 0x9E3779B97F4A7C15


def rotation(dims: int, seed: int = SEED):
    """A fixed random orthogonal matrix."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _mix(h):
    import numpy as np

    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def cell_keys(unit, salt, least: float, block_dims: int):
    """Yields (home keys, probing row, probed key, packed coordinates) for each block of the unit vectors; ``salt``
    keeps labels apart. Keys are hashes of cells: a collision only adds a candidate."""
    import numpy as np

    n, dims = unit.shape
    turned = unit @ rotation(dims)
    cuts = list(range(0, dims, block_dims))
    budget = (2 - 2 * least) / len(cuts) * (1 + 1e-9) + 1e-12  # the margin covers rounding of the rotation
    side = 2 * budget**0.5
    for block, a in enumerate(cuts):
        x = turned[:, a:a + block_dims]
        d = x.shape[1]
        weight = np.array([pow(_ODD, j + 1, 1 << 64) for j in range(d)], dtype=np.uint64)
        cell = np.floor(x / side)
        into = x / side - cell
        step = np.where(into >= 0.5, 1, -1)
        gap = (np.minimum(into, 1 - into) * side) ** 2  # squared distance to the nearer neighbour cell
        subsets = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(np.uint64)
        base = _mix(salt + np.uint64((block * len(cuts) + 1) * _ODD % (1 << 64)))
        plain = (cell.astype(np.int64).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
        moves = step.astype(np.int64).astype(np.uint64) * weight
        row, subset = np.nonzero(gap @ subsets.T.astype(float) <= budget)
        moved = (moves[row] * subsets[subset]).sum(axis=1, dtype=np.uint64)
        home = _mix(plain + base)
        probed = _mix(plain[row] + moved + base[row])
        ahead = probed >= home[row]
        yield home, row[ahead], probed[ahead], packed(x / budget**0.5, -(-block_dims // 4))


def packed(x, longs: int):
    """Four coordinates in a long: rounded to units, modulo 2**16."""
    import numpy as np

    units = np.zeros((len(x), 4 * longs), dtype=np.uint64)
    units[:, :x.shape[1]] = np.rint(x * UNITS).astype(np.int64) & 0xFFFF
    shifts = np.arange(4, dtype=np.uint64) * np.uint64(16)
    return (units.reshape(len(x), longs, 4) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def within_radius(a: list[Column], b: list[Column], block_dims: int) -> Column:
    """True for every two rows of a block no farther apart than its radius (from packed coordinates)."""
    total = F.lit(0).cast("bigint")
    for p, q in zip(a, b, strict=True):
        for shift in range(0, 64, 16):
            gap = F.shiftright(p, shift).bitwiseAND(F.lit(0xFFFF)) - F.shiftright(q, shift).bitwiseAND(F.lit(0xFFFF))
            gap = (gap + 0x8000).bitwiseAND(F.lit(0xFFFF)) - 0x8000  # the signed difference modulo 2**16
            total = total + gap * gap
    # either side is rounded by half a unit in every dimension
    return total <= int((UNITS + block_dims**0.5) ** 2) + 1


def unit_classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """rows (id, h1, h2; null hashes for vectors that link with nothing) and their distinct vectors
    (cls, h1, h2, label, v, norm, n, first_id), both stored; v of the latter is scaled by its largest component, so
    that its norm neither overflows nor underflows."""
    src = pick(vectors, id=id_col, v=vec_col, label=label_col).withColumn("v", F.col("v").cast("array<double>"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("v", lambda x: x == 0)
    fit = F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & ~zero
    rows = src.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("label", F.col("label").cast("string"))
    h1, h2 = F.xxhash64("label", "v"), F.xxhash64(F.lit(SEED), "v", "label", F.size("v"))
    rows = stored(rows.select("id", F.when(F.col("fit"), h1).alias("h1"), F.when(F.col("fit"), h2).alias("h2"),
                              F.when(F.col("fit"), F.col("label")).alias("label"),
                              F.when(F.col("fit"), F.col("v")).alias("v")), "embedding-rows")
    found = (rows.where("h1 is not null").groupBy("h1", "h2")
             .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"),
                  F.min("id").alias("first_id")))
    top = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    found = found.withColumn("top", top).withColumn("v", F.transform("v", lambda x: x / F.col("top"))).drop("top")
    found = found.withColumn("norm", F.sqrt(_dot(F.col("v"), F.col("v"))))
    return rows, stored(found.withColumn("cls", F.monotonically_increasing_id()), "embedding-classes")


def candidates(found: DataFrame, least: float = LEAST, block_dims: int = BLOCK_DIMS) -> DataFrame:
    """(a, b) with a < b: pairs of classes that pass some block's range join."""
    src = found.select("cls", F.xxhash64("label", F.size("v")).alias("salt"), "norm", "v")
    coordinates = [f"p{i}" for i in range(-(-block_dims // 4))]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, salts, norms = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
                sizes = part.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                values, first = part.column(3).flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
                for dims in np.unique(sizes):
                    own = np.flatnonzero(sizes == dims)
                    unit = values[first[own][:, None] + np.arange(dims)] / norms[own][:, None]
                    cls = ids[own]
                    for home, row, probed, where in cell_keys(unit, salts[own].astype(np.uint64), least, block_dims):
                        where = np.concatenate([where, where[row]])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate([np.zeros(len(cls), bool), np.ones(len(row), bool)])),
                             pa.array(np.concatenate([home, probed]).view(np.int64)),
                             pa.array(np.concatenate([cls, cls[row]])),
                             *[pa.array(np.ascontiguousarray(column)) for column in where.T]],
                            ["probe", "key", "cls", *coordinates])

    kinds = ", ".join(["probe boolean, key bigint, cls bigint", *[f"{c} bigint" for c in coordinates]])
    cells = stored(src.mapInArrow(run, kinds), "embedding-cells", ("probe",))
    probe = cells.where("probe").select("key", F.col("cls").alias("x"), *[F.col(c).alias(f"{c}_x") for c in coordinates])
    index = cells.where("not probe").select("key", F.col("cls").alias("y"), *[F.col(c).alias(f"{c}_y") for c in coordinates])
    near = within_radius([F.col(f"{c}_x") for c in coordinates], [F.col(f"{c}_y") for c in coordinates], block_dims)
    return (probe.join(index, "key").where(F.col("x") != F.col("y")).where(near)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def _dot(x, y):
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         label_col: str = "label", least: float = LEAST, block_dims: int = BLOCK_DIMS) -> DataFrame:
    """(id, n_links, component_id): one row per vector."""
    rows, found = unit_classes(vectors, id_col, vec_col, label_col)
    side = lambda k: found.select(*[F.col(c).alias(f"{c}_{k}") for c in ("cls", "n", "label", "v", "norm")])
    pairs = (candidates(found, least, block_dims).withColumnRenamed("a", "cls_a").withColumnRenamed("b", "cls_b")
             .join(side("a"), "cls_a").join(side("b"), "cls_b")
             .where((F.col("label_a") == F.col("label_b")) & (F.size("v_a") == F.size("v_b")))
             .where(_dot(F.col("v_a"), F.col("v_b")) / (F.col("norm_a") * F.col("norm_b")) >= least)
             .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), "n_a", "n_b"))
    pairs = stored(pairs, "embedding-links")
    other = (pairs.select(F.col("a").alias("cls"), F.col("n_b").alias("n"))
             .union(pairs.select("b", "n_a")).groupBy("cls").agg(F.sum("n").alias("others")))
    linked = components(pairs.select("a", "b"), "embedding").withColumnRenamed("node", "cls")
    sized = (found.select("cls", "h1", "h2", "n", "first_id").join(other, "cls", "left").join(linked, "cls", "left")
             .withColumn("root", F.coalesce("root", "cls")))
    smallest = sized.groupBy("root").agg(F.min("first_id").alias("smallest"))
    told = sized.join(smallest, "root").select(
        "h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "smallest")
    return rows.join(told, ["h1", "h2"], "left").select(
        "id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_components(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component_id").cast("bigint").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a AS vec_id, b AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
c AS (SELECT vec_id, min(other) AS first FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.first, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.first, vec_id)) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""
