"""Helpers shared by the operators: column picking, stored tables, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_dir

#: A side of a join is broadcast only when its rows, counted first, need no more than this.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """``new=old`` columns only, found by exact name and position, so that further
    columns of any name (also names that differ in case, or repeat) do no harm."""
    at = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, i)
    missing = [old for old in wanted.values() if old not in at]
    if missing:
        raise ValueError(f"columns {missing} are not among {df.columns}")
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{at[old]}").alias(new) for new, old in wanted.items()])


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: later uses
    neither recompute it nor depend on the executors that made it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch, column: str, most_bytes: int = 8 << 20, most_rows: int = 256):
    """``batch`` in parts of at most ``most_rows`` rows and about ``most_bytes`` of ``column`` (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(upto, upto[at] + most_bytes, side="right")) - 1
        end = min(max(fits, at + 1), at + most_rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True when the counted rows of ``df`` fit in ``limit`` bytes at ``row_bytes`` each."""
    return df.count() * row_bytes <= limit


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); root is the smallest node reachable.

    Alternating large-star and small-star rounds until the edge set stands still:
    about log2 of the longest chain, each a few equi-joins and minimum aggregates
    with map-side combine. No neighbour list is ever collected. Every round is
    written to the shared folder. Empty edges give an empty result."""
    ensure_checkpoint_dir(edges.sparkSession)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), f"{name}-edges")
    now = state(e)
    while now[0]:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small_star = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            low.select("a", F.col("m").alias("b"))).distinct()
        e = stored(small_star, f"{name}-round")
        before, now = now, state(e)
        if now == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select("b", "b").distinct().toDF("node", "root"))
