"""RANK / PERCENT_RANK without putting a whole window partition into one task.

``Window.orderBy(v)`` with no partition (a national ranking) or
``partitionBy(state)`` on a hot state moves every row of that partition to a
single task. The rank of a row only depends on how many rows of its
partition sort strictly before its value, so:

1. count rows per (partition, value)        -- distributed, map-side combined
2. bucket the distinct values, ``b = floor(v / width)``; prefix-sum bucket
   totals per partition (a table bounded by the value range / width) and
   prefix-sum values inside each (partition, bucket) (bounded by the number
   of distinct values in a bucket: at most 100 for 2-place metrics at width 1)
3. join the per-value ranks back to the rows on (partition, value).

The windows therefore only ever sort small, bounded tables. Several rankings
of one input are stacked into a single (spec, partition, value) table, so the
input is aggregated once for all of them; the resulting rank table (one row
per spec, partition and distinct value) is checkpointed once to the shared
checkpoint folder and equi-joined back per ranking. The big side is touched
by one aggregation and a chain of equi-joins: the rank table is broadcast if its
counted size is small; otherwise AQE splits skewed keys.

Null values sort last in both directions (stated explicitly; engines differ).
Ranks are bigint; percent ranks double, 0 when the partition has one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir


#: The rank table is broadcast up to this size.
BROADCAST_BYTES, RANK_ROW_BYTES = 64 * 1024 * 1024, 128
#: Distinct values in one range of ``rank_table_by_ranges``, about.
RANGE_ROWS = 1 << 20


def rank_table(df: DataFrame, value: str, partition_by: list[str] | tuple = (),
               bucket_width: float = 1.0) -> DataFrame:
    """(partition..., value, rank_desc, rank_asc, partition_rows) per distinct value."""
    parts = list(partition_by)
    v = F.col(value)
    # Null values form their own bucket, which sorts after every other bucket.
    counts = (df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_b", F.floor(v / F.lit(bucket_width))))
    wpart = Window.partitionBy(*parts)
    before = Window.unboundedPreceding, -1
    nb = F.col("_nb")
    buckets = counts.groupBy(*parts, "_b").agg(F.sum("_n").alias("_nb")).select(
        *parts, "_b",
        F.coalesce(F.sum(nb).over(wpart.orderBy(F.col("_b").desc_nulls_last()).rowsBetween(*before)),
                   F.lit(0)).alias("_gt_bucket"),
        F.sum(nb).over(wpart).alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("_b").isNotNull(), nb)).over(wpart), F.lit(0)).alias("_nonnull"))
    in_bucket = counts.select(
        *parts, value, "_b", "_n",
        F.coalesce(F.sum("_n").over(Window.partitionBy(*parts, "_b").orderBy(v.desc())
                                    .rowsBetween(*before)), F.lit(0)).alias("_gt_in_bucket"))
    ranked = _join_null_safe(in_bucket, buckets, parts + ["_b"])
    nn = F.col("_nonnull")
    gt = F.col("_gt_bucket") + F.col("_gt_in_bucket")   # rows strictly greater (nulls: all non-null)
    is_null = v.isNull()
    return ranked.select(
        *parts, value,
        (gt + 1).cast("bigint").alias("rank_desc"),
        F.when(is_null, nn + 1).otherwise(nn - gt - F.col("_n") + 1).cast("bigint").alias("rank_asc"),
        F.col("_rows").cast("bigint").alias("partition_rows"),
    )


def rank_table_by_ranges(df: DataFrame, value: str, partition_by: list[str] | tuple = (),
                         range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rank_table`` for values without a common grid, where a bucket of fixed width may hold any number of values.

    The distinct (partition, value) rows with their counts are range-partitioned on exactly these columns, by splits that Spark
    samples from them, into ranges of about ``range_rows`` rows, and stored. A window counts within one range
    of one partition; the ranges' totals (a row per partition and range) give what lies before each."""
    parts = list(partition_by)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    counts = df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    ranges = max(1, -(-counts.count() // range_rows))
    order = [F.col(p).asc_nulls_first() for p in parts] + [F.col(value).desc_nulls_last()]
    placed = (counts.repartitionByRange(ranges, *order).withColumn("_b", F.spark_partition_id())
              .checkpoint(eager=True))  # a second sampling could draw other splits
    before = Window.unboundedPreceding, -1
    mine = Window.partitionBy(*parts)
    nb, full = F.col("_nb"), F.col("_full")
    totals = placed.groupBy(*parts, "_b").agg(
        F.sum("_n").alias("_nb"), F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_n"))), F.lit(0)).alias("_full")).select(
        *parts, "_b", F.coalesce(F.sum(nb).over(mine.orderBy("_b").rowsBetween(*before)), F.lit(0)).alias("_gt_range"),
        F.sum(nb).over(mine).alias("_rows"), F.sum(full).over(mine).alias("_nonnull"))
    inside = Window.partitionBy(*parts, "_b").orderBy(F.col(value).desc_nulls_last()).rowsBetween(*before)
    ranked = _join_null_safe(placed.withColumn("_gt_in_range", F.coalesce(F.sum("_n").over(inside), F.lit(0))),
                             totals, parts + ["_b"])
    gt, nn = F.col("_gt_range") + F.col("_gt_in_range"), F.col("_nonnull")
    return ranked.select(
        *parts, value, (gt + 1).cast("bigint").alias("rank_desc"),
        F.when(F.col(value).isNull(), nn + 1).otherwise(nn - gt - F.col("_n") + 1).cast("bigint").alias("rank_asc"),
        F.col("_rows").cast("bigint").alias("partition_rows"))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        # ``right`` is a global aggregate: exactly one row, so broadcasting it is bounded.
        one = F.lit(0)
        return (left.withColumn("_one", one)
                .join(F.broadcast(right.withColumn("_one", one)), "_one").drop("_one"))
    la, ra = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    rest = [F.col(f"_r.{c}") for c in right.columns if c not in keys]
    return la.join(ra, cond, "inner").select("_l.*", *rest)


def _rank_outputs(spec: dict) -> list:
    n1 = (F.col("partition_rows") - 1).cast("double")
    outs = []
    if spec.get("rank_desc"):
        outs.append(F.col("rank_desc").alias(spec["rank_desc"]))
    if spec.get("rank_asc"):
        outs.append(F.col("rank_asc").alias(spec["rank_asc"]))
    for key, src in (("percent_rank_asc", "rank_asc"), ("percent_rank_desc", "rank_desc")):
        if spec.get(key):
            outs.append(F.when(F.col("partition_rows") > 1, (F.col(src) - 1).cast("double") / n1)
                        .otherwise(F.lit(0.0)).alias(spec[key]))
    return outs


def add_ranks(df: DataFrame, specs: list[dict], bucket_width: float | None = 1.0,
              materialize: bool = True) -> DataFrame:
    """Add several rankings at once. Each spec: ``value``, optional ``partition_by``
    and the output names ``rank_desc`` / ``rank_asc`` / ``percent_rank_asc`` /
    ``percent_rank_desc``.

    All specs are stacked into one (spec, partition..., value) table, so the
    input is aggregated once for every ranking together, and one rank table
    serves all of them; the joins back form a single chain over ``df``.

    The ranked rows are joined to the rank table: broadcast if its counted rows
    fit ``BROADCAST_BYTES``; beyond that by an equi-join whose hot values (many rows
    of one value) Spark's skew join splits.

    Without ``materialize`` nothing runs until the result is queried, and the
    ranks always belong to the rows read then (registered views). With it
    the result is meant to be read once, over an input that stands still.

    ``bucket_width`` None: values need no common grid (``rank_table_by_ranges``, which materializes always).

    With ``materialize`` the rank table (one row per spec, partition and
    distinct value: small) is computed once and checkpointed to the shared
    ``spark.checkpoint.dir``; every join back then reads those few files
    instead of re-deriving the ranks (and the input) per spec."""
    width = max((len(sp.get("partition_by", ())) for sp in specs), default=0)
    slots = [f"_p{j}" for j in range(width)]

    def slot(parts: list[str], j: int):
        v = F.col(parts[j]).cast("string") if j < len(parts) else F.lit(None).cast("string")
        return v.alias(slots[j])

    rows = [F.struct(F.lit(i).alias("_spec"),
                     *[slot(list(sp.get("partition_by", ())), j) for j in range(width)],
                     F.col(sp["value"]).cast("double").alias("_v"))
            for i, sp in enumerate(specs)]
    stacked = df.select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")
    if bucket_width is None:
        rt = rank_table_by_ranges(stacked, "_v", ["_spec", *slots])
    else:
        rt = rank_table(stacked, "_v", ["_spec", *slots], bucket_width)
    fits = False
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        rt = rt.checkpoint(eager=True)
        # counted rows, not an estimate: then no ranked row is shuffled, whatever value is hot
        fits = rt.count() * RANK_ROW_BYTES <= BROADCAST_BYTES

    out = df
    for i, sp in enumerate(specs):
        parts = list(sp.get("partition_by", ()))
        mine = slots[:len(parts)]
        sub = rt.where(F.col("_spec") == i).select(*mine, "_v", *_rank_outputs(sp))
        if fits:
            sub = F.broadcast(sub)
        cond = [F.col(p).cast("string").eqNullSafe(sub[mine[j]]) for j, p in enumerate(parts)]
        cond.append(F.col(sp["value"]).cast("double").eqNullSafe(sub["_v"]))
        out = out.join(sub, cond, "inner").drop(*mine, "_v")
    return out


def with_ranks(df: DataFrame, value: str, partition_by: list[str] | tuple = (), *,
               rank_desc: str | None = None, rank_asc: str | None = None,
               percent_rank_asc: str | None = None, percent_rank_desc: str | None = None,
               bucket_width: float | None = 1.0) -> DataFrame:
    """Add the requested rank columns of ``value`` within ``partition_by``."""
    return add_ranks(df, [dict(value=value, partition_by=partition_by, rank_desc=rank_desc,
                               rank_asc=rank_asc, percent_rank_asc=percent_rank_asc,
                               percent_rank_desc=percent_rank_desc)], bucket_width)
