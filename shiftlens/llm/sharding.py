"""Sharding by a permutation-filled lookup table, in DataFrame expressions.

Each shard prefers the slots of a table of prime size in its own order, a
permutation given by an offset and a step from a hash of its name. Shards take
turns; at its turn a shard claims its most preferred free slot, until the
table is full. Shards then own the same number of slots, give or take one, and adding
or removing a shard moves few slots between the others. A row's shard is the
owner of slot hash(key) mod size.

The table depends on the shard names and its size alone, not on any data: it is
filled once where the job is defined, becomes a DataFrame of ``slots`` rows
(bounded by that parameter), and is broadcast. Placement is one hash and one
lookup per row, without any shuffle, so hot keys and copies cause no skew.

``write_shards`` writes the rows, with all their columns, to a folder per shard. Rows are
shuffled once, by shard, under a REBALANCE hint: Spark cuts every shard into files of the advisory
size, so that a shard is written by as many tasks as its bytes need, however hot its keys are.

Defined results: a null key has the hash of the empty string and is placed like any
other; repeated rows go to the same shard; ``assign`` returns no further columns; ``place`` and
``write_shards`` keep them all, a name that clashes with one before it or with ``slot`` and ``shard`` (in
any letter case) gets its column's position as a suffix; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import pick, table

SHARDS, SLOTS = 64, 8191  # a prime over 100 times the shards: shares differ by less than 1 %
DIGITS = 15  # hex digits of the key's MD5 that are used: 60 bits


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:03d}" for i in range(n)]


def _hash(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:DIGITS], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The owner (position in ``names``) of every slot."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need distinct names")
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table's size must be a prime of at least the number of shards")
    start = [_hash(f"offset {n}") % slots for n in names]
    step = [_hash(f"step {n}") % (slots - 1) + 1 if slots > 2 else 1 for n in names]
    owner, at = [-1] * slots, list(start)
    for turn in range(slots):
        i = turn % len(names)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        owner[at[i]] = i
    return owner


def table_frame(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row per slot."""
    listed = ",".join(map(str, lookup_table(names, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(listed), ",")).alias("slot", "shard")).select(
        "slot", F.col("shard").cast("int").alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("bigint") % slots).cast("int")


def assign(df: DataFrame, key_col: str, names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """(key, slot, shard) of every row."""
    names = names or shard_names()
    keyed = pick(df, key=key_col).withColumn("slot", slot_of(F.col("key"), slots))
    # ``slots`` rows of 8 bytes, whatever the data
    return keyed.join(F.broadcast(table_frame(df.sparkSession, names, slots)), "slot").select("key", "slot", "shard")


def place(df: DataFrame, key_col: str, names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """Every row of ``df`` with all its columns, and its slot and shard."""
    names = names or shard_names()
    taken, kept = {"slot", "shard"}, []
    for i, c in enumerate(df.columns):
        while c.lower() in taken:
            c = f"{c}_{i}"
        taken.add(c.lower())
        kept.append(c)
    keyed = df.toDF(*kept).withColumn("slot", slot_of(F.col(f"`{kept[df.columns.index(key_col)]}`"), slots))
    keyed = keyed.join(F.broadcast(table_frame(df.sparkSession, names, slots)), "slot")
    return keyed.select(*[F.col(f"`{c}`") for c in kept], "slot", "shard")


def write_shards(df: DataFrame, path: str, key_col: str, names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """Write the rows as Parquet to ``path``/shard=N; returns them as read back from there."""
    placed = place(df, key_col, names, slots)
    placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = write_shards(table(spark, sf_dir, "documents"), scratch_dir(spark, "shards"), "doc_id")
    return out.select("doc_id", "slot", "shard", F.octet_length("text").cast("bigint").alias("text_bytes"),
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


# The filling once more in SQL: one claim a turn, by the shard whose turn it is, of the first free slot in its order.
OP7_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i,
    ('0x' || substr(md5('offset shard-' || printf('%03d', i)), 1, {DIGITS}))::BIGINT % {SLOTS} AS first,
    ('0x' || substr(md5('step shard-' || printf('%03d', i)), 1, {DIGITS}))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({SHARDS}) t(i)
), fill AS (
  SELECT CAST(0 AS BIGINT) AS turn, list_transform(range({SLOTS}), lambda x: CAST(-1 AS BIGINT)) AS own
  UNION ALL
  SELECT turn + 1, own[1:slot] || [turn % {SHARDS}] || own[slot + 2:]
  FROM (
    SELECT turn, own, (first + step * list_filter(range({SLOTS}),
        lambda k: own[(first + step * k) % {SLOTS} + 1] < 0)[1]) % {SLOTS} AS slot
    FROM fill JOIN shards ON i = turn % {SHARDS} WHERE turn < {SLOTS}
  )
), full_table AS (
  SELECT own FROM fill WHERE turn = {SLOTS}
), keyed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {DIGITS}))::BIGINT % {SLOTS} AS slot,
    CAST(octet_length(encode(text)) AS BIGINT) AS text_bytes, md5(text) AS text_md5
  FROM documents
)
SELECT doc_id, CAST(slot AS INT) AS slot, CAST(own[slot + 1] AS INT) AS shard, text_bytes, text_md5 FROM keyed, full_table
"""
