"""Best-fit packing of whole documents into sequences, large items matched first.

A document's ids (end id included) longer than the capacity C are cut into
pieces of C and a rest; all others stay whole. Then, on the number of pieces
of each length (at most C numbers, however large the corpus):
1. pieces longer than C/3: the longest is matched with the longest other one
   that fits beside it; at most two of them share a sequence;
2. all shorter pieces, longest first: each goes to the sequence with the
   smallest remaining gap that holds it, or opens a new sequence.
The result is a list of runs "the pieces of length L ranked r to r+n go to
sequences s, s+1, ... at offset o", whose size depends on C only.

Pieces get their rank among those of equal length without any global sort:
a position within (length, writing task), plus the count of earlier tasks. Runs are
cut at those task borders, so that a piece finds its run by an equi-join on
(length, task). Token ids are written once; they are shuffled only if a caller
selects them while that table of borders is too large to broadcast.

Defined results: a null or empty text is the end id alone; repeated rows are
separate documents; a null id is kept; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, small, stored, table
from .encode import encoder

CAPACITY, END_ID = 4096, 1


def pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, task, pos), stored: every piece of every document.

    ``pos`` numbers the pieces of one length within the task that wrote them. Only the
    output of a committed attempt is read, so task and pos stay unique if a task is repeated."""
    src = pick(docs, id=id_col, text=text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, enc, end, seen = TaskContext.get().partitionId(), encoder(tokenizer), struct.pack("<I", end_id), {}
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                rows, cols = [], [[] for _ in range(7)]
                for r, ids in enumerate(enc.ids(part.column(1).to_pylist())):
                    ids += end
                    for p, a in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[a:a + 4 * capacity]
                        n = len(own) // 4
                        pos = seen[n] = seen.get(n, -1) + 1
                        rows.append(r)
                        for c, v in zip(cols, (p, a // 4, n, zlib.crc32(own), own, task, pos), strict=True):
                            c.append(v)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())),
                     *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "pos"])

    kind = src.schema["id"].dataType.simpleString()
    return stored(src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint,"
                                      " ids binary, task int, pos bigint"), "packing-pieces")


class _Gaps:
    """Ranges (first sequence, sequences) by the room left in each of them."""

    def __init__(self):
        self._rooms, self._at = [], {}

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self._at:
                bisect.insort(self._rooms, room)
                self._at[room] = []
            self._at[room].append((first, n))

    def take(self, least: int):
        """A range with the smallest room of at least ``least``: (room, first, n), or None."""
        i = bisect.bisect_left(self._rooms, least)
        if i == len(self._rooms):
            return None
        room = self._rooms[i]
        first, n = self._at[room].pop()
        if not self._at[room]:
            del self._at[room]
            self._rooms.pop(i)
        return room, first, n


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, pieces in a sequence, offset): piece ``first rank + i``
    of the length goes to sequence ``first sequence + i // per`` at ``offset + i % per * length``."""
    gaps, runs, used, next_rank = _Gaps(), [], 0, dict.fromkeys(counts, 0)

    def place(length: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((length, next_rank[length], n, first, per, offset))
        next_rank[length] += n

    left = {k: n for k, n in counts.items() if n > 0}
    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        i = bisect.bisect_right(large, capacity - a) - 1
        if i >= 0 and large[i] == a and left[a] < 2:
            i -= 1
        b = large[i] if i >= 0 else None
        if b == a:
            n = left[a] // 2
            place(a, 2 * n, used, 2, 0)
            left[a] -= 2 * n
        else:
            n = left[a] if b is None else min(left[a], left[b])
            place(a, n, used, 1, 0)
            left[a] -= n
            if b is not None:
                place(b, n, used, 1, a)
                left[b] -= n
        gaps.add(capacity - a - (b or 0), used, n)
        used += n
        for k in {a, b} - {None}:
            if not left[k]:
                large.remove(k)

    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        n = left[length]
        while n:
            room, first, bins = gaps.take(length) or (capacity, used, -(-n // (capacity // length)))
            if first == used:
                used += bins
            per = room // length
            full = min(bins, n // per)
            if full:
                place(length, full * per, first, per, capacity - room)
                gaps.add(room - per * length, first, full)
                n -= full * per
            if full < bins and n:  # the last sequence takes fewer than it could hold
                place(length, n, first + full, n, capacity - room)
                gaps.add(room - n * length, first + full, 1)
                full, n = full + 1, 0
            gaps.add(room, first + full, bins - full)
    return runs


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): every piece with its place.
    Ordering a sequence's pieces by offset and joining their ids gives the sequence."""
    own = pieces(docs, tokenizer, end_id, capacity, id_col, text_col)
    by_task = own.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # rows of this window: the tasks that wrote a piece of one length
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = stored(by_task.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    runs = sorted(plan_runs(counts, capacity))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["length", "task", "from_pos", "to_pos", "shift", "sequence", "per", "base"]
        for b in batches:
            out = []
            for r in b.to_pylist():
                a, z, length = r["first"], r["first"] + r["n"], r["length"]
                i = bisect.bisect_right(runs, (length, a, float("inf"))) - 1
                while i < len(runs) and runs[i][0] == length and runs[i][1] < z:
                    _, rank, n, sequence, per, base = runs[i]
                    lo, hi = max(a, rank), min(z, rank + n)
                    out.append((length, r["task"], lo - a, hi - a, a - rank, sequence, per, base))
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(8)], names)

    places = by_task.mapInArrow(cut, "length bigint, task bigint, from_pos bigint, to_pos bigint, shift bigint,"
                                     " sequence bigint, per bigint, base bigint")
    # a task's pieces of one length seldom span two runs, so the counted rows tell the size; beyond it, a shuffle
    places = F.broadcast(places) if small(by_task, row_bytes=256) else places.hint("merge")
    i = F.col("pos") + F.col("shift")
    return (own.join(places, ["length", "task"]).where("pos >= from_pos and pos < to_pos")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "ids",
                    (F.col("sequence") + F.floor(i / F.col("per"))).alias("sequence_id"),
                    (F.col("base") + i % F.col("per") * F.col("length")).alias("offset")))


def digest(packed: DataFrame) -> DataFrame:
    return packed.drop("ids")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
