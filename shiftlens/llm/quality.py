"""Quality classifier by importance resampling.

Two generative models, each a multinomial over hashed n-grams: one of the
target (labelled documents of quality 1), one of the raw text (all documents).
A document's log importance weight is the sum over its n-grams of
log p_target - log p_raw; a document of more than TEMPERED n-grams gets
TEMPERED times their mean, so that length alone (a language that the labels
cover a little less, summed over a long text) decides nothing. Adding standard
Gumbel noise to the log weights and keeping the k largest keys draws k
documents without replacement with probabilities proportional to the weights.
k is a parameter, as a number or as a share of the documents; by default it is the number of documents whose log weight is at least LEAST: the raw model
explains an n-gram of theirs better by LEAST / TEMPERED (7 %) at most. So the
sample's size follows the corpus.

N-grams: byte trigrams, with every digit written as 0, in TRIGRAMS buckets, and
word pairs, in which a word equal to its predecessor is written as a repeat
mark, in PAIRS buckets. The raw model counts every document; the target model
counts at most ``max_labelled`` labelled documents (the smallest hashes of
their ids), each bucket shrunk towards the raw model by PRIOR expected counts,
so that a few labels do not rule out what they happen not to hold. In both
models the n-grams of a document weigh TEMPERED_COUNT together at most, so that a few
huge documents do not set the shares of languages; a document of any length weighs
that much, as weights are kept in parts of 1 / _UNIT. What
reaches the driver is 2 * (TRIGRAMS + PAIRS) counts, whatever the corpus.

The noise is a hash of the id: repeated runs draw the same sample. The k-th
largest key is found exactly by counting keys in ever narrower ranges; keys
equal to it are all kept, so repeated rows stay or go together.

Defined results: a null or empty text has log weight 0; a null id has the
noise of the null hash; without labelled target documents every log weight is
0; an empty table gives an empty result; other columns are ignored or, in
``keep``, returned as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, stored, table

TRIGRAMS, PAIRS, PRIOR = 1 << 12, 1 << 10, 5.0
BUCKETS = TRIGRAMS + PAIRS
MAX_LABELLED, SEED = 20_000, 5
TEMPERED, LEAST, TEMPERED_COUNT = 100, -7.0, 500
_UNIT = 1 << 32  # counts are kept as integers of this many parts: sums do not depend on their order
_FLUSH = 1 << 20  # documents whose counts a task adds up in 64 bits: each adds TEMPERED_COUNT * _UNIT < 2**41 at most
_ODD = 0x9E3779B97F4A7C15  # an odd multiplier for hashing modulo 2**64
_REPEAT = 0x51ED270B
WINDOW = 500_000  # characters of short texts, or bytes of a long one, whose n-grams are held at a time
_WHITE = b"\t\n\v\f\r "
_SPACE = re.compile(rb"[\t-\r ]")


def _data(raw: list[bytes]):
    """(bytes with digits as 0, each text followed by a line break; where the texts end)"""
    import numpy as np

    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8).copy()
    data[(data >= 48) & (data <= 57)] = 48
    return data, np.cumsum(np.array([len(r) + 1 for r in raw], dtype=np.int64))


def _trigrams(data, ends):
    """(buckets, text numbers) of the byte trigrams that do not cross the end of a text."""
    import numpy as np

    code = data.astype(np.uint64)
    tri = (code[:-2] << np.uint64(16) | code[1:-1] << np.uint64(8) | code[2:]) * np.uint64(_ODD) >> np.uint64(65 - TRIGRAMS.bit_length())
    at = np.arange(len(tri))
    own = np.searchsorted(ends, at, side="right")
    inside = at + 3 < ends[own]  # the byte before an end is the separator
    return tri[inside].astype(np.int64), own[inside]


def _pairs(data, ends):
    """(buckets, text numbers) of the word pairs; a word's hash is a polynomial of its bytes from prefix sums, modulo 2**64."""
    import numpy as np

    odd, code = np.uint64(_ODD), data.astype(np.uint64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    n = len(data)
    power = np.full(n + 1, odd)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(n + 1, np.uint64(pow(_ODD, -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    word = (total[last] - total[first]) * inverse[first]
    text = np.searchsorted(ends, first, side="right")
    same = text[1:] == text[:-1]
    pair = np.where(word[1:] == word[:-1], np.uint64(_REPEAT), word[:-1] * np.uint64(31) + word[1:])
    pair = (pair ^ pair >> np.uint64(29)) * odd >> np.uint64(65 - PAIRS.bit_length())
    return (pair[same] + np.uint64(TRIGRAMS)).astype(np.int64), text[1:][same]


def ngram_buckets(texts: list[str | None]):
    """(buckets, text numbers) of all n-grams of the texts; word pairs have buckets from TRIGRAMS on."""
    import numpy as np

    data, ends = _data([(t or "").encode("utf-8", "replace") for t in texts])
    tri, pairs = _trigrams(data, ends), _pairs(data, ends)
    return np.concatenate([tri[0], pairs[0]]), np.concatenate([tri[1], pairs[1]])


def bucket_counts(text: str, window: int = WINDOW):
    """How often each bucket occurs in one long text, in windows of about ``window`` bytes that end at white space: a
    trigram counts in the window where it starts, a pair in that of its second word."""
    import numpy as np

    raw, at, last = text.encode("utf-8", "replace"), 0, 0
    n = np.zeros(BUCKETS, dtype=np.int64)
    while at < len(raw):
        gap = _SPACE.search(raw, at + window) if at + window < len(raw) else None
        end = gap.start() if gap else len(raw)
        n += np.bincount(_trigrams(*_data([raw[at:end + 2]]))[0], minlength=BUCKETS)
        n += np.bincount(_pairs(*_data([raw[last:end]]))[0], minlength=BUCKETS)
        words = raw[last:end].rstrip(_WHITE)
        if words:  # the next window's first pair begins with this one's last word
            last += _last_word(words)
        at = end
    return n


def _last_word(words: bytes) -> int:
    """Where the last word starts."""
    return max(words.rfind(bytes([c])) for c in _WHITE) + 1


def _blocks(column, chars: int = WINDOW) -> Iterator[list[str | None]]:
    """The texts of an Arrow column, in lists of about ``chars`` characters at most (or one text)."""
    held, size = [], 0
    for t in column:
        t = t.as_py()
        if held and size + len(t or "") > chars:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = MAX_LABELLED) -> list[float]:
    """log p_target - log p_raw of every bucket."""
    import numpy as np

    chosen = (pick(labels, id="doc_id", quality="quality").where("quality = 1").select("id").distinct()
              .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    src = pick(docs, id=id_col, text=text_col)
    # at most max_labelled ids: bounded
    src = src.join(F.broadcast(chosen.withColumn("target", F.lit(True))), "id", "left").select("target", "text")

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def counts() -> pa.RecordBatch:
            model, bucket = np.nonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(model, pa.int64()), pa.array(bucket, pa.int64()),
                                               pa.array(n[model, bucket])], ["model", "bucket", "n"])

        n, held = np.zeros((2, BUCKETS), dtype=np.int64), 0
        for b in batches:
            if held and held + b.num_rows > _FLUSH:
                yield counts()
                n[:], held = 0, 0
            held += b.num_rows
            flags, done = b.column(0).to_pylist(), 0
            for texts in _blocks(b.column(1)):
                if len(texts[0] or "") > WINDOW:  # alone in its block
                    own = bucket_counts(texts[0])
                    own *= int(np.rint(_UNIT * min(1, TEMPERED_COUNT / max(own.sum(), 1))))
                    n[0] += own
                    n[1] += own * bool(flags[done])
                    done += 1
                    continue
                buckets, text = ngram_buckets(texts)
                size = np.bincount(text, minlength=len(texts))
                # from 1000 parts for a text of 2**31 bytes up; the sums of a block stay exact in a double
                share = np.rint(_UNIT * np.minimum(1, TEMPERED_COUNT / np.maximum(size, 1)))[text]
                n[0] += np.bincount(buckets, share, BUCKETS).astype(np.int64)
                target = np.array([bool(x) for x in flags[done:done + len(texts)]])
                done += len(texts)
                n[1] += np.bincount(buckets, share * target[text], BUCKETS).astype(np.int64)
        yield counts()

    rows = (src.mapInArrow(count, "model bigint, bucket bigint, n bigint")
            .groupBy("model", "bucket").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect())  # at most 2 * BUCKETS rows
    n = np.zeros((2, BUCKETS))
    for r in rows:
        n[r["model"], r["bucket"]] = float(r["n"]) / _UNIT
    out = np.zeros(BUCKETS)
    for kind in (slice(0, TRIGRAMS), slice(TRIGRAMS, BUCKETS)):
        raw, target = n[0, kind], n[1, kind]
        if target.any():
            expected = raw / raw.sum() * target.sum()
            p = np.where(raw > 0, raw / raw.sum(), 0) * (target + PRIOR) / (expected + PRIOR)
            out[kind] = np.log((target + PRIOR) / (expected + PRIOR)) - np.log(p.sum())
    return out.tolist()


def log_weight(ratios: list[float]):
    """A column function: text -> log importance weight."""
    import numpy as np
    from pyspark.sql.functions import arrow_udf

    held = np.array(ratios)

    @arrow_udf("double")
    def weight(texts):
        import numpy as np
        import pyarrow as pa

        out = []
        for block in _blocks(texts):
            if len(block[0] or "") > WINDOW:
                own = bucket_counts(block[0])
                out.append(np.array([own @ held * min(own.sum(), TEMPERED) / max(own.sum(), 1)]))
                continue
            buckets, text = ngram_buckets(block)
            n = np.bincount(text, minlength=len(block))
            total = np.bincount(text, weights=held[buckets], minlength=len(block))
            out.append(total * np.minimum(n, TEMPERED) / np.maximum(n, 1))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return weight


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise that depends on the id and the seed only."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, k: int, few: int = 4096) -> float:
    """The exact k-th largest value of a one-column frame of doubles (k from 1 to its rows)."""
    col = values.columns[0]
    lo, hi = values.agg(F.min(col), F.max(col)).first()
    inside = values
    while True:
        if lo == hi:
            return lo
        width = (hi - lo) / few
        slot = F.least(F.floor((F.col(col) - lo) / width), F.lit(few - 1))
        rows = (inside.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"),
                                                       F.max(col).alias("hi")).collect())  # at most ``few`` rows
        for r in sorted(rows, key=lambda r: -r["slot"]):
            if r["n"] >= k:
                break
            k -= r["n"]
        if r["n"] <= few:
            kept = inside.where(F.col(col).between(r["lo"], r["hi"])).collect()  # at most ``few`` rows
            return sorted((x[0] for x in kept), reverse=True)[k - 1]
        lo, hi = r["lo"], r["hi"]
        inside = inside.where(F.col(col).between(lo, hi))


def threshold(docs: DataFrame, weight, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
              share: float | None = None) -> tuple[DataFrame, float]:
    """(id, log_weight, gumbel_key) of all documents, stored, and the k-th largest key (infinity if k is 0). ``k``: as given, or
    ``share`` of all documents, or the number of those with a log weight of LEAST or more."""
    src = pick(docs, id=id_col, text=text_col)
    scored = stored(src.select("id", weight("text").alias("log_weight"))
                    .withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("id"))), "quality-scores")
    if k is None:
        k = round(share * scored.count()) if share is not None else scored.where(F.col("log_weight") >= LEAST).count()
    k = min(k, scored.count())
    return scored, kth_largest(scored.select("gumbel_key"), k) if k else math.inf


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_labelled: int = MAX_LABELLED, k: int | None = None, share: float | None = None) -> DataFrame:
    """(id, log_weight, gumbel_key) of the documents drawn."""
    scored, least = threshold(docs, log_weight(fit(docs, labels, id_col, text_col, max_labelled)), id_col, text_col, k, share)
    return scored.where(F.col("gumbel_key") >= least)


def keep(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, k: int | None = None,
         share: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, with all their columns; nothing is shuffled."""
    weight = log_weight(fit(docs, labels, max_labelled=max_labelled))
    _, least = threshold(docs, weight, k=k, share=share)
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    key = weight(F.col(f"_c{names.index('text')}")) + gumbel(F.col(f"_c{names.index('doc_id')}"))
    return plain.where(key >= least).toDF(*names)


def op5_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")
