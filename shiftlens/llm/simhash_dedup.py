"""SimHash near-dedup with pigeonring filtering.

A text's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of
its word shingles. Two fingerprints link when at most ``max_bits`` bits differ.

Candidates. The 64 bits are cut into m segments on a ring. If x and y differ in
at most t bits, some segment starts a chain along which the differences of its
first l segments sum to at most floor(l * t / m), for every l from 1 to m.
The equi-join key is a chain's first two segments, or more where the counted
fingerprints are so many that unrelated ones would share such a key (``chain_length``): one side
is indexed under its own bits, the other probes with every bit pattern that the budgets of
these prefixes allow. The longer prefixes of the chain are checked next, the full
Hamming distance last. Exact: the filter loses no link, and there are no caps.

Equal fingerprints are one node, so that copies are never paired; links become
components by the star rounds of ``common.components``.

Defined results: a null text counts as empty; a text without words has
fingerprint 0, which links like any other; a text with fewer words than the
shingle length is one shingle; repeated rows each keep their row; a null id
never is a component's smallest id unless the component has no other (then
null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, pick, stored, table

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
MOST_PATTERNS = 4096  # of all ring starts together: they are a literal of the plan


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint, as an unsigned integer."""
    import numpy as np
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(parts)
    if n == 0:
        return 0
    joined = b" ".join(parts)
    k = max(1, n - words + 1)
    starts = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    ends = starts[min(words, n):] - 1
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in
                       zip(starts[:k].tolist(), ends.tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, k, 65536):  # bounded memory for very long texts
        block = hashes[i:i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > k, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint's bits as a signed long."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("bigint")
    def fp(texts):
        import pyarrow as pa

        return pa.array([_signed(fingerprint(t.as_py(), words)) for t in texts], pa.int64())

    return fp(text)


def segments(m: int) -> list[tuple[int, int]]:
    """(first bit, length) of m segments that cover 64 bits, lengths one apart at most."""
    at = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def _mask(segs: list[tuple[int, int]]) -> int:
    return sum(((1 << n) - 1) << a for a, n in segs)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pattern_count(lengths: list[int], budgets: list[int]) -> int:
    """The number of bit patterns over segments of these lengths whose first 1, 2, ... segments hold at most
    ``budgets`` set bits."""
    ways = {0: 1}  # set bits so far -> patterns
    for n, most in zip(lengths, budgets, strict=True):
        now: dict[int, int] = {}
        for have, k in ways.items():
            for d in range(min(n, most - have) + 1):
                now[have + d] = now.get(have + d, 0) + k * comb(n, d)
        ways = now
    return sum(ways.values())


def chain_length(n: int, m: int, max_bits: int) -> int:
    """How many segments the join's key takes for ``n`` distinct fingerprints. A longer key is probed with more
    patterns and meets fewer fingerprints by chance: the length with the least rows probed and met, so that
    neither grows with the square of the corpus. Every length finds the same links."""
    segs, cost = segments(m), {}
    for length in range(2, max(3, m)):
        budgets = [j * max_bits // m for j in range(1, length + 1)]
        chains = [[segs[(i + j) % m][1] for j in range(length)] for i in range(m)]
        count = [pattern_count(c, budgets) for c in chains]
        if length == 2 or sum(count) <= MOST_PATTERNS:
            cost[length] = sum(k * (1 + n / 2 ** sum(c)) for k, c in zip(count, chains, strict=True))
    return min(cost, key=cost.get)


def probe_patterns(m: int, max_bits: int, length: int = 2) -> list[tuple[int, int, int]]:
    """(start, chain mask, bits to flip) for each ring start and each pattern of
    differences that the first ``length`` prefixes of a chain allow; masks as signed longs."""
    segs, out = segments(m), []
    for i in range(m):
        chain = [segs[(i + j) % m] for j in range(length)]
        step = [j for j, (_, n) in enumerate(chain) for _ in range(n)]
        bits = [x for a, n in chain for x in range(a, a + n)]
        for d in range(length * max_bits // m + 1):
            for at in combinations(range(len(bits)), d):
                # the k-th difference may come no sooner than the prefix whose budget is k
                if all(k <= (step[x] + 1) * max_bits // m for k, x in enumerate(at, 1)):
                    out.append((i, _signed(_mask(chain)), _signed(sum(1 << bits[x] for x in at))))
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, m: int | None = None, length: int | None = None) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct ``fp`` values that differ in at most ``max_bits`` bits. The join's key
    takes ``length`` segments, by default as many as suit the counted fingerprints."""
    m = m or max(2, max_bits + 1)
    length = length or chain_length(fps.count(), m, max_bits)
    segs = segments(m)

    def with_patterns(patterns, flip: bool) -> DataFrame:
        lit = F.array(*[F.struct(F.lit(i).alias("start"), F.lit(mask).cast("bigint").alias("mask"),
                                 F.lit(x).cast("bigint").alias("flip")) for i, mask, x in patterns])
        p = fps.select("fp", F.explode(lit).alias("p"))
        bits = F.col("fp").bitwiseXOR(F.col("p.flip")) if flip else F.col("fp")
        return p.select("fp", F.col("p.start").alias("start"), bits.bitwiseAND(F.col("p.mask")).alias("key"))

    patterns = probe_patterns(m, max_bits, length)
    probe = with_patterns(patterns, True).withColumnRenamed("fp", "a")
    index = with_patterns([p for p in patterns if p[2] == 0], False).withColumnRenamed("fp", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # the longer prefixes of the chain that begins at the key's first segment
    chain = F.lit(True)
    for prefix in range(length + 1, m):
        budget = prefix * max_bits // m
        for i in range(m):
            mask = _signed(_mask([segs[(i + j) % m] for j in range(prefix)]))
            ok = F.bit_count(diff.bitwiseAND(F.lit(mask).cast("bigint"))) <= budget
            chain = chain & ((F.col("start") != i) | ok)
    return (probe.join(index, ["start", "key"]).where(F.col("a") < F.col("b")).where(chain)
            .where(F.bit_count(diff) <= max_bits).select("a", "b").distinct())


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, first_id, root, component_id) for each distinct fingerprint of a stored frame (id, fp):
    its own smallest id, its component, and the smallest id that its links reach."""
    # equal fingerprints meet in a map-side combined aggregate, however many there are
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    linked = components(links(nodes.select("fp"), max_bits), "simhash")
    roots = nodes.join(linked, nodes["fp"] == linked["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return roots.join(smallest, "root").select("fp", "first_id", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id): one row per document; component_id is the smallest id reachable by links."""
    src = pick(docs, id=id_col, text=text_col)
    fps = stored(src.select("id", fingerprint_of(F.col("text"), words).alias("fp")), "simhash-fps")
    return fps.join(classes(fps, max_bits).drop("first_id", "root"), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their group: those whose
    doc_id is the group's smallest. Of repeated rows, and of several rows with that id, one stays."""
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"_c{names.index(c)}") for c in ("doc_id", "text"))
    fp = fingerprint_of(text, words)
    fps = stored(plain.select(doc_id.alias("id"), fp.alias("fp")), "simhash-fps")
    # several fingerprints of a component have its smallest id if that repeats, or if all its ids are null
    first = (classes(fps, max_bits).where(F.col("first_id").eqNullSafe(F.col("component_id")))
             .groupBy("root", "component_id").agg(F.min("fp").alias("_first_fp"))
             .select(F.col("component_id").alias("_first"), "_first_fp"))
    once = fps.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0
    # keyed by id: a fingerprint that a third of all rows share is no hot key. The texts are shuffled
    # once, at every size alike, rather than meeting a broadcast whose size grows with the corpus
    if once:
        kept = plain.join(first.hint("merge"), doc_id.eqNullSafe(F.col("_first")), "left_semi")
    else:  # ids that repeat: the text decides which of the rows is meant
        kept = (plain.withColumn("_fp", fp)
                .join(first.hint("merge"), doc_id.eqNullSafe(F.col("_first")) & (F.col("_fp") == F.col("_first_fp")),
                      "left_semi")
                .dropDuplicates([f"_c{names.index('doc_id')}", "_fp"]).drop("_fp"))
    return kept.toDF(*names)


def fingerprint_hex(fp) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")
