"""Source divergence audit with a minimal acyclic transducer as the vocabulary.

Each language keeps the terms found in at least ``least`` of its documents. The
kept terms are sorted by Spark's range partitioning and cut into blocks; a task
turns each block into a minimal acyclic transducer: states with equal
continuations are one state, and the outputs on a term's arcs add up to its
lexicographic ordinal. All texts are then streamed through the transducers,
byte by byte for many terms at once, which recounts the kept terms as (lang,
source, ordinal, n). Ordinals stand for terms from there on and break ties.

Shares p = 1 + floor(10^9 * (n + 5) / (N + 5 * V)) are exact integers. A tile is a
range of ordinals of one language with the counts of all its sources; a task
sums the differences between sources over its tile and picks the tile's first
50 terms of each source, Spark adds up the sums and ranks.

Bounds: a block holds about ``BLOCK_TERMS`` terms. Transducers go to the executors in
sets of at most ``SET_BYTES``; a larger vocabulary takes further sweeps over the
documents of its languages, each with the next set. A tile holds at most
``TILE_CELLS`` counts (one ordinal of every source at least). Texts are read in
windows of 1 MB. No group of documents meets in a task, so hot sources and copies do not matter;
the rows of part ``pair`` are all pairs of sources in a language, as the report asks.

Defined results: null text, lang or source is ''; a text without terms still
makes its group occur; a language without kept terms gives only pairs of value
0; a source that is alone in its language gives no rows (nothing to differ from);
repeated rows count each time; columns beside the three are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, small, stored, table

LEAST_DOCS, TOP, SMOOTH, SCALE = 30, 50, 5, 1_000_000_000
BLOCK_TERMS, SET_BYTES, TILE_CELLS, TILE_TERMS = 1 << 17, 32 << 20, 1 << 20, 4096
WINDOW, LONG = 1 << 20, 4 << 20  # bytes of text at a time; above LONG a document's distinct terms are found by Spark
FLUSH = 200_000  # distinct terms counted in a task before they are handed on
DENSE = 1 << 22  # entries of a transducer's lookup table; beyond that arcs are found by bisection

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_TERM = re.compile(rb"[a-z\x80-\xff]+")  # in lower-cased UTF-8: the same terms as the pattern over code points
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")


def pieces(data: bytes, window: int = WINDOW) -> Iterator[bytes]:
    """``data`` in order, in parts of about ``window`` bytes that do not end inside a term."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + window) if at + window < len(data) else None
        end = gap.start() if gap else len(data)
        yield data[at:end].translate(LOWER)
        at = end


class Transducer:
    """Arcs sorted by (state, byte), each with its target and the ordinals it adds."""

    def __init__(self, key, to, add, final, root: int):
        import numpy as np

        self.key, self.to, self.add, self.final, self.root = key, to, add, final, root
        if len(final) << 8 <= DENSE:
            self.slot = np.full(len(final) << 8, -1, np.int32)
            self.slot[key] = np.arange(len(key), dtype=np.int32)
        else:
            self.slot = None

    @classmethod
    def of(cls, terms: list[bytes]) -> "Transducer":
        """Built from sorted distinct terms: the path of the last term stays open, and a state is
        closed, or replaced by an equal closed one, as soon as the next term leaves it."""
        import numpy as np

        closed: dict[tuple, int] = {}

        def close(node: list) -> int:
            return closed.setdefault((node[0], tuple(node[1])), len(closed))

        path, last = [[False, []]], b""

        def shorten(depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], close(node)))

        for term in terms:
            shared = 0
            for x, y in zip(last, term):
                if x != y:
                    break
                shared += 1
            shorten(shared)
            path.extend([False, []] for _ in range(len(term) - shared))
            path[-1][0] = True
            last = term
        shorten(0)
        root = close(path[0])
        below, key, to, add = [], [], [], []
        for state, (final, arcs) in enumerate(closed):  # targets are closed before the states that lead to them
            before = int(final)
            for byte, target in arcs:
                key.append(state << 8 | byte)
                to.append(target)
                add.append(before)
                before += below[target]
            below.append(before)
        return cls(np.array(key, np.int64), np.array(to, np.int64), np.array(add, np.int64),
                   np.array([s[0] for s in closed], bool), root)

    def dump(self) -> bytes:
        import io

        import numpy as np

        out = io.BytesIO()
        np.savez(out, key=self.key, to=self.to, add=self.add, final=self.final, root=self.root)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Transducer":
        import io

        import numpy as np

        with np.load(io.BytesIO(data)) as f:
            return cls(f["key"], f["to"], f["add"], f["final"], int(f["root"]))

    def ordinals(self, data, start, end):
        """The ordinal of each term data[start:end] (all of at least one byte), -1 if it is not kept."""
        import numpy as np

        out = np.full(len(start), -1, np.int64)
        who, pos = np.arange(len(start)), start
        state, total = np.full(len(start), self.root, np.int64), np.zeros(len(start), np.int64)
        while len(who) and len(self.key):
            key = state << 8 | data[pos]
            if self.slot is not None:
                arc = self.slot[key]
                known = arc >= 0
            else:
                arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                known = self.key[arc] == key
            arc, who, pos = arc[known], who[known], pos[known] + 1
            state, total = self.to[arc], total[known] + self.add[arc]
            over = pos == end[who]
            hit = over & self.final[state]
            out[who[hit]] = total[hit]
            on = ~over
            who, pos, state, total = who[on], pos[on], state[on], total[on]
        return out


def _documents(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    src = pick(docs, lang=lang_col, source=source_col, text=text_col)
    return src.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _texts(column) -> Iterator[bytes]:
    for i in range(len(column)):
        yield column[i].as_buffer().to_pybytes()


def document_counts(src: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents each term occurs."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: dict[str, Counter] = {}
        size = 0

        def rows(counted: dict[str, Counter], uid: int | None):
            for lang, terms in counted.items():
                if terms:
                    found = pa.array(list(terms), pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), found, pa.array(list(terms.values()), pa.int64()),
                         pa.array([uid] * len(found), pa.int64())], ["lang", "term", "n", "uid"])

        for batch in batches:
            langs, uids = batch.column("lang").to_pylist(), batch.column("uid").to_pylist()
            for lang, uid, data in zip(langs, uids, _texts(batch.column("text"))):
                if len(data) > LONG:
                    for piece in pieces(data):
                        yield from rows({lang: Counter(set(_TERM.findall(piece)))}, uid)
                    continue
                mine = seen.setdefault(lang, Counter())
                size -= len(mine)
                mine.update(set(_TERM.findall(data.translate(LOWER))))
                size += len(mine)
                if size > FLUSH:
                    yield from rows(seen, None)
                    seen, size = {}, 0
        yield from rows(seen, None)

    told = src.select("lang", "text", F.monotonically_increasing_id().alias("uid")).mapInArrow(
        run, "lang string, term string, n bigint, uid bigint")
    # the parts of one long document count once for each term
    once = told.groupBy("lang", "term", "uid").agg(F.sum("n").alias("n"))
    return once.groupBy("lang", "term").agg(
        F.sum(F.when(F.col("uid").isNull(), F.col("n")).otherwise(1)).alias("n"))


def vocabulary(src: DataFrame, least: int = LEAST_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, block, term): the kept terms; blocks are ranges of a language's sorted terms."""
    kept = stored(document_counts(src).where(F.col("n") >= least).select("lang", "term"), "divergence-kept")
    blocks = max(1, -(-kept.count() // block_terms))
    return stored(kept.repartitionByRange(blocks, "lang", "term").withColumn("block", F.spark_partition_id()),
                  "divergence-vocabulary")


def transducers(vocab: DataFrame) -> DataFrame:
    """(lang, block, n_terms, first, last, bytes, data, base): one transducer a block; ``base`` is its first ordinal."""

    def build(group):
        import pyarrow as pa

        terms = sorted(bytes(t, "utf-8") for t in group.column("term").to_pylist())
        data = Transducer.of(terms).dump()
        return pa.table({"lang": [group.column("lang")[0].as_py()], "block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                         "n_terms": [len(terms)], "first": [terms[0]], "last": [terms[-1]],
                         "bytes": [len(data)], "data": [data]})

    made = vocab.groupBy("lang", "block").applyInArrow(
        build, "lang string, block int, n_terms bigint, first binary, last binary, bytes bigint, data binary")
    made = stored(made, "divergence-transducers")
    before = Window.partitionBy("lang").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = made.select("lang", "block", F.coalesce(F.sum("n_terms").over(before), F.lit(0)).alias("base"))
    return made.join(base, ["lang", "block"])


def _sets(made: DataFrame, set_bytes: int) -> Iterator[list]:
    """Transducers in sets of at most ``set_bytes`` (at least one): only one set is held at a time."""
    sizes = made.select("lang", "block", "bytes").orderBy("lang", "block").toLocalIterator()
    size, keys = 0, []

    def fetch(keys: list) -> list:
        wanted = F.struct("lang", "block").isin([F.struct(F.lit(a), F.lit(b)) for a, b in keys])
        return made.where(wanted).collect()

    for row in sizes:
        if keys and size + row["bytes"] > set_bytes:
            yield fetch(keys)
            size, keys = 0, []
        size += row["bytes"]
        keys.append((row["lang"], row["block"]))
    if keys:
        yield fetch(keys)


def recount(src: DataFrame, made: DataFrame, set_bytes: int = SET_BYTES) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the kept terms, by streaming all texts through the transducers."""
    spark = src.sparkSession
    out = None
    for rows in _sets(made, set_bytes):
        held = spark.sparkContext.broadcast([(r["lang"], bytes(r["first"]), bytes(r["last"]), r["base"], bytes(r["data"]))
                                             for r in rows])
        langs = sorted({r["lang"] for r in rows})

        def run(batches: Iterator, held=held) -> Iterator:
            import numpy as np
            import pyarrow as pa

            of: dict[str, list] = {}
            for lang, first, last, base, data in held.value:
                of.setdefault(lang, []).append((first[:8], last[:8], base, Transducer.load(data)))
            in_term = np.zeros(256, bool)
            in_term[[*range(97, 123), *range(128, 256)]] = True

            def count(lang: str, parts: list[bytes], sources: list[int]):
                """(source, ordinal, n) of the parts."""
                data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
                edge = np.flatnonzero(np.diff(in_term[data], prepend=False, append=False))
                start, end = edge[0::2], edge[1::2]
                starts = np.cumsum([0] + [len(p) + 1 for p in parts])
                source = np.array(sources)[np.searchsorted(starts, start, side="right") - 1]
                found = []
                for first, last, base, machine in of[lang]:
                    mine = slice(None)
                    if len(of[lang]) > 1:  # only terms whose first bytes lie in the block's range
                        at = start[:, None] + np.arange(8)
                        head = np.where(at < end[:, None], data[np.minimum(at, len(data) - 1)], 0)
                        head = head.astype(np.uint8).copy().view(">u8")[:, 0]
                        lo, hi = (int.from_bytes(x.ljust(8, b"\0"), "big") for x in (first, last))
                        mine = np.flatnonzero((head >= lo) & (head <= hi))
                    ordinal = machine.ordinals(data, start[mine], end[mine])
                    hit = ordinal >= 0
                    found.append((source[mine][hit], ordinal[hit] + base))
                who, what = (np.concatenate(x) for x in zip(*found))
                if not len(who):
                    return who, what, what
                span = int(what.max()) + 1
                both, n = np.unique(who * span + what, return_counts=True)
                return both // span, both % span, n

            for batch in batches:
                names = batch.column("source").dictionary_encode()
                waiting: dict[str, list] = {}
                numbers = names.indices.to_pylist()
                plain = names.dictionary.to_pylist()

                def flush(lang: str):
                    parts, sources, _ = waiting.pop(lang)
                    who, what, n = count(lang, parts, sources)
                    return pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(who), pa.string()), pa.array([plain[i] for i in who], pa.string()),
                         pa.array(what, pa.int64()), pa.array(n, pa.int64())], ["lang", "source", "ordinal", "n"])

                for lang, number, data in zip(batch.column("lang").to_pylist(), numbers, _texts(batch.column("text"))):
                    for piece in pieces(data):
                        mine = waiting.setdefault(lang, [[], [], 0])
                        mine[0].append(piece)
                        mine[1].append(number)
                        mine[2] += len(piece)
                        if mine[2] >= WINDOW:
                            yield flush(lang)
                for lang in list(waiting):
                    yield flush(lang)

        told = src.where(F.col("lang").isin(langs)).select("lang", "source", "text").mapInArrow(
            run, "lang string, source string, ordinal bigint, n bigint")
        part = stored(told.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "divergence-counts")
        held.unpersist()
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")


def shares(counts, totals, scale: int = SCALE, smooth: int = SMOOTH):
    """1 + floor(scale * (n + smooth) / totals), exact: long division, three decimal digits at a time."""
    whole, rest = (counts + smooth) // totals, (counts + smooth) % totals
    while scale > 1:
        step = min(scale, 1000)
        rest = rest * step
        whole, rest, scale = whole * step + rest // totals, rest % totals, scale // step
    return whole + 1


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least: int = LEAST_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS, set_bytes: int = SET_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source differs from the others of its language
    (``pair``) and which terms it uses more than its language does (``term``)."""
    src = _documents(docs, text_col, lang_col, source_col)
    vocab = vocabulary(src, least, block_terms)
    made = transducers(vocab)
    counts = recount(src, made, set_bytes)
    groups = stored(src.select("lang", "source").distinct().join(
        counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "divergence-groups")
    langs = stored(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
             .join(made.groupBy("lang").agg(F.sum("n_terms").alias("v")), "lang", "left")
             .select("lang", F.coalesce("v", F.lit(0)).alias("v"),
                     F.expr(f"greatest(1, least({TILE_TERMS}, {TILE_CELLS} div sources))").alias("width")), "divergence-langs")
    langs = F.broadcast(langs) if small(langs, 256) else langs  # a join by language alone would gather its counts
    cells = counts.join(langs, "lang").select(
        "lang", F.expr("ordinal div width").alias("tile"), "source", "ordinal", "n", "v", "width")
    heads = groups.join(langs, "lang").select(
        "lang", F.explode(F.expr("sequence(0, greatest(0, (v - 1) div width))")).alias("tile"), "source",
        F.lit(-1).cast("bigint").alias("ordinal"), F.col("total").alias("n"), "v", "width")

    def tile(key, rows):
        import numpy as np
        import pyarrow as pa

        lang, at = (k.as_py() for k in key)
        ordinal, n, v, width = (rows.column(c).to_numpy() for c in ("ordinal", "n", "v", "width"))
        names = rows.column("source").combine_chunks().dictionary_encode()
        source, plain = names.indices.to_numpy(), names.dictionary.to_pylist()
        v, width = int(v[0]), int(width[0])
        first, size = at * width, max(0, min(width, v - at * width))
        head = ordinal < 0
        total = np.zeros(len(plain), np.int64)
        total[source[head]] = n[head]
        count = np.zeros((len(plain), size), np.int64)
        count[source[~head], ordinal[~head] - first] = n[~head]
        share = shares(count, (total + SMOOTH * v)[:, None]) if size else count
        whole = shares(count.sum(axis=0), total.sum() + SMOOTH * v) if size else count.sum(axis=0)
        out = []
        for i, name in enumerate(plain):
            apart = np.abs(share - share[i]).sum(axis=1)
            more = np.flatnonzero((count[i] > 0) & (share[i] > whole))
            gain = (share[i] - whole)[more]
            order = np.lexsort((more, -gain))[:top]
            others = [j for j in range(len(plain)) if j != i]
            out.append(pa.table({
                "lang": pa.array([lang] * (len(others) + len(order)), pa.string()),
                "source": pa.array([name] * (len(others) + len(order)), pa.string()),
                "item": pa.array([plain[j] for j in others] + [None] * len(order), pa.string()),
                "ordinal": pa.array(np.concatenate([np.full(len(others), -1), more[order] + first]), pa.int64()),
                "value": pa.array(np.concatenate([apart[others], gain[order]]), pa.int64())}))
        return pa.concat_tables(out)

    told = stored(cells.union(heads).groupBy("lang", "tile").applyInArrow(
        tile, "lang string, source string, item string, ordinal bigint, value bigint"), "divergence-tiles")
    pair = (told.where("ordinal < 0").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(
                Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))
    by_gain = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    term = (told.where("ordinal >= 0").withColumn("rank", F.row_number().over(by_gain)).where(F.col("rank") <= top)
            .join(ordinals(vocab, made), ["lang", "ordinal"])
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
    return pair.union(term)


def ordinals(vocab: DataFrame, made: DataFrame) -> DataFrame:
    """(lang, ordinal, term): a term's place among all kept terms of its language; a window holds one block."""
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    return vocab.withColumn("place", place).join(made.select("lang", "block", "base"), ["lang", "block"]).select(
        "lang", (F.col("base") + F.col("place")).cast("bigint").alias("ordinal"), "term")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT DISTINCT row, lang, unnest(terms) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= {LEAST_DOCS}
), groups AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occurring AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d)
  JOIN kept USING (lang, term) GROUP BY lang, source, term
), total AS (SELECT lang, source, sum(n) AS total FROM occurring GROUP BY lang, source),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0)::HUGEINT AS n, coalesce(t.total, 0)::HUGEINT AS total, v
  FROM groups g JOIN kept k USING (lang) JOIN size USING (lang)
  LEFT JOIN total t USING (lang, source) LEFT JOIN occurring o USING (lang, source, term)
), p AS (SELECT lang, source, term, n, 1 + ({SCALE} * (n + {SMOOTH})) // (total + {SMOOTH} * v) AS p FROM filled),
q AS (
  SELECT lang, term, 1 + ({SCALE} * (sum(n) + {SMOOTH})) // (sum(total) + {SMOOTH} * v) AS q
  FROM (SELECT lang, term, n::HUGEINT AS n, total::HUGEINT AS total, v FROM filled) GROUP BY lang, term, v
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INT) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INT) FROM terms
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
