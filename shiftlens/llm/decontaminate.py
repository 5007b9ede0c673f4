"""Benchmark decontamination by the q-gram lemma.

A passage that matches a benchmark item of m characters with at most k edits
shares at least T = m + 1 - q * (k + 1) character q-grams with it, all on
diagonals (text position - item position) that lie within k of each other.
So, for each text and item:
1. shared q-grams are counted in overlapping diagonal bands of width 2(k+1)
   that start every k+1 diagonals: any k+1 neighbouring diagonals lie in one band;
2. bands with T or more shared q-grams are retained;
3. each retained region is verified: an exact occurrence is accepted at once,
   all others by banded alignment of the item against any substring.
k is ``error_rate`` (0.1) of the item's length, less for short items so that T stays
at least 1; the lemma never loses a match.

Texts and items are compared in lower case with white space runs as one space;
spans refer to the original text. Items are the stated query set: Spark deals them
evenly over files of about ``block_chars`` characters in the shared folder, each for
one pass over all documents; executors read a file, build its index and hold one at a time, the driver
knows the files' names only. A text is searched whole, but in pieces of ``PIECE`` characters:
a band's count is carried on until no later position can add to it, so beside
the text and its normalised form memory holds one piece, the retained bands and the passages found.
The documents are not shuffled.

Defined results: null or empty texts and items match nothing; items with fewer
than q characters have no q-gram: they match where they occur exactly between characters other
than letters and digits; repeated documents and
items match independently; null ids are returned as null. An item that a document holds several times
gives every passage that overlaps none with fewer edits or, at equal edits, farther left (inexact ones beside an exact
occurrence are not sought); other columns are ignored or, in ``decontaminate``,
returned as they are; empty tables give an empty result or, without any item, all documents.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, stored, table
from .token_files import open_fs

Q, ERROR_RATE, BLOCK_CHARS = 8, 0.1, 2_000_000
#: Characters of a text that are hashed at once, and shared q-grams that are counted at once.
PIECE, POSTINGS = 1 << 20, 1 << 21
_MULTIPLIER = 0x9E3779B97F4A7C15


def normalise(text: str | None, piece: int = PIECE) -> str:
    """Lower case, runs of white space as one space, none at the ends; by pieces, as the words of a
    long text as a list take many times its size."""
    text, out, space = (text or "").lower(), [], False
    for at in range(0, len(text), piece):
        part = text[at:at + piece]
        words = " ".join(part.split())
        if words and out and (space or part[0].isspace()):
            out.append(" ")
        space = part[-1].isspace()
        if words:
            out.append(words)
    return "".join(out)


def _positions(text: str) -> Iterator[int]:
    """For each character of ``normalise(text)``, its position in ``text``."""
    space = held = False
    for i, c in enumerate(text):
        if c.isspace():
            space = True
            continue
        if space and held:
            yield i - 1
        space, held = False, True
        for _ in c.lower():
            yield i


def original_spans(text: str, spans: Iterable[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int]]:
    """For each (start, end) of ``normalise(text)``, those of the same passage in ``text``."""
    spans, positions, upto, at = set(spans), _positions(text), 0, {}
    for p in sorted({p for a, z in spans for p in (a, z - 1)}):
        at[p] = next(islice(positions, p - upto, None))
        upto = p + 1
    return {(a, z): (at[a], at[z - 1] + 1) for a, z in spans}


def _codes(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _gram_hashes(codes, q: int):
    """A 64-bit hash of the q characters from each position on, put together from runs of 1, 2, 4, ... characters."""
    import numpy as np

    n = max(0, len(codes) - q + 1)
    run, length, power = codes + np.uint64(1), 1, _MULTIPLIER
    out, done = np.zeros(n, dtype=np.uint64), 0
    while True:
        if q & length:
            out = out * np.uint64(power) + run[done:done + n] if done else run[:n].copy()
            done += length
        if 2 * length > q:
            return out ^ out >> np.uint64(31)
        run = run[:-length] * np.uint64(power) + run[length:]
        length, power = 2 * length, power * power % (1 << 64)


def _within(numbers: list[int], low: int, high: int) -> bool:
    """True if one of the sorted ``numbers`` lies strictly between ``low`` and ``high``."""
    i = bisect.bisect_right(numbers, low)
    return i < len(numbers) and numbers[i] < high


def _disjoint(found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end), in this order, those that overlap none taken before; by start."""
    taken: list[tuple[int, int, int]] = []  # (start, end, edits), disjoint and so sorted by either
    for e, a, z in sorted(found):
        i = bisect.bisect_left(taken, (a, z, e))
        if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or z <= taken[i][0]):
            taken.insert(i, (a, z, e))
    return [(e, a, z) for a, z, e in taken]


class Items:
    """The q-gram index of one block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, error_rate: float = ERROR_RATE):
        import numpy as np

        plain = [(i, normalise(t)) for i, t in items]
        held = [(i, t) for i, t in plain if len(t) >= q]
        self.q, self.ids, self.texts = q, [i for i, _ in held], [t for _, t in held]
        #: items without a q-gram: length -> text -> numbers, which follow those of the others in ``all_ids``
        self.short: dict[int, dict[str, list[int]]] = {}
        self.all_ids = list(self.ids)
        for i, t in plain:
            if 0 < len(t) < q:
                self.short.setdefault(len(t), {}).setdefault(t, []).append(len(self.all_ids))
                self.all_ids.append(i)
        m = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.m = m
        self.k = np.minimum((m * error_rate).astype(np.int64), (m - q) // q)
        self.least = m + 1 - q * (self.k + 1)
        hashes = [_gram_hashes(_codes(t), q) for t in self.texts]
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(held)), [len(x) for x in hashes])
        at = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.at = item[order], at[order]
        self.grams, self.first = np.unique(h[order], return_index=True)
        self.first = np.append(self.first, len(h))
        self.bitmap = np.zeros(1 << 22, dtype=bool)
        self.bitmap[self.grams >> np.uint64(42)] = True

    def _shared(self, joined: str) -> Iterator[tuple]:
        """(positions, gram numbers, a position before which no later q-gram lies) of the q-grams that items hold,
        about ``POSTINGS`` of the items' q-grams at a time."""
        import numpy as np

        for low in range(0, len(joined) - self.q + 1, PIECE):
            h = _gram_hashes(_codes(joined[low:low + PIECE + self.q - 1]), self.q)
            pos = np.flatnonzero(self.bitmap[h >> np.uint64(42)])
            gram = np.searchsorted(self.grams, h[pos])
            gram[gram == len(self.grams)] = 0
            same = self.grams[gram] == h[pos]
            pos, gram = pos[same] + low, gram[same]
            upto = np.cumsum(self.first[gram + 1] - self.first[gram])
            at = 0
            while at < len(pos):
                end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + POSTINGS, side="right"))
                end = max(end, at + 1)
                yield pos[at:end], gram[at:end], int(pos[end]) if end < len(pos) else low + PIECE
                at = end

    def _regions(self, texts: list[str]):
        """(text number, item, first diagonal) of the retained bands."""
        import numpy as np

        found = [np.zeros((0, 3), dtype=np.int64)]
        if not self.ids:
            return found[0]
        joined = "\n".join(texts)  # no normalised text or item has a line break
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        top = int(self.m.max())
        # numbers of bands: one beyond the last of the longest text, so that the one after a band is of the same text and item
        bands = (max(map(len, texts)) + top) // int(self.k.min() + 1) + 2
        held, n, before = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0

        def place(keys):
            """Text, item, band, and the last position that can add to the band or to the one after it."""
            pair, band = np.divmod(keys, bands)
            text, item = np.divmod(pair, len(self.ids))
            return text, item, band, starts[text] + (band + 2) * (self.k[item] + 1) - 1 - top + self.m[item] - self.q

        def retained(upto):
            # a band of width 2(k+1) is two neighbours of width k+1; it is named by the first of them
            keys = np.union1d(held, held[held % bands > 0] - 1)
            text, item, band, last = place(keys)
            done = (before <= last) & (last < upto)  # the others were judged before, or are still open
            keys, text, item, band = keys[done], text[done], item[done], band[done]

            def count(keys):
                i = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                return np.where(held[i] == keys, n[i], 0)

            kept = count(keys) + count(keys + 1) >= self.least[item] if len(keys) else np.zeros(0, dtype=bool)
            return np.stack([text[kept], item[kept], band[kept] * (self.k[item[kept]] + 1) - top], axis=1)

        for pos, gram, upto in self._shared(joined):
            keys, counts = self._bands(pos, gram, starts, bands)
            held, where = np.unique(np.concatenate([held, keys]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n, counts]), minlength=len(held)).astype(np.int64)
            found.append(retained(upto))
            still = place(held)[3] >= upto
            held, n, before = held[still], n[still], upto
        found.append(retained(len(joined) + int((2 * self.k + 2 + self.m).max()) + 1))
        return np.concatenate(found)

    def _bands(self, pos, gram, starts, bands: int):
        """Sorted numbers of (text, item, band of width k+1), and the shared q-grams in each."""
        import numpy as np

        size = self.first[gram + 1] - self.first[gram]
        post = np.repeat(self.first[gram], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        item = self.item[post]
        text = np.searchsorted(starts, pos, side="right") - 1
        diagonal = np.repeat(pos - starts[text], size) - self.at[post] + int(self.m.max())  # from 1 on
        key = (np.repeat(text, size) * len(self.ids) + item) * bands + diagonal // (self.k[item] + 1)
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        return key[new], np.diff(new, append=len(key))

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, start, end, edits) in normalised texts: the best passage of each pair."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        unsure: dict[int, list[tuple[int, int]]] = {}
        for text, item, first in self._regions(texts).tolist():
            k, m, t = int(self.k[item]), int(self.m[item]), texts[text]
            at = t.find(self.texts[item], max(0, first - k), max(0, first + 2 * (k + 1) + k + m))
            if at >= 0:
                best[text, item] = min(best.get((text, item), (0, at, at + m)), (0, at, at + m))
            elif k:
                unsure.setdefault(item, []).append((text, first))
        for item, regions in unsure.items():
            regions = [r for r in regions if best.get((r[0], item), (1,))[0] > 0]
            for i in range(0, len(regions), 256):
                part = regions[i:i + 256]
                for (text, _), found in zip(part, self._align(item, part, texts), strict=True):
                    if found[0] <= self.k[item]:
                        best[text, item] = min(best.get((text, item), found), found)
        for text, item, a, z in self._short_matches(texts):
            best.setdefault((text, item), (0, a, z))
        return [(text, item, a, z, e) for (text, item), (e, a, z) in sorted(best.items())]

    def passages(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, start, end, edits) in normalised texts: all disjoint passages. A retained region
        gives its leftmost exact occurrence or its best alignment; two passages that do not overlap start too far apart
        for one region. Of overlapping ones the one with fewer edits stays, then the one that starts first."""
        found: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
        unsure: dict[int, list[tuple[int, int]]] = {}
        for text, item, first in self._regions(texts).tolist():
            k, m = int(self.k[item]), int(self.m[item])
            at = texts[text].find(self.texts[item], max(0, first - k), max(0, first + 2 * (k + 1) + k + m))
            if at >= 0:
                found.setdefault((text, item), set()).add((0, at, at + m))
            elif k:
                unsure.setdefault(item, []).append((text, first))
        for item, regions in unsure.items():
            k, m = int(self.k[item]), int(self.m[item])
            exact = {t: sorted(a for _, a, _ in found.get((t, item), ())) for t in {t for t, _ in regions}}
            # whatever starts in a region this close to an exact occurrence overlaps it
            regions = [(t, first) for t, first in regions
                       if not _within(exact[t], first + 3 * k + 2 - (m - k), first - k + (m - k))]
            for i in range(0, len(regions), 256):
                part = regions[i:i + 256]
                for (text, _), (e, a, z) in zip(part, self._align(item, part, texts), strict=True):
                    if e <= k:
                        found.setdefault((text, item), set()).add((e, a, z))
        for text, item, a, z in self._short_matches(texts):
            found.setdefault((text, item), set()).add((0, a, z))
        return [(text, item, a, z, e) for (text, item), held in sorted(found.items()) for e, a, z in _disjoint(held)]

    def _short_matches(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text number, item number, start, end) of the exact occurrences, left to right, of items below q characters
        that stand between characters other than letters and digits."""
        import numpy as np

        if not self.short:
            return
        joined = "\n".join(texts)
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        wanted = {size: np.concatenate([_gram_hashes(_codes(t), size) for t in numbers]) for size, numbers in self.short.items()}
        for low in range(0, len(joined), PIECE):
            codes = _codes(joined[low:low + PIECE + self.q])
            for size, numbers in self.short.items():
                h = _gram_hashes(codes, size)[:PIECE]
                for pos in (np.flatnonzero(np.isin(h, wanted[size])) + low).tolist():
                    if (joined[pos:pos + size] in numbers and not joined[max(0, pos - 1):pos].isalnum()
                            and not joined[pos + size:pos + size + 1].isalnum()):
                        text = int(np.searchsorted(starts, pos, side="right")) - 1
                        for item in numbers[joined[pos:pos + size]]:
                            yield text, item, pos - int(starts[text]), pos + size - int(starts[text])

    def _align(self, item: int, regions: list[tuple[int, int]], texts: list[str]) -> list[tuple[int, int, int]]:
        """(edits, start, end) of the best alignment of the item in each region's band of diagonals."""
        import numpy as np

        k, m = int(self.k[item]), int(self.m[item])
        width = 2 * (k + 1) + 2 * k
        low = np.array([first - k for _, first in regions], dtype=np.int64)
        size = np.array([len(texts[t]) for t, _ in regions], dtype=np.int64)
        # characters at low .. low + m + width; outside the text there is none that matches
        window = np.zeros((len(regions), m + width + 1), dtype=np.uint64)
        for r, (t, _) in enumerate(regions):
            a, z = max(0, int(low[r])), min(int(size[r]), int(low[r]) + m + width + 1)
            if a < z:
                window[r, a - low[r]:z - low[r]] = _codes(texts[t][a:z])
        target = _codes(self.texts[item])
        # a cell holds edits * 2**40 + where the passage starts: the minimum takes fewest edits, then leftmost
        one, never = np.int64(1 << 40), np.int64(1 << 60)
        column = np.arange(width, dtype=np.int64)
        end = low[:, None] + column
        left = np.arange(len(regions))
        cell = np.where((end >= 0) & (end <= size[:, None]), end, never)
        steps = column * one
        for j in range(1, m + 1):
            end = end + 1
            step = cell + np.where(window[:, j - 1:j - 1 + width] == target[j - 1], 0, one)
            skip = np.concatenate([cell[:, 1:], np.full((len(cell), 1), never)], axis=1) + one
            cell = np.minimum(step, skip)
            cell[(end < 0) | (end > size[:, None])] = never
            cell = np.minimum.accumulate(cell - steps, axis=1) + steps  # characters of the text left out
            cell[(end < 0) | (end > size[:, None])] = never
            if j % 16 == 0:  # edits never fall: regions beyond the budget are done
                open_ = cell.min(axis=1) >> 40 <= k
                cell, end, window, size, left = cell[open_], end[open_], window[open_], size[open_], left[open_]
                if not len(left):
                    break
        out = [(m, 0, 0)] * len(regions)
        for r, row, e in zip(left.tolist(), cell, end, strict=True):
            at = int(row.argmin())
            out[r] = (int(row[at] >> 40), int(row[at] & (1 << 40) - 1), int(e[at]))
        return out


def blocks(bench: DataFrame, block_chars: int = BLOCK_CHARS) -> list[str]:
    """Files that hold the items, of about ``block_chars`` characters each, in the shared folder."""
    src = pick(bench, id="item_id", text="text").select(F.col("id").cast("bigint").alias("id"), "text").where("text <> ''")
    chars = src.agg(F.sum(F.length("text"))).first()[0]
    return sorted(stored(src.repartition(-(-chars // block_chars)), "benchmark-items").inputFiles()) if chars else []


_LAST: dict[tuple, Items] = {}


def _index(file: str, q: int, error_rate: float) -> Items:
    """The index of a file of items, built on the executor; a Python worker keeps that of its last file."""
    import pyarrow.parquet as pq

    if (file, q, error_rate) not in _LAST:
        _LAST.clear()
        fs, path = open_fs(file)
        held = pq.read_table(path, filesystem=fs, partitioning=None)
        _LAST[file, q, error_rate] = Items(list(zip(held["id"].to_pylist(), held["text"].to_pylist(), strict=True)), q, error_rate)
    return _LAST[file, q, error_rate]


def _parts(batch, text_at: int, chars: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of slices of about ``chars`` characters."""
    low, held, size = 0, [], 0
    for i, t in enumerate(batch.column(text_at)):
        t = t.as_py()
        if held and size + len(t or "") > chars:
            yield low, held
            low, held, size = i, [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield low, held


def find_passages(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  q: int = Q, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits, passage): per document and item that it holds, all disjoint passages,
    as spans of the original text."""
    spark = docs.sparkSession
    src = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    schema = "doc_id bigint, item_id bigint, start int, end int, edits int, passage string"
    out = []
    for file in blocks(bench, block_chars):

        def run(batches: Iterator, file=file) -> Iterator:
            import pyarrow as pa

            kinds = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()),
                               ("end", pa.int32()), ("edits", pa.int32()), ("passage", pa.string())])
            items = _index(file, q, error_rate)
            for b in batches:
                for low, texts in _parts(b, 1):
                    rows = []
                    for i, found in groupby(items.passages([normalise(t) for t in texts]), lambda p: p[0]):
                        found = list(found)
                        spans = original_spans(texts[i], ((a, z) for _, _, a, z, _ in found))
                        for _, item, *span, e in found:
                            a, z = spans[tuple(span)]
                            rows.append({"doc_id": b.column(0)[low + i].as_py(), "item_id": items.all_ids[item], "start": a,
                                         "end": z, "edits": e, "passage": texts[i][a:z]})
                    yield pa.RecordBatch.from_pylist(rows, kinds)

        out.append(src.mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, out) if out else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, bench: DataFrame, q: int = Q, error_rate: float = ERROR_RATE,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    names = docs.columns
    text_at = names.index("text")
    out = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    for file in blocks(bench, block_chars):

        def run(batches: Iterator, file=file) -> Iterator:
            import numpy as np
            import pyarrow as pa

            items = _index(file, q, error_rate)
            for b in batches:
                clean = np.ones(b.num_rows, dtype=bool)
                for low, texts in _parts(b, text_at):
                    for m in items.matches([normalise(t) for t in texts]):
                        clean[low + m[0]] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*names)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
