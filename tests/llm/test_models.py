"""Quality resampling against a plain reimplementation; decontamination: short items, pieces of long texts, files of items."""

import math
import random
import resource

import numpy as np
from pyspark.sql import functions as F

from shiftlens.llm import decontaminate, quality

MASK = (1 << 64) - 1


def plain_buckets(text):
    """The n-grams of one text, counted one by one."""
    data = ["0" if "0" <= c <= "9" else c for c in text]
    raw = "".join(data).encode()
    out = []
    for i in range(len(raw) - 2):
        code = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
        out.append((code * quality._ODD & MASK) >> (65 - quality.TRIGRAMS.bit_length()))
    words = raw.split()
    hashes = [sum((c + 1) * pow(quality._ODD, j, 1 << 64) for j, c in enumerate(w)) & MASK for w in words]
    for a, b in zip(hashes, hashes[1:]):
        h = quality._REPEAT if a == b else (a * 31 + b) & MASK
        out.append(quality.TRIGRAMS + (((h ^ h >> 29) * quality._ODD & MASK) >> (65 - quality.PAIRS.bit_length())))
    return out


def corpus(n=80):
    r = random.Random(5)
    good, bad = "river stone bright walk under 1984 harbour".split(), "buy now now click 99 cheap win".split()
    return [(i, " ".join(r.choices(good if i % 3 else bad, k=r.randint(0, 60)))) for i in range(n)] + [(500, None), (501, "")]


def test_weights_and_draw_equal_a_plain_reimplementation(spark):
    docs = corpus()
    labels = [(i, int(i % 3 > 0)) for i in range(0, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    target_ids = {i for i, q in labels if q}
    counts = np.zeros((2, quality.BUCKETS))
    grams = {i: plain_buckets(t or "") for i, t in docs}
    for i, own in grams.items():
        for g in own:
            weight = min(1, quality.TEMPERED_COUNT / len(own))
            counts[0, g] += weight
            counts[1, g] += weight * (i in target_ids)
    ratio = np.zeros(quality.BUCKETS)
    for kind in (slice(0, quality.TRIGRAMS), slice(quality.TRIGRAMS, quality.BUCKETS)):
        raw, target = counts[:, kind]
        expected = raw * target.sum() / raw.sum()
        lift = (target + quality.PRIOR) / (expected + quality.PRIOR)
        ratio[kind] = np.log(lift) - math.log((raw / raw.sum() * lift).sum())
    noise = {r.id: r.g for r in df.select(F.col("doc_id").alias("id"), quality.gumbel(F.col("doc_id")).alias("g")).collect()}
    want = {i: ratio[own].sum() * min(len(own), quality.TEMPERED) / max(len(own), 1) for i, own in grams.items()}
    keys = sorted(((want[i] + noise[i], i) for i in want), reverse=True)
    for k, share in ((17, None), (None, 0.25), (None, None), (0, None), (10_000, None)):
        size = k if k is not None else round(share * len(docs)) if share else sum(w >= quality.LEAST for w in want.values())
        got = quality.resample(df, lab, k=k, share=share).collect()
        assert {r.id for r in got} == {i for _, i in keys[:size]}
        assert all(abs(r.log_weight - want[r.id]) < 1e-6 for r in got)
    assert {r.doc_id for r in quality.keep(df, lab, k=17).collect()} == {i for _, i in keys[:17]}


def test_windows_of_a_long_text_add_up():
    r = random.Random(2)
    text = "".join(r.choice(["a", "bc", " ", " ", "\n", "7", "\u00e9", "word", "  ", "\t"]) for _ in range(4000)) + "x" * 300 + " end"
    whole = np.bincount(quality.ngram_buckets([text])[0], minlength=quality.BUCKETS)
    assert np.bincount(plain_buckets(text), minlength=quality.BUCKETS).tolist() == whole.tolist()
    for window in (1, 2, 3, 17, 100, 10**6):
        assert quality.bucket_counts(text, window).tolist() == whole.tolist()
    assert quality.bucket_counts("").sum() == 0 and quality.bucket_counts(" \n ", 1).sum() == 1


def test_a_very_long_text_takes_bounded_memory():
    text = "some words and 12 numbers again " * 1_000_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert quality.bucket_counts(text).sum() == len(text) - 2 + 6 * 1_000_000 - 1
    grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before  # kilobytes
    assert grown < 300_000


def test_items_below_a_q_gram_match_exactly_between_other_characters(spark):
    items = [(1, "gsm 8k"), (2, "A1"), (3, "x"), (4, "gsm 8k"), (5, "  "), (6, None), (7, "a long item of many characters")]
    docs = [(10, "about GSM  8K here"), (11, "gsm 8kb and a12, xx"), (12, "(a1) x"), (13, "gsm 8k"), (14, ""), (15, None), (16, "x"),
            (17, "it says: A long item of many characterz!")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(10, 1), (10, 4), (12, 2), (12, 3), (13, 1), (13, 4), (16, 3), (17, 7)}
    for chars in (2_000_000, 5):  # one block, and a block for each item
        got = decontaminate.find_passages(d, b, block_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
        spans = {(r.doc_id, r.item_id): (r.passage, r.edits) for r in got}
        assert spans[10, 1] == ("GSM  8K", 0) and spans[12, 2] == ("a1", 0) and spans[17, 7][1] == 1
        assert {r.doc_id for r in decontaminate.decontaminate(d, b, block_chars=chars).collect()} == {11, 14, 15}


def test_short_items_equal_brute_force(spark):
    r = random.Random(3)
    items = [(i, "".join(r.choice("ab 1") for _ in range(r.randint(1, 7)))) for i in range(60)]
    docs = [(i, "".join(r.choice("ab 1.-") for _ in range(r.randint(0, 200)))) for i in range(60)]

    def inside(item, text):
        item, text = decontaminate.normalise(item), decontaminate.normalise(text)
        return item and any(text.startswith(item, p) and not text[max(0, p - 1):p].isalnum() and not text[p + len(item):p + len(item) + 1].isalnum()
                            for p in range(len(text)))

    got = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == {(d, i) for d, text in docs for i, item in items if inside(item, text)}


def test_every_disjoint_passage_is_returned(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(12)) for k in range(4)] + [(9, "x1")]

    def edited(text, n):
        s = list(text)
        for p in r.sample(range(2, len(s) - 2), n):
            s[p] = "z" if r.random() < 0.5 else s[p] + "z" if r.random() < 0.5 else ""
        return "".join(s)

    docs, want = [], {}
    for d in range(12):
        parts = []
        for _ in range(r.randint(0, 9)):
            i, text = r.choice(items)
            edits = 0 if i == 9 else r.choice([0, 0, 2, 5])
            # passages of an item also follow each other directly
            parts += [" ".join([edited(text, edits)] * r.choice([1, 1, 2]))] + ([prose(r.randint(1, 30))] if r.random() < 0.7 else [])
        docs.append((d, " ".join(parts)))
    docs.append((50, None))

    def ends(item, text):
        """Edits of the best match of the item that ends at each position, with its start."""
        row = [(0, j) for j in range(len(text) + 1)]
        for i, c in enumerate(item, 1):
            new = [(i, 0)]
            for j, x in enumerate(text, 1):
                new.append(min((row[j - 1][0] + (c != x), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
            row = new
        return row

    for d, text in docs:
        for i, item in items[:4]:
            k = min(int(len(item) * 0.1), (len(item) - 8) // 8)
            found, taken = sorted((e, a, z) for z, (e, a) in enumerate(ends(item, text or "")) if e <= k), []
            for e, a, z in found:
                if all(z <= b or y <= a for _, b, y in taken):
                    taken.append((e, a, z))
            want |= {(d, i, e, a): z for e, a, z in taken}
        low = text or ""
        want |= {(d, 9, 0, p): p + 2 for p in range(len(low)) if low.startswith("x1", p)
                 and not low[max(0, p - 1):p].isalnum() and not low[p + 2:p + 3].isalnum()}
    got = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string")).collect()
    told = {(x.doc_id, x.item_id, x.edits, x.start): x.end for x in got}
    assert len(told) == len(got) > 40 and max(e for _, _, e, _ in told) > 2
    assert told == want


def random_items_and_texts(r):
    word = lambda n: "".join(r.choice("abc ") for _ in range(n))
    items = [(i, word(r.randint(1, 60))) for i in range(30)]
    texts = [word(r.randint(0, 600)) + r.choice(items)[1] * r.randint(0, 3) + word(50) for _ in range(10)]
    return items, [decontaminate.normalise(t) for t in texts]


def test_a_search_in_pieces_finds_the_same(monkeypatch):
    r = random.Random(5)
    cases = [(*random_items_and_texts(r), r.choice([0.05, 0.1, 0.3])) for _ in range(6)]

    def search():
        out = []
        for items, texts, rate in cases:
            index = decontaminate.Items(items, error_rate=rate)
            out.append((sorted(map(tuple, index._regions(texts).tolist())), index.passages(texts), index.matches(texts)))
        return out

    whole = search()  # every text lies in one piece
    assert sum(len(regions) for regions, _, _ in whole) > 100 and sum(len(found) for _, found, _ in whole) > 300
    for piece, postings in ((13, 7), (64, 1), (500, 100)):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        monkeypatch.setattr(decontaminate, "POSTINGS", postings)
        assert search() == whole


def test_retained_bands_equal_a_plain_count():
    r = random.Random(8)
    for _ in range(3):
        items, texts = random_items_and_texts(r)
        index = decontaminate.Items(items, error_rate=0.2)
        top, want = int(index.m.max()), set()
        for t, text in enumerate(texts):
            for i, item in enumerate(index.texts):
                width, n = int(index.k[i]) + 1, {}
                for p in range(len(text) - 7):
                    for a in range(len(item) - 7):
                        if text[p:p + 8] == item[a:a + 8]:
                            band = (p - a + top) // width
                            n[band] = n.get(band, 0) + 1
                for band in {x for b in n for x in (b - 1, b) if x >= 0}:
                    if n.get(band, 0) + n.get(band + 1, 0) >= index.least[i]:
                        want.add((t, i, band * width - top))
        found = [tuple(x) for x in index._regions(texts).tolist()]
        assert set(found) == want and len(found) == len(want)


def test_normalised_in_pieces_and_spans_of_the_original():
    r = random.Random(4)
    for _ in range(100):
        text = "".join(r.choice(["a", "B", " ", "  ", "\n", "İ", "É", " ", "\x1c", "\U0001d400"]) for _ in range(r.randint(0, 60)))
        plain = " ".join(text.lower().split())
        assert all(decontaminate.normalise(text, piece) == plain for piece in (1, 2, 7, 1 << 20))
        spans = [(a, z) for a in range(len(plain)) for z in range(a + 1, len(plain) + 1) if plain[a] != " " and plain[z - 1] != " "]
        for (a, z), (b, y) in decontaminate.original_spans(text, spans).items():
            held = " ".join(text[b:y].lower().split())
            assert plain[a:z] in held and len(held) <= z - a + 2  # a capital I with a dot has two small characters


def test_a_very_long_text_is_searched_in_bounded_memory():
    text = "Some words  and 12 numbers again\n" * 1_000_000
    item = "one long passage that no other line of the whole text has, of its own"
    text += item.upper()
    index = decontaminate.Items([(1, item), (2, "own")])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = index.passages([decontaminate.normalise(text)])
    at = decontaminate.original_spans(text, [(a, z) for _, _, a, z, _ in found])
    assert [(item, e) for _, item, _, _, e in found] == [(0, 0), (1, 0)]
    assert [text[slice(*at[a, z])] for _, _, a, z, _ in found] == [item.upper(), "OWN"]
    grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before  # kilobytes
    assert grown < 400_000


def test_items_lie_in_files_of_about_one_block(spark):
    texts = [f"item number {i} of the benchmark, with some more words" for i in range(400)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a null id keeps its text"), (7, None), (8, "")],
                                  "item_id long, text string").repartition(3)
    files = decontaminate.blocks(bench, block_chars=1000)
    sizes = [spark.read.parquet(f).selectExpr("sum(length(text))").first()[0] for f in files[:5]]
    total = sum(map(len, texts)) + 24
    assert abs(len(files) - total / 1000) <= 1 and max(sizes) < 2000
    held = spark.read.parquet(*files).collect()
    assert sorted(r.text for r in held) == sorted([*texts, "a null id keeps its text"])
    docs = spark.createDataFrame([(1, f"say: {texts[3]}!"), (2, "A null id keeps its text"), (3, "clean")], "doc_id long, text string")
    got = decontaminate.find_passages(docs, bench, block_chars=5000).where("edits = 0").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 3), (2, None)}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench, block_chars=5000).collect()] == [3]
