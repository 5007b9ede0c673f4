"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import io
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from shiftlens.llm import (chat_format, decontaminate, embedding_dedup, html_extraction, packing, quality, sharding,
                           simhash_dedup, token_files, warc_archive)
from shiftlens.llm.common import components
from shiftlens.llm.encode import Encoder
from shiftlens.session import scratch_dir

import public_tokenizers

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join("".join(r.choice(WORDS) for _ in range(r.randint(1, 2))) for _ in range(n))


LONG = prose(99, 60_000)
#: extra columns that clash with names the operators use, also in another letter case
DOCS = "doc_id long, text string, fp long, key string, ID string, id string, `Text` string"
ROWS = [(3, prose(1)), (1, prose(1)), (1, prose(1)), (None, prose(2)), (7, None), (8, ""), (9, " \n"), (10, LONG),
        (11, "one"), (-5, prose(3))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "k", "I", "i", "T") for i, t in ROWS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (5, 5)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long"), "t").collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_simhash(spark, docs, none):
    got = [(r.id, r.component_id) for r in simhash_dedup.simhash_components(docs).collect()]
    want = [(1, 1), (1, 1), (3, 1), (None, None), (7, 7), (8, 7), (9, 7), (10, 10), (11, 11), (-5, -5)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r[0]) for r in kept.collect())) == sorted(map(str, [1, None, 7, 10, 11, -5]))
    assert simhash_dedup.simhash_components(none).count() == 0 and simhash_dedup.keep_one(none).count() == 0


def test_simhash_links_are_all_found(spark):
    r, fps = random.Random(4), []
    for _ in range(150):
        f = r.getrandbits(64)
        fps.append(f)
        for _ in range(3):
            g = f
            for b in r.sample(range(64), r.randint(1, 6)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps))
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 4}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for m, length in ((4, None), (5, None), (7, None), (5, 2), (5, 3), (7, 3)):
        got = simhash_dedup.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 4, m, length).collect()
        assert len(got) == len(want)
        assert {frozenset((a % (1 << 64), b % (1 << 64))) for a, b in got} == set(map(frozenset, want))


def test_simhash_key_grows_with_the_number_of_fingerprints():
    for m, t, length in ((5, 4, 2), (5, 4, 3), (3, 2, 2), (9, 8, 2), (4, 6, 3)):
        budgets = [j * t // m for j in range(1, length + 1)]
        segs = simhash_dedup.segments(m)
        counts = [simhash_dedup.pattern_count([segs[(i + j) % m][1] for j in range(length)], budgets) for i in range(m)]
        patterns = simhash_dedup.probe_patterns(m, t, length)
        assert len(set(patterns)) == len(patterns) == sum(counts)
        for start, mask, flips in patterns:
            differs = [(flips >> a & (1 << n) - 1).bit_count() for a, n in (segs[(start + j) % m] for j in range(length))]
            assert flips & ~mask == 0 and all(c <= b for c, b in zip(np.cumsum(differs), budgets, strict=True))
    lengths = [simhash_dedup.chain_length(10**e, 5, 4) for e in range(13)]
    assert lengths[:8] == [2] * 8 and lengths[-1] == 3 and lengths == sorted(lengths)
    assert simhash_dedup.chain_length(0, 2, 1) == simhash_dedup.chain_length(10**12, 3, 2) == 2


def test_simhash_keeps_one_row_of_a_group_whose_id_repeats(spark):
    def near(seed):
        text = prose(seed, 300)
        own = simhash_dedup.fingerprint(text)
        return [text, next(t for t in (f"{text} {w}" for w in range(1000))
                           if 0 < (simhash_dedup.fingerprint(t) ^ own).bit_count() <= 4)]

    rows = [(i, t, "x") for i, seed in ((5, 1), (None, 2), (5, 3), (None, 4)) for t in near(seed)] + [(9, near(1)[1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = simhash_dedup.keep_one(df).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["5", "5", "None", "None"]
    assert len({t for r in kept for t in [r.text[:40]]}) == 4


def edited(text, n, seed):
    r, s = random.Random(seed), list(text)
    for _ in range(n):
        p, how = r.randrange(1, len(s) - 1), r.randrange(3)
        if how == 0:
            s[p] = r.choice("xyz")
        elif how == 1:
            s.insert(p, r.choice("xyz"))
        else:
            s.pop(p)
    return "".join(s)


def distance_to_substring(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination(spark, docs, none):
    items = [(k, prose(50 + k, 25)) for k in range(6)] + [(90, None), (91, ""), (92, "ab"), (93, prose(50, 25))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    texts = {100: prose(1) + "\n" + items[0][1].upper().replace(" ", "\t ") + " " + prose(2),
             101: prose(3) + " " + edited(items[1][1], 8, 1) + " " + prose(4), 102: LONG + " " + items[2][1],
             103: prose(5), 104: edited(items[3][1], 40, 2)}
    more = spark.createDataFrame([(i, t, 1, "k", "I", "i", "T") for i, t in texts.items()], DOCS).union(docs)
    norm = decontaminate.normalise
    want = {}
    for i, t in texts.items():
        for k, p in items:
            if p and len(norm(p)) >= 8 and i != 102:
                e = distance_to_substring(norm(p), norm(t))
                if e <= int(len(norm(p)) * 0.1):
                    want[i, k] = e
    want[102, 2] = 0
    got = decontaminate.find_passages(more, bench).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got} == want and len(got) == len(want)
    assert {i for i, _ in want} == {100, 101, 102}
    for r in got:
        assert texts[r.doc_id][r.start:r.end] == r.passage
    small = decontaminate.find_passages(more, bench, block_chars=200)  # several blocks of items
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, got))
    clean = decontaminate.decontaminate(more, bench)
    assert clean.columns == more.columns and clean.count() == more.count() - 3
    assert decontaminate.find_passages(none, bench).count() == 0
    assert decontaminate.find_passages(docs, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(ROWS)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    texts = ["", " ", "a  b \n c", "it's 12  34 x_y 'LL don'T", "a　b\xa0 c", "É \xc9", "x\xb2 \xb5 \xaa \xdf \xbfque?",
             "a\x1cb", "na\xefve \U0001f600 中文", "\t\t\n  z ", prose(1), "!!! ... \r\n", "\x85x \xad"]
    enc = Encoder(path)
    for _ in range(2):
        assert [list(np.frombuffer(b, "<u4")) for b in enc.ids([*texts, None])] == [
            tok.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_writes_added_tokens_as_the_library(path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    texts = ["page one<|endoftext|>page two", "a <|startoftext|> b", "<|endoftext|>", "x<|ENDOFTEXT|> <|end", "中<|endoftext|> é",
             "<|startoftext|><|endoftext|>\n<|endoftext|> z", prose(1) + " <|endoftext|> " + prose(2)]
    assert [list(np.frombuffer(b, "<u4")) for b in Encoder(path).ids(texts)] == [
        tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert tok.token_to_id("<|endoftext|>") in np.frombuffer(Encoder(path).ids(texts[:1])[0], "<u4")


def test_token_files(spark, docs, none):
    path = scratch_dir(spark, "tokens")
    manifest = token_files.write_documents(docs, path, BYTE, 0, shards=3)
    got = token_files.read_documents(spark, path, manifest).orderBy("start").collect()
    assert [r.id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    enc = Encoder(BYTE)
    want = sorted((str(i), enc.ids([t])[0] + bytes(4)) for i, t in ROWS)
    assert sorted((str(r.id), bytes(r.tokens)) for r in got) == want
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    files = [r.file for r in manifest.collect()]
    found = {k: v for f in files for k, v in token_files.lookup(path, f, [10]).items() if v}
    assert found[10] == [enc.ids([LONG])[0] + bytes(4)]
    empty = token_files.write_documents(none, scratch_dir(spark, "tokens"), BYTE, 0, shards=2)
    assert empty.count() == 0


def test_token_file_checksums():
    import pyarrow as pa
    import zstandard

    out = io.BytesIO()
    docs = [(5, b"\1\0\0\0" * 50), (6, b"\2\0\0\0"), (6, b"\3\0\0\0" * 9)]
    assert token_files.write_shard(out, iter(docs)) == (3, 60)
    data = out.getvalue()
    shard = token_files.Shard(pa.BufferReader(data))
    assert list(shard.read_all()) == docs and shard.read(1) == docs[1][1]
    # any zstandard reader gets all documents, and skips the rest
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(
        d for _, d in docs)
    with pytest.raises(token_files.BadFile):
        token_files.Shard(pa.BufferReader(data[:-1] + b"x"))
    table = bytearray(data)
    table[-9 - 12 * 4 + 8] ^= 1  # the first frame's checksum
    with pytest.raises(token_files.BadFile):
        token_files.Shard(pa.BufferReader(bytes(table))).read(0)


def test_quality(spark, docs, none):
    r = random.Random(0)
    rows = [(i, prose(i, r.randint(20, 200)) if i % 5 else " | ".join(prose(i, 60).split())) for i in range(400)]
    rows += [(400, None), (401, ""), (None, prose(7)), (3, rows[3][1]), (402, LONG), (403, "x | " * 40_000)]
    many = spark.createDataFrame([(i, t, 1, "k", "I", "i", "T") for i, t in rows], DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0, "x") for i in range(0, 400, 2)] + [(None, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = quality.keep(many, labels)
    kept = [x[0] for x in got.collect()]
    assert got.columns == many.columns
    assert {i for i in range(400) if i % 5} | {None, 402} <= set(kept) and kept.count(3) == 2
    assert not {i for i in range(400) if i % 5 == 0} & set(kept) and 403 not in kept
    again = sorted(str(x.id) for x in quality.resample(many, labels).collect())
    assert again == sorted(map(str, kept))
    assert quality.keep(none, labels).count() == 0 and quality.resample(none, labels).count() == 0
    quality.keep(docs, labels.limit(0)).count()


def test_quality_counts_very_long_documents(spark):
    rows = [(i, prose(1000 + i, 80_000) if i % 2 == 0 else f"{i} | x" * 140_000) for i in range(8)]
    assert all(len(t) + t.count(" ") > 512_000 for _, t in rows)
    many = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(4)], "doc_id long, quality int")
    ratios = quality.fit(many, labels)
    assert any(ratios)
    assert sorted(r.doc_id for r in quality.keep(many, labels).collect()) == [0, 2, 4, 6]
    n = np.bincount(quality.ngram_buckets([rows[0][1]])[0], minlength=quality.BUCKETS)
    assert np.dot(n, ratios) > 0  # the target's own texts are likelier in the target model


def test_kth_largest(spark):
    r = random.Random(2)
    values = [round(r.gauss(0, 3), 2) for _ in range(3000)] + [1.5] * 500 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 700, 1500, len(values)):
        assert quality.kth_largest(df, k, few=16) == ordered[k - 1]


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        v = rng.standard_normal(20)
        rows += [(10 * i, v, i % 3), (10 * i + 1, v * 3.0, i % 3)]
        for k in (2, 3, 4):
            rows.append((10 * i + k, v + rng.standard_normal(20) * rng.choice([0.05, 0.2, 0.3]), i % 3))
        rows.append((10 * i + 5, v, (i + 1) % 3))
    rows = [(i, [float(x) for x in v], lab) for i, v, lab in rows]
    rows += [rows[0], (2000, None, 1), (2001, [0.0] * 20, 1), (2002, [1.0, None], 1), (2003, [float("nan")] * 20, 1),
             (2004, [float("inf")] * 20, 1), (2005, rows[0][1], None), (2006, [], 1), (2007, [1.0, 0.0], 1),
             (2008, [1e200, 0.0], 1), (2009, [1e-200, 1e-220], 1), (None, [5.0, 0.0], 1)]
    df = spark.createDataFrame([(i, v, lab, 1) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, v int")
    ok = [i for i, (_, v, lab) in enumerate(rows) if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)]

    def cosine(a, b):
        a, b = (np.array(x) / np.abs(x).max() for x in (a, b))
        return a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)

    near = [(a, b) for a in ok for b in ok if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])
            and cosine(rows[a][1], rows[b][1]) >= 0.98]
    n, root = [0] * len(rows), list(range(len(rows)))
    for a, b in near:
        n[a] += 1
        n[b] += 1
    for _ in rows:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    least = {}
    for i, r in enumerate(root):
        least[r] = min((x for x in (least.get(r), rows[i][0]) if x is not None), default=None)
    want = sorted(str((rows[i][0], n[i], least[root[i]])) for i in range(len(rows)))
    got = embedding_dedup.embedding_components(df)
    assert sorted(str((r.id, r.n_links, r.component_id)) for r in got.collect()) == want
    assert embedding_dedup.embedding_components(df.limit(0)).count() == 0


def test_blocks_within_the_radius_are_kept():
    rng = np.random.default_rng(8)
    x = rng.uniform(-40, 40, (4000, 6))  # in units of the radius, beyond what 16 bits hold
    step = rng.standard_normal(x.shape)
    step /= np.sqrt((step * step).sum(axis=1, keepdims=True))
    length = np.concatenate([np.ones(2000), rng.uniform(1.01, 20, 2000)])
    a, b = (embedding_dedup.packed(v, 2).view(np.uint64) for v in (x, x + step * length[:, None]))
    gap = [(int(p) >> s & 0xFFFF) - (int(q) >> s & 0xFFFF) for r in zip(a, b, strict=True)
           for p, q in zip(*r, strict=True) for s in range(0, 64, 16)]
    gap = np.array([(g + 0x8000) % 0x10000 - 0x8000 for g in gap], dtype=float).reshape(4000, 8)
    near = (gap * gap).sum(axis=1) <= int((embedding_dedup.UNITS + 8**0.5) ** 2) + 1
    assert near[:2000].all() and not near[2000:].any()


def test_candidates_are_within_the_budget_of_a_block(spark):
    rng = np.random.default_rng(9)
    v = rng.standard_normal((300, 24))
    v = np.concatenate([v, v[:100] + rng.standard_normal((100, 24)) * 0.15])
    df = spark.createDataFrame([(i, [float(c) for c in x], 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    _, found = embedding_dedup.unit_classes(df, "vec_id", "embedding", "label")
    place = {r.cls: r.first_id for r in found.collect()}
    got = {tuple(sorted((place[r.a], place[r.b]))) for r in embedding_dedup.candidates(found).collect()}
    turned = v / np.sqrt((v * v).sum(axis=1, keepdims=True)) @ embedding_dedup.rotation(24)
    least = np.min([((turned[:, None, a:a + 8] - turned[None, :, a:a + 8]) ** 2).sum(axis=2) for a in (0, 8, 16)], axis=0)
    i, j = np.triu_indices(len(v), 1)
    sure, possible = (set(zip(i[near].tolist(), j[near].tolist(), strict=True))
                      for near in (least[i, j] <= 0.04 / 3, least[i, j] <= 0.04 / 3 * 1.01))
    assert len(sure) > 50 and sure <= got <= possible


def test_sharding(spark, docs, none):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    share = np.bincount(table)
    assert share.max() - share.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    kept = [a == b for a, b in zip(table, fewer, strict=True) if a != 6]
    assert np.mean(kept) > 0.7  # few slots move between the others
    got = sharding.assign(docs, "doc_id", names, 1009).collect()
    assert len(got) == len(ROWS) and all(r.shard == table[r.slot] for r in got)
    assert len({(r.key, r.slot) for r in got}) == len({i for i, _ in ROWS})
    assert sharding.assign(none, "doc_id").count() == 0
    for bad in (dict(names=[], slots=7), dict(names=["a", "a"], slots=7), dict(names=names, slots=1000)):
        with pytest.raises(ValueError):
            sharding.lookup_table(**bad)


def test_shards_on_disk_hold_every_row_and_column(spark, docs, none, tmp_path):
    names = [f"s{i}" for i in range(5)]
    table = sharding.lookup_table(names, 101)
    clash = docs.selectExpr("*", "'own' as Shard", "1.5 as slot", "array(doc_id) as `a.b`")
    got = sharding.write_shards(clash, str(tmp_path / "a"), "doc_id", names, 101)
    assert got.columns == ["doc_id", "text", "fp", "key", "ID", "id_5", "Text_6", "Shard_7", "slot_8", "a.b", "slot", "shard"]
    kept = got.collect()
    assert sorted((str(r[0]), r[1] or "null") for r in kept) == sorted((str(i), t or "null") for i, t in ROWS)
    assert all(r["shard"] == table[r["slot"]] and tuple(r)[2:10] == (1, "k", "I", "i", "T", "own", r[8], [r[0]]) for r in kept)
    assert {(r["doc_id"], r["slot"], r["shard"]) for r in kept} == {
        (r.key, r.slot, r.shard) for r in sharding.assign(docs, "doc_id", names, 101).collect()}
    held = {p.name for p in (tmp_path / "a").iterdir() if p.is_dir()}
    assert held == {f"shard={r['shard']}" for r in kept}
    assert sharding.write_shards(none, str(tmp_path / "b"), "doc_id").count() == 0


def test_packing_plan():
    r = random.Random(1)
    for _ in range(300):
        cap, counts, places, ranks = r.choice([7, 10, 30, 100]), {}, {}, {}
        for _ in range(r.randint(0, 40)):
            k = r.randint(1, cap)
            counts[k] = counts.get(k, 0) + r.choice([1, 1, 2, 5])
        for length, first, n, seq, per, base in packing.plan_runs(counts, cap):
            ranks.setdefault(length, []).extend(range(first, first + n))
            for i in range(n):
                places.setdefault(seq + i // per, []).append((base + i % per * length, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        for own in places.values():
            ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
            assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= cap
            assert sum(3 * n > cap for _, n in own) <= 2


def test_packing(spark, docs, none):
    got = packing.pack(docs, WORD, capacity=512).collect()
    enc = Encoder(WORD)
    want = sorted(zlib.crc32(x[a:a + 2048]) for x in (enc.ids([t])[0] + b"\1\0\0\0" for _, t in ROWS)
                  for a in range(0, len(x), 2048))
    assert sorted(r.ids_crc32 for r in got) == want
    seqs = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 512
    assert packing.pack(none, WORD).count() == 0


@pytest.fixture
def no_broadcast(spark):
    """Spark chooses no broadcast by itself either, as for inputs of terabytes."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packing_without_a_broadcast(spark, docs, monkeypatch, no_broadcast):
    told = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = packing.pack(docs, WORD, capacity=512).select(*told).collect()
    asked = []
    monkeypatch.setattr(packing, "small", lambda *a, **k: asked.append(1))
    got = packing.pack(docs, WORD, capacity=512).select(*told).collect()
    assert asked and sorted(map(str, got)) == sorted(map(str, want))


def test_warc_without_a_broadcast(spark, monkeypatch, no_broadcast):
    r = random.Random(6)
    rows = [(i, f"http://h{i % 7}.org", f"<p>{prose(i % 9)}</p>") for i in range(80)] + [(None, "n", f"<p>{prose(1)}</p>")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = warc_archive.with_references(df).collect()
    asked = []
    monkeypatch.setattr(warc_archive, "small", lambda *a, **k: asked.append(1))
    got = warc_archive.with_references(df)
    assert asked and got.columns == ["page_id", "url", "payload", "digest", "refers_to"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and sum(x.refers_to is None for x in want) == 9
    path = scratch_dir(spark, "warc")
    read = warc_archive.read_pages(spark, path, warc_archive.write_pages(df, path))
    assert read.where("record_type = 'response'").count() == 9 and read.count() == len(rows)


def test_html_without_a_broadcast(spark, monkeypatch, no_broadcast):
    side = f"<div class=teaser><p>{prose(7, 25)}</p></div>"
    rows = [(i, f"http://h{i % 3}.org/{i}", f"<body>{side}<div class=k{i % 3}><p>{prose(i, 60)}</p></div>") for i in range(30)]
    rows += [(90, None, f"<p>{prose(90)}</p>"), (91, "http://h1.org/91", None), (None, "http://h2.org/x", rows[2][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = html_extraction.extract(df).collect()
    monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", -1)
    got = html_extraction.extract(df)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_html(spark):
    page = ('<html><body class="has-sidebar"><div id="top-menu"><a href=x>Home</a></div><div class="cookie-notice">We use'
            ' cookies</div><main class="post-%d"><header><h1>T</h1></header><p>Hello <b>wor</b>ld &amp; co&nbsp;x<p>Second'
            '   para<ul><li>a<li>b</ul><form>Search</form><div class="ad-box">BUY</div><div class="comments"><p>a nice'
            ' comment</div><script>if(a<b){"</div>"}</script><table><tr><td>c1<td>c2</table><!-- c <p>no</p> --></main>'
            '<aside>side</aside><footer>foot')
    want = "Hello world & co x\nSecond para\na\nb\nc1\nc2"
    body = "<html><body><div><div class='x7'><p>" + "</p><p>".join(prose(k, 30) for k in range(3)) + "</p></div></div>"
    rows = [(1, "http://a.org/1", page % 1), (1, "http://a.org/1", page % 1), (2, "http://a.org/2", page % 22),
            (3, None, None), (4, "x", ""), (5, "http://b.org", "plain &lt;text&gt;\n only"), (6, "http://b.org/6", body),
            (None, "http://a.org/7", f"<main class=post-7><p>{LONG}")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_extraction.extract(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and text[1] == text[2] == want and text[3] == text[4] == ""
    assert text[5] == "plain <text> only" and text[6] == "\n".join(prose(k, 30) for k in range(3)) and text[None] == LONG
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_html_keeps_containers_that_a_class_word_calls_boilerplate():
    article, side = prose(1, 80), '<div class="sidebar">More</div><div class="cookie-notice">We use cookies</div>'
    for names in ('class="post category-social"', 'class="entry comments-open"', 'class="post tag-cookies"',
                  'class="post-7 format-widget tag-social"', 'class="post social"', 'class="elementor-widget"', 'id="promo"',
                  'class="widget"', 'class="sharing related"', 'class="content sidebar-left"'):
        page = html_extraction.Page(f"<body>{side}<div {names}><p>{article}</p></div>{side}")
        assert page.text([]) == article, names
    for names in ('class="comments"', 'id="respond"', 'class="cookie-consent"', 'role=banner', "hidden", 'class="comment-content"'):
        page = html_extraction.Page(f"<body><div class=x><p>short text</p></div><div {names}><p>{article}</p></div>")
        assert page.text([]) == "short text", names
    many = "".join(f'<div class="post category-promo"><p>{prose(k, 9)}</p></div>' for k in range(9))
    assert html_extraction.Page(f"<body>{side}{many}").text([]) == "\n".join(prose(k, 9) for k in range(9))
    page = html_extraction.Page("<article><p>If <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> then"
                                "<dialog>closed</dialog><dialog open>shown</dialog></article>")
    assert page.text([]) == "If a=2 then\nshown"


def test_html_hosts_with_many_layouts(spark):
    def page(k, layout):
        return layout % f"<p>{prose(2 * k, 60)}</p><p>{prose(2 * k + 1, 60)}</p>"

    teaser = f"<div class=teaser><p>{prose(7, 25)}</p></div><div class=author><p>{prose(8, 25)}</p></div>"
    hosts = {"many": [f"<body>{teaser}<article class=kind{chr(97 + n)}>%s</article>" for n in range(12)],
             "main": [f"<body>{teaser}<main><section class=x>{prose(9, 12)}</section><article class=k{chr(97 + n)}>%s</article></main>"
                      for n in range(4)],
             "plain": [f"<body><div><div class=t>{prose(9, 25)}</div><div class=x{chr(97 + n)}>%s</div></div>" for n in range(3)]}
    rows = [(name, k, layout) for name, own in hosts.items() for k, layout in enumerate(own * 6)]
    # two layouts of one page each, and a page whose article is shorter than a teaser
    rows += [("many", 90 + n, f"<body>{teaser}<article class=rare{chr(97 + n)}>%s</article>") for n in range(2)]
    short = f"<body><div class=teaser><p>{prose(7, 40)}</p></div><article class=kinda><p>{prose(3, 10)}</p></article>"
    df = spark.createDataFrame([(i, f"http://{h}.org/{k}", page(k, x)) for i, (h, k, x) in enumerate(rows)]
                               + [(-1, "http://many.org/s", short)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract(df).collect()}
    for i, (_, k, _) in enumerate(rows):
        assert got[i] == prose(2 * k, 60) + "\n" + prose(2 * k + 1, 60)
    assert got[-1] == prose(3, 10)


def test_warc(spark):
    r = random.Random(5)
    rows = [(i, f"http://h{i % 7}.org/p {i}\r\nX: y", f"<p>{prose(i % 40)}</p>") for i in range(120)]
    rows += [(500, None, None), (501, "u", ""), (39, "again", rows[119][2]), (119, "http://x", rows[119][2]),
             (None, "n", rows[3][2]), (600, "long", LONG)]
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, b"z") for x in rows], "page_id long, url string, html string, payload binary")
    path = scratch_dir(spark, "warc")
    got = warc_archive.read_pages(spark, path, warc_archive.write_pages(df.repartition(3), path)).collect()
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), largest[h or ""]
        want.append((i, len(data), warc_archive.base32_sha1(data), "response" if i == first else "revisit",
                     None if i == first else first))
    assert sorted(map(str, want)) == sorted(str((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to))
                                            for x in got)
    bodies = {x.page_id: bytes(x.payload) for x in got if x.record_type == "response"}
    assert bodies[600] == LONG.encode() and bodies[501] == b""
    least = scratch_dir(spark, "warc")
    all_own = warc_archive.read_pages(spark, least, warc_archive.write_pages(df, least, least_bytes=1 << 30))
    assert all_own.where("record_type = 'revisit'").count() == 0
    assert warc_archive.write_pages(df.limit(0), scratch_dir(spark, "warc")).count() == 0


def test_warc_archive_file():
    for n in (1, 500):
        out = io.BytesIO()
        records = [warc_archive.make_record(i, "http://x", prose(i, 400).encode(), "D", 1) for i in range(n)]
        kept = warc_archive.build_dictionary(records).as_bytes()
        assert warc_archive.write_archive(out, iter(records), kept) == n
        out.seek(0)
        assert list(warc_archive.read_archive(out, chunk=100)) == records
    assert warc_archive.write_archive(io.BytesIO(), iter([]), b"x") == 0


def test_warc_dictionary_sample(spark):
    shared = prose(1, 300)  # what all pages have in common
    pages = [(0, "http://x/0", "z" * 3_000_000)] + [(i, f"http://x/{i}", shared + prose(i, 30)) for i in range(1, 1500)]
    pages += [(i, "http://x/copy", "a copy " + shared) for i in range(2000, 3000)] + [(4000, None, None), (4001, "http://x/" + "y" * 9000, "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    referenced = warc_archive.with_references(df)
    sample = warc_archive.sample_records(referenced)
    assert len(sample) == warc_archive.SAMPLES == len({r for r in sample})  # no copy twice
    assert sample == warc_archive.sample_records(referenced.repartition(3))
    ids = [int(r.split(b"X-Page-ID: ")[1].split(b"\r\n")[0]) for r in sample]
    assert min(ids) < 150 and max(ids) > 1350 and sum(2000 <= i < 3000 for i in ids) <= 1
    assert max(map(len, warc_archive.sample_records(referenced, 51200))) < 100 + 4000 and warc_archive.sample_records(referenced.limit(0)) == []
    sizes = []
    for most in (1, warc_archive.SAMPLE_BYTES):
        path = scratch_dir(spark, "warc")
        read = warc_archive.read_pages(spark, path, warc_archive.write_pages(df, path, sample_bytes=most))
        got = {r.page_id: (r.payload_bytes, r.refers_to) for r in read.collect()}
        assert got == {i: (len(t or ""), 2999 if 2000 <= i < 2999 else 4001 if i == 4000 else None) for i, _, t in pages}
        sizes.append(sum(f.stat().st_size for f in Path(path.removeprefix("file:")).glob("*.zst")))
    assert sizes[1] < 0.8 * sizes[0]


def test_chat(spark):
    hard = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\s> [\\INST] <|im_end|>\n<|im_sep|><\\|im_start|>", "\\", "", None, "a\\n\nb", "$1 \\2",
            "<<s>> [[INST]]", LONG, "\U0001f600́"]
    roles = ["user", "assistant", "assistant", None, "sys\ntem\\n<s>", "user"]
    r, rows = random.Random(6), []
    for conv in (1, 2, None, 4):
        for turn in range(12):
            rows.append((conv, r.choice([turn, turn, None]), r.choice(roles), r.choice(hard)))
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame([(*x, "x") for x in rows], "conv_id long, turn int, role string, text string, t string")
    formatted = chat_format.format_conversations(df)
    got = {x.conv_id: x for x in chat_format.read_back(formatted).collect()}
    texts = {x.conv_id: x.formatted for x in formatted.collect()}
    for conv in (1, 2, None, 4):
        own = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == conv),
                     key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        assert [(t.role, t.text) for t in got[conv].turns] == [(x[2], x[3]) for x in own]
        assert got[conv].masked
        assert "".join(got[conv].loss_text) == "".join(x[3] for x in own if x[2] == "assistant")
        marks = texts[conv].replace(chat_format.START, "").replace(chat_format.END, "").replace(chat_format.SEP, "")
        assert not any(s in marks for s in ("<s>", "</s>", "[INST]", "[/INST]", "<|im_"))
    chat_format.digest(chat_format.read_back(formatted)).collect()
    assert chat_format.format_conversations(df.limit(0)).count() == 0
