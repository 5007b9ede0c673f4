"""Source divergence, whitening and language identification: methods against brute force, and edge cases."""

import random
import zlib

import duckdb
import numpy as np

from shiftlens.llm import language_id, source_divergence, whitening

WORDS = [a + b for a in ("ka", "Mo", "ri", "tU", "\u00e9l", "s") for b in ("", "n", "nde", "\u00df", "to\u0142")]


# -- 11 --

def test_transducer_gives_ordinals_and_is_minimal():
    r = random.Random(3)
    terms = sorted({bytes(r.choice(b"abc\xc3") for _ in range(r.randint(1, 6))) for _ in range(400)})
    made = source_divergence.Transducer.load(source_divergence.Transducer.of(terms).dump())
    tried = terms + [b"abcabcabc", b"zz", b"a" * 40] + [t + b"b" for t in terms[:50]]
    data = np.frombuffer(b" ".join(tried), np.uint8)
    start = np.cumsum([0] + [len(t) + 1 for t in tried[:-1]])
    end = start + np.array([len(t) for t in tried])
    place = {t: i for i, t in enumerate(terms)}
    want = [place.get(t, -1) for t in tried]
    assert made.ordinals(data, start, end).tolist() == want
    made.slot = None  # the same by bisection
    assert made.ordinals(data, start, end).tolist() == want
    prefixes = {t[:k] for t in terms for k in range(len(t) + 1)}
    rests = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes}
    assert len(made.final) == len(rests)


def test_pieces_never_cut_a_term():
    data = "ab \u00e9\u00e9\u00e9 c1D ".encode() * 50
    for window in (1, 2, 3, 7, 1000):
        parts = list(source_divergence.pieces(data, window))
        assert b"".join(parts) == data.translate(source_divergence.LOWER)
        found = [t for p in parts for t in source_divergence._TERM.findall(p)]
        assert found == source_divergence._TERM.findall(data.translate(source_divergence.LOWER))


def test_shares_are_exact_for_huge_counts():
    r = random.Random(1)
    count = [r.randrange(10**15) for _ in range(200)]
    total = [c + r.randrange(10**15) + 5 for c in count]
    got = source_divergence.shares(np.array(count), np.array(total))
    assert got.tolist() == [1 + 10**9 * (c + 5) // t for c, t in zip(count, total)]


def corpus():
    r = random.Random(8)
    rows = []
    for i in range(260):
        lang = r.choice(["en", "en", "de", None])
        source = r.choice(["a", "b", "\u00e9", "", None] if lang != "de" else ["a", "z"])
        words = r.choices(WORDS, [1 + (source == "a") * (k % 3) for k in range(len(WORDS))], k=r.randint(0, 30))
        rows.append((i, r.choice([" ", "1", "-\n"]).join(words), lang, source))
    rows += [rows[5]] * 4 + [(900, None, "xx", "only"), (901, "", "yy", "p"), (902, "kan", "yy", "q"), (None, "ka" * 10, None, None)]
    rows += [(903, "mo " + "kan tu " * 300, "en", "b")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, Lang string, term string, n long"


def test_divergence_equals_sql(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([(*r, "L", "t", 1) for r in rows], SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    want = sorted(con.execute(source_divergence.OP11_SQL).fetchall())
    assert {r[2] for r in want} == {"pair", "term"}
    assert sorted(map(tuple, source_divergence.audit(df).collect())) == want
    # many blocks, a sweep for each, tiny windows, long documents counted by Spark, many tiles
    monkeypatch.setattr(source_divergence, "LONG", 60)
    monkeypatch.setattr(source_divergence, "WINDOW", 64)
    monkeypatch.setattr(source_divergence, "FLUSH", 20)
    monkeypatch.setattr(source_divergence, "TILE_TERMS", 5)
    got = source_divergence.audit(df.repartition(5), block_terms=9, set_bytes=3000)
    assert sorted(map(tuple, got.collect())) == want


def test_divergence_of_nothing(spark):
    assert source_divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, None, None, None, "", "", 0)], SCHEMA)
    assert source_divergence.audit(one).count() == 0


# -- 12 --

VECS = "vec_id long, embedding array<double>, x array<long>, dims int, ID string"


def test_whitening_edge_cases(spark):
    r = np.random.default_rng(2)
    good = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((60, 5)) @ r.standard_normal((5, 5)))]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5),
           (105, [1.0, 2.0]), (106, [1e300] * 5), (None, [0.5] * 5), (7, good[7][1])]
    df = spark.createDataFrame([(i, v, [1], 3, "I") for i, v in good + odd], VECS).repartition(4)
    got = whitening.whiten(df, components=3).collect()
    used = [v for _, v in good] + [[0.5] * 5, good[7][1]]
    assert sorted((str(g.id), g.component) for g in got) == sorted(
        (str(i), k) for i in [*range(60), None, 7] for k in (1, 2, 3))
    x = np.floor(64 * np.array(used)).astype(np.int64) + 1_000_000
    matrix = np.cov(x.T, bias=True)
    value = np.linalg.eigvalsh(matrix)[::-1]
    assert {g.n for g in got} == {62} and max(g.identity_error for g in got) < 1e-9
    for g in got:
        assert abs(g.explained - value[g.component - 1] / value.sum()) < 1e-9
    assert len({(g.component, round(g.whitened, 9)) for g in got if g.id == 7}) == 3


def test_whitening_is_exact_for_large_values_and_leaves_out_what_has_no_variance(spark):
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) * 1e10, 3.0, r.uniform(-1, 1) * 1e10, r.uniform(-1, 1)]) for i in range(40)]
    rows = [(i, [*v, v[0]]) for i, v in rows]  # one constant dimension, one that repeats another
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in rows], VECS)
    points = whitening.fixed_points(df)
    n, total = whitening.sums(points)
    squares = whitening.square_sums(points, [s // n for s in total])
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows]
    m = [s // n for s in total]
    assert total == [sum(c) for c in zip(*x)]
    assert squares[0, 0] == sum((v[0] - m[0]) ** 2 for v in x)
    assert squares[0, 2] == sum((v[0] - m[0] + v[2] - m[2]) ** 2 for v in x)
    got = whitening.whiten(df).collect()
    want = {i: sum((n * c - s) ** 2 for c, s in zip(v, total)) for (i, _), v in zip(rows, x)}
    assert {(g.id, g.deviation) for g in got} == {(i, d if d < 1 << 63 else None) for i, d in want.items()}
    assert max(g.component for g in got) <= 3


def test_whitening_of_nothing(spark):
    assert whitening.whiten(spark.createDataFrame([], VECS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, None, None, None)], VECS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], None, None, None)], VECS)).count() == 0


# -- 13 --

def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(4)
    flat = language_id.initial(3, 4).astype(np.float64)
    data, length = r.integers(97, 110, (6, 9), dtype=np.uint8), np.array([9, 9, 7, 3, 1, 9])
    weight, label = np.arange(9) < length[:, None], np.array([0, 1, 2, 0, 1, 2])
    _, got = language_id.gradient(flat, data, length, weight, label, 3, 4)
    for i in [*np.flatnonzero(np.abs(got) > 1e-7)[::17], len(got) - 1]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (language_id.gradient(up, data, length, weight, label, 3, 4)[0]
                 - language_id.gradient(down, data, length, weight, label, 3, 4)[0]) / 2e-5
        assert abs(slope - got[i]) < 1e-7


def test_prediction_equals_the_trained_form_and_ignores_padding():
    r = np.random.default_rng(4)
    flat = language_id.initial(3)
    parts = [r.integers(32, 256, n, dtype=np.uint8).tobytes() for n in (1, 5, 17, 17, 40)]
    data, length, _ = language_id.padded(parts, 40)
    slow, _ = language_id.forward(flat, data, length, 3)
    fast = language_id.label_positions(flat, data, length, 3)
    assert np.abs(slow - fast).max() < 1e-5
    fast = fast.reshape(3, 40, 5)
    for i, part in enumerate(parts):
        own, n, _ = language_id.padded([part], len(part))
        alone = language_id.label_positions(flat, own, n, 3)
        assert np.abs(fast[:, :len(part), i] - alone).max() < 1e-5


def test_lowered_text_ends_between_characters():
    text = "\u00c9t\u00c9 \u4e2d\u6587 \U0001f600 Z" * 9
    for window in (1, 2, 5, 1000):
        assert b"".join(p for p, _ in language_id.lowered(text.encode(), window)) == text.lower().encode()


TEXTS = "doc_id long, text string, lang string, source string, label int, H string, `Text` string"
SOUNDS = {"aa": ["tak", "ruk", "mok"], "bb": ["lei", "soie", "mai"], "cc": ["sch\u00fc", "pf\u00f6", "tz\u00e4"]}


def spoken(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(SOUNDS[lang]) for _ in range(n))


def test_language_edge_cases(spark):
    rows = [(i, spoken(lang, i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !? \n", "bb"), (1003, "\u4e2d", None), (None, spoken("aa", 1), None),
           (1004, spoken("bb", 9, 200_000), None), (1005, spoken("cc", 3, 1), None), (1006, spoken("aa", 4).upper(), None)]
    copies = [(2000 + i, rows[0][1], "aa") for i in range(50)]
    df = spark.createDataFrame([(*r, "s", 1, "h", "T") for r in rows + odd + copies], TEXTS).repartition(3)
    got = {r.id: r for r in language_id.identify(df).collect()}
    assert len(got) == len(rows + odd + copies)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000].score == 0
    assert got[1004].lang_pred == "bb" and got[None].lang_pred == "aa" and not got[None].held_out
    assert got[1003].lang_pred in SOUNDS
    right = [got[i].lang_pred == lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(right) >= 0.95 * len(right)
    assert {got[2000 + i].lang_pred for i in range(50)} == {"aa"}


def test_language_with_little_or_nothing_to_learn_from(spark):
    assert language_id.identify(spark.createDataFrame([], TEXTS)).count() == 0
    none = spark.createDataFrame([(1, "tak", None, "", 0, "", "")], TEXTS)
    assert [(r.lang_pred, r.score) for r in language_id.identify(none).collect()] == [("und", 0.0)]
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    one = spark.createDataFrame([(i, "tak tak", "aa", "", 0, "", "") for i in ids], TEXTS)
    assert {(r.lang_pred, r.score) for r in language_id.identify(one).collect()} == {("aa", 1.0)}


def test_sample_is_bounded_per_language_and_counts_copies_once(spark):
    rows = [("aa", f"tak {i % 700}") for i in range(3000)] + [("aa", "mok")] * 3000 + [("bb", "lei")] * 5 + [(None, "x"), ("cc", None)]
    got = language_id.sample(spark.createDataFrame(rows, "lang string, text string"), lang_docs=100)
    n = {r["lang"]: r["count"] for r in got.groupBy("lang").count().collect()}
    assert n == {"aa": 100, "bb": 1}
    assert got.select("text").distinct().count() == 101
    few = language_id.sample(spark.createDataFrame(rows, "lang string, text string"), max_langs=1)
    assert {r.lang for r in few.select("lang").distinct().collect()} == {"aa"}
