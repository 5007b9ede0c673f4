"""The registered queries against SQL or brute force over the whole small tables."""

import base64
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
import corpus_pipeline
from shiftlens.llm import queries

SF = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(spark, name):
    return [r.asDict() for r in E.queries()[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def documents(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, con, name):
    got = E.queries()[name](spark, SF)
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    text = lambda r: tuple(map(str, r))
    assert sorted(text(r) for r in got.select(*names).collect()) == sorted(map(text, want.fetchall()))


def test_every_operator_has_one_query_and_the_pipeline_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup",
                                                      "benchmark_decontamination", "best_fit_packing"]


def test_op1_articles(spark, con):
    import html
    import re

    got = {r["page_id"]: r for r in rows(spark, "op1_html_extraction")}
    for page_id, source in con.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?p>|</?h1>", article)]
        assert got[page_id]["text"] == "\n".join(filter(None, blocks))
        assert got[page_id]["n_chars"] == len(got[page_id]["text"])


def test_op2_finds_every_exact_passage(spark, con, documents):
    norm = lambda t: " ".join(t.lower().split())
    items = {i: norm(t) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    texts = {d: norm(t) for d, t in documents.items()}
    want = {(d, i) for d, t in texts.items() for i, p in items.items() if p in t}
    got = rows(spark, "op2_decontamination")
    assert {(r["doc_id"], r["item_id"]) for r in got if r["edits"] == 0} == want
    for r in got:
        assert documents[r["doc_id"]][r["start"]:r["end"]] == r["passage"]
        assert r["edits"] or norm(r["passage"]) == items[r["item_id"]]


def plain_fingerprint(text, words=4):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_reachable(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_op3_fingerprints_and_components(spark, documents):
    fps = {d: plain_fingerprint(t) for d, t in documents.items()}
    ids = sorted(fps)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = smallest_reachable(ids, linked)
    got = {r["doc_id"]: r for r in rows(spark, "op3_simhash_dedup")}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {d: r["component_id"] for d, r in got.items()} == want


def library_ids(name, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_op4_round_trip(spark, documents):
    got = sorted(rows(spark, "op4_token_files"), key=lambda r: r["doc_id"])
    ids, start = sorted(documents), 0
    for doc, own, r in zip(ids, library_ids("byte_bpe_50k.json", [documents[d] for d in ids]), got, strict=True):
        own = np.array([*own, 0], dtype="<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, start, len(own))
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())
        start += len(own)


def test_op5_keeps_good_documents_and_drops_junk(spark, con):
    kept = {r["doc_id"] for r in rows(spark, "op5_quality_resampling")}
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    good, bad = ({d for d, q in labels if q == v} for v in (1, 0))
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def check_packing(got, ids_of, capacity=4096):
    pieces, places, total = {}, {}, 0
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids_of)
    for doc, own in pieces.items():
        ids, at = ids_of[doc], 0
        total += len(ids)
        for k, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            n = len(ids) if len(ids) <= capacity else min(capacity, len(ids) - at)
            assert (r["piece"], r["start"], r["length"]) == (k, at, n)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + n].tobytes())
            at += n
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(places) <= 1.01 * -(-total // capacity) + 1


def test_op8_whole_corpus(spark, documents):
    ids = sorted(documents)
    own = library_ids("word_bpe_49k.json", [documents[d] for d in ids])
    check_packing(rows(spark, "op8_best_fit_packing"),
                  {d: np.array([*x, 1], dtype="<u4") for d, x in zip(ids, own, strict=True)})


def test_pipeline_against_its_parts(spark, con, documents):
    got = rows(spark, "pipeline")
    kept = {r["doc_id"] for r in rows(spark, "op5_quality_resampling")}
    fps = {d: plain_fingerprint(documents[d]) for d in kept}
    ids = sorted(kept)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    first = {d for d, c in smallest_reachable(ids, linked).items() if d == c}
    leaks = {r["doc_id"] for r in rows(spark, "op2_decontamination")}
    left = sorted(first - leaks)
    own = library_ids("word_bpe_49k.json", [documents[d] for d in left])
    check_packing(got, {d: np.array([*x, 1], dtype="<u4") for d, x in zip(left, own, strict=True)})


def test_base32_is_the_digest_of_the_payload(spark, con):
    import hashlib

    got = {r["page_id"]: r["payload_digest"] for r in rows(spark, "op9_warc_archive")}
    for page_id, source in con.execute("SELECT page_id, html FROM pages").fetchall():
        assert got[page_id] == base64.b32encode(hashlib.sha1(source.encode()).digest()).decode()


def test_op12_whitens_the_whole_table(spark, con):
    got = rows(spark, "op12_embedding_whitening")
    table = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    x = np.floor(64 * np.array([v for _, v in table], np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    apart = (n * x - total) ** 2
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, int(d)) for (i, _), d in zip(table, apart.sum(axis=1))}
    centred = x - total / n
    value, axis = np.linalg.eigh(centred.T @ centred / n)
    white = np.zeros((n, 32))
    at = {i: k for k, (i, _) in enumerate(table)}
    for r in got:
        white[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert abs(r["explained"] - value[-r["component"]] / value.sum()) <= 1e-9
    assert np.abs(white.T @ white / n - np.eye(32)).max() < 1e-9
    want = centred @ axis[:, ::-1][:, :32] / np.sqrt(value[::-1][:32])
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-6


def test_op13_is_right_on_the_rows_it_never_saw(spark, con):
    got = {r["doc_id"]: r for r in rows(spark, "op13_language_id")}
    table = con.execute("SELECT doc_id, lang FROM documents").fetchall()
    assert {i: r["held_out"] for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in table}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    right = [got[i]["lang_pred"] == lang for i, lang in table if got[i]["held_out"] and lang]
    assert sum(right) >= 0.98 * len(right)
