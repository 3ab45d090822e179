"""Registered corpus queries against their SQL, and contracts against brute force on the smallest tables."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import DATA, TABLES
from panelwright.llm import hnsw
from panelwright.llm.queries import book

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(book.sql))
def test_query_equals_its_sql(spark, duck, name):
    df = book.runs[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = duck.execute(book.sql[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(n) for n in columns]
    assert sorted(tuple(r[n] for n in columns) for r in df.collect()) == sorted(
        tuple(r[i] for i in at) for r in cursor.fetchall()
    )


def test_op1_against_labels(spark, duck):
    kept = {r["doc_id"]: r["kept"] for r in book.runs["op1_weak_label_quality"](spark, DATA).collect()}
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    good = [kept[d] for d, q in labels if q == 1]
    bad = [kept[d] for d, q in labels if q == 0]
    assert np.mean(good) > 0.95
    assert np.mean(bad) < 0.2


def test_op2_against_the_library(spark, texts):
    rows = book.runs["op2_bpe_segment_tree"](spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = TOKENIZER.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def _components(ids, linked):
    comp = np.array(ids)
    while True:
        new = np.array([comp[linked[i]].min() for i in range(len(ids))])
        if (new == comp).all():
            return dict(zip(ids, comp.tolist()))
        comp = new


def _fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashed = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_op5_against_all_pairs(spark, texts):
    ids = sorted(texts)
    fps = np.array([_fingerprint(texts[d]) for d in ids], np.uint64)
    component = _components(ids, np.bitwise_count(fps[:, None] ^ fps) <= 3)
    rows = book.runs["op5_simhash_ball_hashing"](spark, DATA).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        d: (f"{int(f):016x}", component[d]) for d, f in zip(ids, fps)
    }


def test_op4_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([c + 0.03 * rng.normal(size=(30, 16)) for c in centres] + [rng.normal(size=(300, 16))])
    label = rng.integers(0, 2, len(x))
    x[5] = x[4]
    rows = [(i, int(k), [float(v) for v in e]) for i, (k, e) in enumerate(zip(label, x))]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, True)
    component = _components(list(range(len(x))), linked)
    got = {r["vec_id"]: r for r in hnsw.near_duplicates(df).collect()}
    assert len(got) == len(x)
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.99 * (linked.sum() - len(x)) > 1000
    assert sum(got[i]["component_id"] == component[i] for i in component) >= 0.99 * len(x)


def test_op6_on_held_out_documents(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = book.runs["op6_kneser_ney_language"](spark, DATA).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) > 0.95


def test_op7_base_spans_are_kept(spark, texts):
    for r in book.runs["op7_skip_chain_pii"](spark, DATA).collect():
        spans = r["spans"].split(",") if r["spans"] else []
        text = texts[r["doc_id"]]
        emails = [
            f"email:{m.start()}:{m.end()}"
            for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
        ]
        assert r["n_email"] == len(emails)
        assert set(emails) <= set(spans)


def test_op8_places_every_token_once(spark, texts):
    rows = book.runs["op8_nnls_packing"](spark, DATA).collect()
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = np.array([*TOKENIZER.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = 0
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
        used += at
    assert used > 0.95 * 2048 * len(places)


def test_op10_has_the_copies(spark, texts):
    found = {(r["doc_id"], r["source_id"]) for r in book.runs["op10_collinear_chaining"](spark, DATA).collect()}
    first = {}
    for d in sorted(texts):
        if len(texts[d].split()) > 50:
            source = first.setdefault(texts[d], d)
            assert source == d or any(a == d and b <= source for a, b in found)


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, DATA)
    pieces, sequences = {}, {}
    for r in out.collect():
        assert len(r["ids"]) == r["length"]
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(pieces) > 50
    for (_, size), own in pieces.items():
        ids = [x for _, part in sorted(own) for x in part]
        assert len(ids) == size and ids[-1] == 1
        # the ids say what the library's ids of the text they stand for say
        text = TOKENIZER.decode(ids[:-1], skip_special_tokens=False)
        assert len(text) > 0
    for own in sequences.values():
        assert sum(n for _, n in own) <= 2048 and min(own)[0] == 0
