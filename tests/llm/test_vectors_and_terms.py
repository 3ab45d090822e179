"""Top-k search, hard negatives and source divergence against brute force, with ties, odd rows and shared digests."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import divergence, negatives, topk, vectors

VECTOR_ROWS = "vec_id long, embedding array<double>, label int"
#: Names that the operators use inside.
CLASHES = ["row", "q", "norm2", "query", "score", "rank", "angles", "nearest", "block", "digest", "part", "value", "n"]


def _odd_vectors():
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    hot = rng.normal(size=6).tolist()
    rows += [(400 + i, hot, i % 2) for i in range(200)]  # ties in any number
    rows += [rows[0], rows[100], (100, rows[7][1], 1)]  # repeated rows, an id with another vector
    rows += [(700, None, 1), (750, [1.0, None, 0.0], 1), (None, hot, 1), (800, [float("nan")] * 6, 0)]
    rows += [(850, [float("inf")] * 6, 0), (900, [0.0] * 6, 0), (901, [0.0] * 6, 1), (950, hot, None), (-100, hot, 1)]
    return rows


def _frame(spark, rows):
    df = spark.createDataFrame(rows, VECTOR_ROWS)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def _whole(rows):
    return [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


def _products(rows):
    q = np.array([[int(np.floor(256 * x)) for x in r[1]] for r in rows], object)
    return q @ q.T


def _top_k(rows, k, every):
    rows = _whole(rows)
    score, out = _products(rows), []
    for i, r in enumerate(rows):
        if r[0] % every == 0:
            order = sorted((-score[i][j], rows[j][0]) for j in range(len(rows)) if j != i)[:k]
            out += [(r[0], n + 1, v, -s) for n, (s, v) in enumerate(order)]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_k_of_odd_rows(spark):
    rows = _odd_vectors()
    assert _rows(topk.search(_frame(spark, rows).repartition(7))) == _top_k(rows, 5, 50)


def test_top_k_of_few_and_no_rows(spark):
    rows = _odd_vectors()[:3] + [(50, [1.0] * 6, 1)]
    assert _rows(topk.search(_frame(spark, rows))) == _top_k(rows, 5, 50)
    one = [(50, [1.0], 1)]
    assert _rows(topk.search(_frame(spark, one))) == []
    assert _rows(topk.search(_frame(spark, rows).limit(0))) == []


@pytest.mark.parametrize("scale", [1.0, 1e3, 1e6])
def test_top_k_is_exact_for_large_numbers(spark, scale, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)  # several blocks of queries
    rng = np.random.default_rng(3)
    rows = [(i, (scale * rng.normal(size=9)).tolist(), 0) for i in range(120)]
    assert _rows(topk.search(_frame(spark, rows), k=4, every=20)) == _top_k(rows, 4, 20)


def test_products_beyond_64_bits_raise(spark):
    with pytest.raises(ValueError):
        topk.search(_frame(spark, [(50, [1e30, 1.0], 0), (1, [1e30, 1.0], 0)]))


def test_vectors_of_different_lengths(spark):
    rows = [(50, [1.0, 2.0], 0), (1, [1.0], 0), (2, [0.5, 1.0, 9.0], 0), (3, [], 0)]
    got = [(r["vec_id"], r["score"]) for r in topk.search(_frame(spark, rows)).orderBy("rank").collect()]
    assert got == [(2, 65536 // 2 + 2 * 65536), (1, 65536), (3, 0)]


def _negatives(rows, every):
    rows = [r for r in _whole(rows) if r[2] is not None]
    score, out = _products(rows), []
    for i, r in enumerate(rows):
        if r[0] % every:
            continue
        own = sorted((-score[i][j], rows[j][0]) for j in range(len(rows)) if j != i and rows[j][2] == r[2])[:5]
        for s, positive in own:
            fits = [
                (-score[i][j], rows[j][0])
                for j in range(len(rows))
                if rows[j][2] != r[2] and 80 * -s <= 100 * score[i][j] <= 100 * -s
            ]
            out += [(r[0], positive, n + 1, v, -s, -t) for n, (t, v) in enumerate(sorted(fits)[:5])]
    return sorted(out)


def test_hard_negatives_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    rows = _odd_vectors()
    want = _negatives(rows, 20)
    assert len(want) > 200
    assert _rows(negatives.mine(_frame(spark, rows).repartition(5), every=20)) == want
    assert _rows(negatives.mine(_frame(spark, rows).limit(0))) == []
    assert _rows(negatives.mine(_frame(spark, rows).withColumn("label", F.lit(None).cast("int")))) == []


def test_hard_negatives_of_clustered_rows(spark):
    rng = np.random.default_rng(8)
    centres = 3 * rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist(), i % 5) for i in range(900)]
    assert _rows(negatives.mine(_frame(spark, rows), every=50)) == _negatives(rows, 50)


def test_score_bounds_hold_and_filter():
    rng = np.random.default_rng(2)
    centres = 200 * rng.normal(size=(6, 16))
    q = np.floor(centres[rng.integers(0, 6, 400)] + 20 * rng.normal(size=(400, 16))).astype(np.int64)
    q[0], q[1], q[2] = 0, q[3], -q[3]
    norm = np.sqrt((q.astype(float) ** 2).sum(1))
    references = q[3:12] / norm[3:12, None]
    angle = negatives.angles(q, norm, references)
    near = np.abs(angle[:, None] - angle[None]).max(2)
    total = angle[:, None] + angle[None]
    far = np.minimum(total, 2 * np.pi - total).min(2)
    product = norm[:, None] * norm
    lower, upper = negatives.score_bounds(near, far, product, product)
    score = q @ q.T
    assert (lower <= score).all() and (score <= upper).all()
    # most pairs of different clusters are told apart from those of one cluster
    high = score >= 0.8 * product
    assert (upper[~high] < 0.8 * product[~high]).mean() > 0.3


def test_exact_kinds():
    assert vectors.exact_kind((1 << 24) - 1) is np.float32
    assert vectors.exact_kind(1 << 24) is np.float64
    assert vectors.exact_kind(1 << 53) is np.int64


def _terms(text):
    out, word = [], []
    for c in text or "":
        if "A" <= c <= "Z" or "a" <= c <= "z" or ord(c) >= 128:
            word.append(c.lower() if c < "\x80" else c)
        elif word:
            out.append("".join(word))
            word = []
    return out + (["".join(word)] if word else [])


def _audit(rows):
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == lang]
        docs = Counter(t for r in own for t in set(_terms(r[0])))
        kept = sorted(t for t in docs if docs[t] >= 10)
        counts = {s: Counter(t for r in own if r[2] == s for t in _terms(r[0])) for s in {r[2] for r in own}}
        whole = sum(counts.values(), Counter())

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            over = [(-f(ps[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(over)[:10])):
                out += [(lang, s, part, i.decode(), -v, n + 1) for n, (v, i) in enumerate(items)]
    return sorted(out)


def _texts():
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("é", "x", "Yz", "", "ß日")]
    rows = []
    for _ in range(260):
        picked = rng.choice(words, rng.integers(0, 60), p=(w := 1 / np.arange(1, len(words) + 1)) / w.sum())
        rows.append((" ".join(picked) + ", 12-" * 2, str(rng.choice(["en", "fr"])), "s" + str(rng.integers(0, 5))))
    rows += [(None, None, None), ("", "xx", "a"), ("one two", "xx", None), ("words " * 50_000, "en", "s1")]
    rows += [rows[0], rows[0], ("x" * 200_000, "fr", "only"), ("!!", "en", "no terms"), ("ÀB\x00cd", "en", "s2")]
    return rows


@pytest.mark.parametrize("bits", [64, 4])
def test_divergence_of_odd_rows(spark, bits, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 1000)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 40)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 30)
    rows = _texts()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in [*CLASHES, "lang_key", "group_key", "term"]])
    assert _rows(divergence.audit(docs, bits)) == _audit(rows)
    if bits == 64:
        assert _rows(divergence.audit(docs.limit(0))) == []


def test_probabilities_of_large_counts(spark):
    df = spark.createDataFrame([(10**17, 9 * 10**17, 10**9)], "n long, total long, v long")
    want = 1 + (10**9 * (10**17 + 2)) // (9 * 10**17 + 2 * 10**9)
    assert df.select(divergence._p("n", "total").alias("p")).first()["p"] == want
