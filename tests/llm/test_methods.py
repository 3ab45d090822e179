"""Parts of the corpus operators against plain versions."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelwright.llm import bpe, chaining, chat, common, hnsw, line_rules, packing, pii, quality, seeds, simhash, words

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "",
    " \n\t ",
    "ΑΣΣ ΣΑΣ İstanbul ﬁ",
    "a<|endoftext|>b <|startoftext|>",
    "x\x1cy\x1f z\x85w q​z",
    "it's I'LL don't'd '''s",
    "été café Å",
    "123abc45 ½²",
    "日本語テスト 한국어",
    "😀👍🏽 family",
    "a" * 3000,
    "ab" * 777 + "!" * 100,
]


def test_encoder_equals_the_library():
    library, own = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    rng = random.Random(3)
    texts = HARD + ["".join(chr(rng.randrange(32, 0x24F)) for _ in range(80)) for _ in range(200)]
    for text, ids in zip(texts, own.batch(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_encoder_forgets_and_still_agrees(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 2)
    own = bpe.Encoder(PATH)
    first = [x.tolist() for x in own.batch(HARD)]
    assert [x.tolist() for x in own.batch(HARD)] == first


def test_words_and_hashes():
    texts = ["One two\tTHREE  ", None, "", "two", "é\x0bTwo three one two"]
    found = words.split_words(pa.array(texts))
    got = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
    assert got == ["one", "two", "three", "two", "é", "two", "three", "one", "two"]
    assert found.doc.tolist() == [0, 0, 0, 3, 4, 4, 4, 4, 4]
    by_word = {}
    for w, h in zip(got, found.hash.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    code, at = words.shingle_hashes(found, 2)
    assert at.tolist() == [0, 1, 4, 5, 6, 7]
    assert code[0] == code[5] and code[1] == code[3] and len(set(code.tolist())) == 4


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (2, 3)]
    got = common.components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 140)} | {2: 2, 3: 2}
    assert {r["node"]: r["component"] for r in got} == want
    assert len(got) == len(want)
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ball_hashing_finds_all_links(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for d in (1, 2, 3, 4):
            g = f
            for b in rng.choice(64, d, replace=False).tolist():
                g ^= 1 << b
            fps.add(g)
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    joined = {r["node"]: r["component"] for r in common.components(simhash.links(df)).collect()}
    for a, b in combinations(fps.tolist(), 2):
        if bin(a ^ b).count("1") <= 3:
            a, b = np.array([a, b], np.uint64).view(np.int64).tolist()
            assert joined[a] == joined[b]


def _best_chain(matches, gap_cost=0.1):
    matches = sorted(set(matches))
    score = []
    for i, (p, s) in enumerate(matches):
        best = 0.0
        for j, (q, t) in enumerate(matches[:i]):
            if q < p and t < s:
                best = max(best, score[j] - gap_cost * (p - q + s - t))
        score.append(chaining.SEED_WORDS + best)
    return max(score)


def test_chain_has_the_best_score():
    rng = random.Random(2)
    for _ in range(50):
        matches = [(rng.randrange(40), rng.randrange(40)) for _ in range(25)]
        chain = chaining.chains(matches)[0]
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chain, chain[1:]))
        gaps = sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(chain, chain[1:]))
        assert len(chain) * chaining.SEED_WORDS - 0.1 * gaps == pytest.approx(_best_chain(matches))


def _prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n)]


def test_fuzzy_passages(spark):
    rng = random.Random(9)
    passage = _prose(rng, 70)
    edited = list(passage)
    for i in range(5, 70, 12):
        edited[i] = "changed"
    short = _prose(rng, 30)
    docs = [
        (1, " ".join(_prose(rng, 200) + passage + _prose(rng, 100))),
        (2, " ".join(_prose(rng, 50) + passage + _prose(rng, 80))),
        (3, " ".join(_prose(rng, 90) + edited + _prose(rng, 10))),
        (4, " ".join(short + _prose(rng, 100))),
        (5, " ".join(_prose(rng, 100) + short)),
        (6, None),
        (7, ""),
        (8, " ".join(passage)),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in chaining.passages(df).collect()}
    assert set(got) == {2, 3, 8}
    assert (got[2]["start"], got[2]["end"], got[2]["source_id"]) == (50, 120, 1)
    assert got[3]["similarity"] >= 0.8 and got[3]["end"] - got[3]["start"] >= 60
    left = {r["doc_id"]: r["text"] for r in chaining.without_passages(df).collect()}
    assert set(left) == {1, 2, 3, 4, 5, 6, 7}  # nothing is left of 8
    assert left[1] == docs[0][1] and len(left[2].split()) == 130 and left[6] is None and left[7] == ""


@pytest.mark.parametrize("sizes", [(100, 100, 60), (500, 300, 100), (450, 70, 450), (100, 61, 60), (200, 500, 80), (100, 50, 60)])
def test_second_passage_of_a_pair_is_found(spark, sizes):
    rng = random.Random(12)
    first, second = _prose(rng, sizes[0]), _prose(rng, sizes[2])
    docs = [(i, " ".join(_prose(rng, 40) + first + _prose(rng, sizes[1]) + second + _prose(rng, 40))) for i in (1, 2)]
    got = chaining.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    at = 40 + sizes[0] + sizes[1]
    assert sorted((r["start"], r["end"]) for r in got) == [(40, 40 + sizes[0]), (at, at + sizes[2])]


def test_passage_whose_parts_occur_earlier_elsewhere(spark):
    rng = random.Random(21)
    passage = _prose(rng, 60)
    around = lambda x: " ".join(_prose(rng, 30) + x + _prose(rng, 30))
    parts = [passage[:30], passage[30:], passage, passage]  # as in the advice
    more = _prose(rng, 70)
    # many partial copies before and between, and an exact copy at the end
    parts += [more[:35], more[35:]] * 4 + [more] + [more[:35], more[35:]] * 4 + [more]
    docs = [(i + 1, around(x)) for i, x in enumerate(parts)]
    got = chaining.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_id"], r["start"], r["end"]) for r in got} == {(4, 3, 30, 90), (22, 13, 30, 100)}


def test_passages_at_the_least_similarity(spark):
    rng = random.Random(31)
    docs, wanted = [], set()
    for case in range(60):
        n = rng.choice([50, 55, 60, 80])
        passage = _prose(rng, n)
        edited = list(passage)
        at = range(case % 5, n, 5) if case < 20 else rng.sample(range(n), n // 5)
        for i in at:
            edited[i] = f"changed{case}x{i}"
        same = [x == y for x, y in zip(passage, edited)]
        runs = [(i, j) for i in range(n) for j in range(i + 50, n + 1) if same[i] and same[j - 1]]
        if any(sum(same[i:j]) >= 0.8 * (j - i) for i, j in runs):  # all stretches, by brute force
            wanted.add(2 * case + 1)
        docs += [(2 * case + k, " ".join(_prose(rng, 30) + x + _prose(rng, 30))) for k, x in enumerate((passage, edited))]
    got = {r["doc_id"]: r for r in chaining.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(wanted) > 20 and wanted <= set(got)
    assert all(r["similarity"] >= 0.8 and r["source_id"] == d - 1 for d, r in got.items())


def test_passage_of_few_frequent_seeds(spark):
    runs = [[f"r{i}w{j}" for j in range(5 if i == 0 else 4)] for i in range(10)]

    def text(parts, name):  # a word of its own between the parts
        return " ".join(w for i, part in enumerate(parts) for w in [*([f"{name}x{i}"] if i else []), *part])

    # all seeds are in 22 texts, but the runs follow each other backwards in twenty of them
    docs = [(n, text(runs[::-1], f"n{n}")) for n in range(20)]
    docs += [(100, text(runs, "a")), (200, text(runs, "b"))]
    got = chaining.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["source_id"], r["start"], r["end"]) for r in got if r["doc_id"] >= 100] == [(200, 100, 0, 50)]


def test_words_are_counted_for_copied_texts_only(spark):
    rng = random.Random(14)
    texts = [" ".join(_prose(rng, n)) for n in (49, 50, 60)]
    df = spark.createDataFrame([(i, texts[i % 3]) for i in range(6)] + [(9, texts[1] + " x")], "doc_id long, text string")
    left, found = chaining._copies(df.selectExpr("*", "xxhash64(text) text_hash", "xxhash64(text, 1) second"))
    assert {(r["doc_id"], r["source_id"], r["end"]) for r in found.collect()} == {(4, 1, 50), (5, 2, 60)}
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 9]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_many_copies_make_few_matches(spark):
    rng = random.Random(4)
    text = " ".join(_prose(rng, 120))
    df = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string")
    assert chaining.passages(df).count() == 299


@pytest.mark.parametrize("fragments", [45, 150])  # rare and frequent seeds
def test_edited_passage_behind_many_fragments(spark, fragments):
    rng = random.Random(5)
    passage = _prose(rng, 80)

    def edited(first):
        return [f"other{i}" if i % 10 == first else w for i, w in enumerate(passage)]

    around = lambda x: " ".join(_prose(rng, 40) + x + _prose(rng, 40))
    parts = [passage[i * 7 % 69 : i * 7 % 69 + 12] for i in range(fragments)]
    docs = parts[: fragments // 2] + [edited(4)] + parts[fragments // 2 :] + [edited(5)]
    df = spark.createDataFrame([(i, around(x)) for i, x in enumerate(docs)], "doc_id long, text string")
    got = [(r["doc_id"], r["source_id"]) for r in chaining.passages(df).collect()]
    assert got == [(fragments + 1, fragments // 2)]


def test_edits_follow_the_text_of_an_id(spark):
    rng = random.Random(6)
    passage = _prose(rng, 60)
    other = " ".join(_prose(rng, 10))
    mails = ["write to a.b@example.org now", "no mail here, x.y@example.org"]
    docs = [(1, " ".join(passage)), (2, " ".join(_prose(rng, 30) + passage)), (2, other), (3, mails[0]), (3, mails[1]), (None, mails[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = [(r["doc_id"], r["text"]) for r in chaining.without_passages(df).collect()]
    assert (2, other) in left and len(left) == 6
    assert [len(t.split()) for d, t in left if d == 2 and t != other] == [30]
    masked = {r["text"] for r in pii.masked(df).where("doc_id = 3 or doc_id is null").collect()}
    assert masked == {"write to <EMAIL> now", "no mail here, <EMAIL>"}


def test_common_runs_of_repeats():
    rng = random.Random(8)
    phrase, tail = _prose(rng, 10), _prose(rng, 30)
    a, b = (chaining.Text(" ".join(_prose(rng, n) + phrase * 40 + tail)) for n in (12, 33))
    found = chaining.passages_of(a, b)
    assert any(end - start >= 400 and alike >= 0.9 for start, end, _, _, alike in found)


def _may_by_brute_force(a, b):
    share = lambda x, y: any(
        5 * sum(w in y for w in x[i:j]) >= 4 * (j - i) for i in range(len(x)) for j in range(i + 50, len(x) + 1)
    )
    return share(a, set(b)) and share(b, set(a))


def test_texts_without_a_common_stretch_are_not_aligned(monkeypatch):
    rng = random.Random(17)
    seen = set()
    for case in range(120):
        n = rng.choice([10, 49, 50, 51, 70])
        passage = _prose(rng, n)
        edited = [f"other{i}" if rng.random() < rng.choice([0, 0.15, 0.3]) else w for i, w in enumerate(passage)]
        sides = [[*_prose(rng, rng.choice([0, 30])), *x, *_prose(rng, rng.choice([0, 30]))] for x in (passage, edited)]
        a, b = (chaining.Text(" ".join(x)) for x in sides)
        may = chaining.may_have_passage(a, b)
        assert may == _may_by_brute_force(a.words, b.words)
        assert may or not list(chaining._alike(a.words, b.words, chaining.common_runs(a, b)[:1] or [(0, 0)]))
        seen.add(may)
    assert seen == {True, False}
    assert not chaining.may_have_passage(chaining.Text(""), a) and not chaining.passages_of(a, chaining.Text(" "))
    # a line of thirty words in common costs no chain
    line = _prose(rng, 30)
    a, b = (chaining.Text(" ".join(_prose(rng, 80) + line + _prose(rng, 80))) for _ in range(2))
    assert chaining.common_runs(a, b)
    monkeypatch.setattr(chaining, "common_runs", None)
    assert chaining.passages_of(a, b) == []


def test_words_of_a_compared_text():
    text = "\u00a0Ab\u00c4 ab\u00e4\tAB\x0bab\x0c\r\n\x1cab \u2003x\x85 \x00 "
    got = chaining.Text(text).words
    want = words.split_words(pa.array([text], pa.large_string())).hash.tolist()
    assert len(got) == len(want) and [got.index(w) for w in got] == [want.index(w) for w in want]


def test_packed_columns_round_trip():
    rng = np.random.default_rng(1)
    columns = [rng.integers(-(2**62), 2**62, 50), np.arange(0), np.arange(300), np.zeros(4, np.int64)]
    kind, back = seeds.unpack(seeds.pack(2, *columns))
    assert kind == 2 and all((x == y.view(np.int64)).all() and len(x) == len(y) for x, y in zip(columns, back))


def test_long_runs_of_digits():
    text = "0" * 5000 + "1.2.3.4 and " + "9" * 6000 + ".1.1.1"
    assert [s for s in pii.base_spans(text) if s[0] == 1] == [(1, 0, 5007)]


def test_plan_uses_each_piece_once():
    rng = np.random.default_rng(3)
    for sizes, share in ((rng.integers(1, 65, 500), 0.96), (np.full(90, 64), 1), (np.ones(7, int), 0), (np.full(9, 40), 0)):
        hist = np.bincount(sizes, minlength=65)
        dealt, filled = np.zeros(65, int), {}
        for s in packing.plan(hist):
            assert s.low == dealt[s.length]
            dealt[s.length] = s.high
            for r in range(s.high - s.low):
                filled.setdefault(s.base + r % s.times, []).append((s.offset + r // s.times * s.length, s.length))
        assert (dealt == hist).all()
        for own in filled.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 64
        assert sizes.sum() >= share * 64 * len(filled)
    assert packing.plan(np.zeros(65, int)) == []


def test_packed_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None), (3, "four " * 40)], "doc_id long, text string")
    packed = packing.pack(df, PATH, window=16, with_ids=True)
    total = sum(len(r["ids"]) for r in packing.sequences(packed).collect())
    assert total == packed.agg(F.sum("length")).first()[0]
    assert all(len(r["ids"]) <= 16 for r in packing.sequences(packed).collect())


def test_patterns_of_personal_data():
    text = "x a.b@c-d.org, 1.2.3.4 and 1.2.3.400; 4111 1111 1111 1111 not 4111111111111112 +1 (319) 555-5132 @no.com"
    assert [(k, text[s:e]) for k, s, e in pii.base_spans(text)] == [
        (0, "a.b@c-d.org"),
        (1, "1.2.3.4"),
        (2, "4111 1111 1111 1111"),
        (3, "+1 (319) 555-5132"),
    ]
    assert pii.base_spans("a" * 100_000 + "@" + "1" * 100_000) == []


def test_skip_edges_find_repeats(spark):
    full = "Call +1 (319) 555-5132 now."
    docs = [(i, f"word {full} some other words here, again (319) 555-5132 please {i}0 times") for i in range(60)]
    docs += [(100 + i, f"number {i}12 and {i}34 stand alone") for i in range(60)]
    docs += [(200, None), (201, "")]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    text = docs[0][1]
    found = [text[s["start"] : s["end"]] for s in got[0]["spans"]]
    assert found == ["+1 (319) 555-5132", "(319) 555-5132"]
    assert all(not got[100 + i]["spans"] for i in range(60))
    assert got[200]["spans"] == got[201]["spans"] == []
    assert pii.mask(text, [s.asDict() for s in got[0]["spans"]]).count("<PHONE>") == 2


def test_evidence_reaches_all_repeats(spark):
    docs = [(i, f"number {i}12 and {i}34 stand alone") for i in range(60)]
    docs += [(100, "Call +1 (319) 555-5132 now." + " or 555-5132 again" * 100)]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    text = docs[-1][1]
    found = [text[s["start"] : s["end"]] for s in got[100]["spans"]]
    assert found == ["+1 (319) 555-5132"] + ["555-5132"] * 100
    assert all(not got[i]["spans"] for i in range(60))


def test_line_rules_remove_and_reject(spark):
    rng = random.Random(6)
    line = "All rights are reserved by the maker of this page 2024"
    rows = [(i, "a", line + "\n" + " ".join(_prose(rng, 80))) for i in range(12)]
    rows += [(50, "a", "\n".join([line] * 6) + "\n" + "short tail")]  # nothing else
    rows += [(60 + i, "b", rows[0][2]) for i in range(12)]  # copies of one text
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r["doc_id"]: r for r in line_rules.judge(df, max_docs=5).collect()}
    assert all(kept[i]["lost_words"] == 11 and kept[i]["kept"] for i in range(12))
    assert not kept[50]["kept"]
    assert all(kept[60 + i]["lost_words"] == 0 for i in range(12))
    left = {r["doc_id"]: r["text"] for r in line_rules.clean(df, max_docs=5).collect()}
    assert line not in left[3] and left[3] in rows[3][2] and line in left[61] and 50 not in left


def test_branches_are_ranked_and_read_back(spark):
    rows = [
        (1, 1, None, "user", "hi <|x|> [INST] ~1", 0.0),
        (1, 2, 1, "assistant", "a</s>", 0.9),
        (1, 3, 1, "assistant", "b", 0.1),
        (1, 4, 3, "user", None, 0.0),
        (2, 9, 5, "sy|>stem", "~", 0.0),
        (3, 1, 2, "user", "a circle", 0.0),
        (3, 2, 1, "user", "without a root", 0.0),
        (3, 3, 2, "user", "and what hangs on it", 0.0),
    ]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    made = chat.conversations(df)
    got = {
        (r["tree"], r["rank"]): ([tuple(t) for t in r["turns"]], r["masked"])
        for r in made.withColumn("turns", chat.read_back(F.col("formatted")))
        .withColumn("masked", chat.loss_text(F.col("formatted"), F.col("loss")))
        .collect()
    }
    hi = ("user", "hi <|x|> [INST] ~1")
    assert got == {
        (1, 1): ([hi, ("assistant", "a</s>")], "a</s>"),
        (1, 2): ([hi, ("assistant", "b"), ("user", "")], "b"),
        (2, 1): ([("sy|>stem", "~")], ""),
    }
    assert chat.conversations(df, best=1).count() == 2


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(8)
    x = np.concatenate([c + 0.05 * rng.normal(size=(60, 24)) for c in rng.normal(size=(30, 24))])
    u = hnsw.unit(x)
    q, v = hnsw.links(hnsw.Graph(u), u, u, np.arange(0, len(u), 20))
    truth = (u @ u.T >= 0.98).sum()
    assert truth * 0.99 <= len(q) <= truth


def test_queries_that_no_vector_is_near_to_walk_no_graph(monkeypatch):
    rng = np.random.default_rng(9)
    u = hnsw.unit(rng.normal(size=(500, 64)))
    near = hnsw.unit(u[:20] + 0.005 * rng.normal(size=(20, 64)))
    asked = np.concatenate([hnsw.unit(rng.normal(size=(480, 64))), near])
    linked = np.flatnonzero((asked @ u.T >= hnsw.THRESHOLD).any(axis=1))
    assert set(linked) <= set(np.flatnonzero(hnsw.may_link(u, asked)))
    walked = []
    over = hnsw.Graph.over
    monkeypatch.setattr(hnsw.Graph, "over", lambda self, q, *more: walked.append(len(q)) or over(self, q, *more))
    q, v = hnsw.links(hnsw.Graph(u), u, asked, np.arange(0, len(asked), 20))
    assert sorted(zip(q, v)) == sorted(zip(*np.nonzero(asked @ u.T >= hnsw.THRESHOLD)))
    assert sum(walked) < 100
    assert [len(x) for x in hnsw.links(hnsw.Graph(u), u, asked[:50], np.arange(3))] == [0, 0]


def test_all_shards_meet_in_several_turns(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 20)
    monkeypatch.setattr(hnsw, "ASKED", 4)
    rng = np.random.default_rng(10)
    x = np.repeat(rng.normal(size=(100, 8)), 3, axis=0) + 0.02 * rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, 1, y) for i, y in enumerate(x.tolist())], "vec_id long, label int, embedding array<double>")
    u = hnsw.unit(x)
    truth = (u @ u.T >= hnsw.THRESHOLD).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in hnsw.near_duplicates(df).collect()}
    assert got == dict(enumerate(truth.tolist()))


def test_labellers_learn_who_is_right():
    rng = np.random.default_rng(0)
    good = rng.random(4000) < 0.8
    sure = np.where(rng.random(4000) < 0.95, good, ~good)
    also = np.where(rng.random(4000) < 0.9, good, ~good)
    noise = rng.random(4000) < 0.5
    rows = ["".join("ca"[not v] for v in r) for r in zip(sure, also, noise)]
    kinds, counts = np.unique(rows, return_counts=True)
    labels = quality.maximise(kinds.tolist(), counts.astype(float))
    right = labels.chance[1, :, 2]  # votes good on good documents
    assert right[0] > 0.9 and right[1] > 0.8 and abs(right[2] - 0.5) < 0.1
    assert abs(labels.prior - 0.8) < 0.1


def test_passages_of_few_rare_and_few_frequent_seeds(spark):
    runs = [[f"r{i}w{j}" for j in range(5 if i == 0 else 4)] for i in range(10)]
    line = [f"line{j}" for j in range(12)]

    def text(parts, name):  # a word of its own between the parts
        return " ".join(w for i, part in enumerate(parts) for w in [*([f"{name}x{i}"] if i else []), *part])

    # the first five runs are in 22 texts, the others in two: 6 frequent and 5 rare seeds in common
    docs = [(n, text([*runs[:5], line], f"n{n}")) for n in range(20)]
    docs += [(100, text(runs, "a")), (200, text(runs, "b"))]
    got = chaining.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["source_id"], r["start"], r["end"]) for r in got] == [(200, 100, 0, 50)]


def _seed_rows(texts):
    return [(key, doc, at) for doc, keys in texts.items() for at, key in enumerate(keys) if key is not None]


def _in_common(a, b):
    return sum(min(a.count(k), b.count(k)) for k in set(a) - {None})


def test_rare_pairs_count_frequent_seeds_near_the_rare_ones(spark):
    rng = random.Random(5)
    texts = {doc: [rng.choice([None, *range(40)]) for _ in range(400)] for doc in range(12)}
    ends = {(d, s): (rng.randrange(350), rng.randrange(350)) for d in range(12) for s in range(d)}
    rows = [(d, s, 1 + (d + s) % 4, p, p + 5, q, q + 5) for (d, s), (p, q) in ends.items()]
    pairs = spark.createDataFrame(rows, f"doc_id long, source_id long, hits long, {seeds.PLACES}")
    frequent = spark.createDataFrame(_seed_rows(texts), "key long, doc_id long, at int")
    left = frequent.where("at % 2 = 0 and doc_id <> 3")
    want = set()
    for d, s, hits, low, high, source_low, source_high in rows:
        near = [k if at % 2 == 0 and d != 3 else None for at, k in enumerate(texts[d])]
        near = near[max(0, low - seeds.SPAN) : high + seeds.SPAN + 1]
        source = texts[s][max(0, source_low - 2 * seeds.SPAN) : source_high + 2 * seeds.SPAN + 1]
        if hits + _in_common(near, source) >= seeds.MIN_HITS:
            want.add((d, s))
    got = chaining._mixed(pairs, left, frequent)
    assert 0 < len(want) < len(rows)
    assert {tuple(r) for r in got.collect()} == want
    # no row for each seed of a pair
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert chaining._mixed(pairs.limit(0), left, frequent).count() == 0
    assert chaining._mixed(pairs, left.limit(0), frequent).count() == 0


def test_seeds_of_very_many_texts_form_no_pairs_alone(spark):
    rng = random.Random(6)
    hot = list(range(10))
    texts = {doc: hot + [100 + rng.randrange(30) for _ in range(rng.choice([10, 25]))] for doc in range(60)}
    texts |= {doc: hot + [1000 * doc + i for i in range(20)] for doc in range(100, 160)}
    frequent = spark.createDataFrame(_seed_rows(texts), "key long, doc_id long, at int")
    counted = chaining._seeds(frequent)
    got = chaining._meeting(frequent, chaining._sources(counted))
    want = {(a, b) for a in texts for b in texts if a > b and _in_common(texts[a], texts[b]) >= seeds.MIN_HITS}
    assert want and {tuple(r) for r in got.collect()} == want
    likely = chaining._together(chaining._telling(counted), chaining._sources(counted), seeds.MIN_HITS - chaining.OFTEN)
    assert want <= {tuple(r) for r in likely.collect()}
    assert likely.where("doc_id >= 100").count() == 0
