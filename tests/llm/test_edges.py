"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables for every operator and stage."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelwright.llm import bpe, chaining, chat, common, hnsw, language, line_rules, packing, pii, quality, simhash

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \n\t ", None, "s", 4),
    (4, "word " * 30_000, "en", None, 150_000),
    (5, "x" * 150_000, "de", "s", 150_000),
    (6, "One sentence, and a mail a@b.org with 10.0.0.1 in it. " * 8, "en", "s", 432),
    (6, "One sentence, and a mail a@b.org with 10.0.0.1 in it. " * 8, "en", "s", 432),
    (None, "a text without an id", "en", "s", 20),
]
#: Names that the operators use inside.
CLASHES = ["_row", "_id", "fp", "seed", "spans", "edited_spans", "line", "kept", "rank", "label", "length"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars int")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


PER_ROW = {
    "quality": quality.classify,
    "bpe": lambda d: bpe.digests(d, PATH),
    "bpe_ids": lambda d: bpe.encode(d, PATH),
    "line_rules": line_rules.judge,
    "simhash": simhash.near_duplicates,
    "language": language.identify,
    "pii": pii.find,
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_for_each_row(docs, name):
    assert PER_ROW[name](docs).count() == len(ROWS)
    assert PER_ROW[name](docs.limit(0)).count() == 0


def test_values_of_odd_rows(docs):
    language_of = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert language_of[1] == language_of[2] == language_of[3] == "und" != language_of[4]
    fingerprint = {r["doc_id"]: r for r in simhash.near_duplicates(docs.where("doc_id is not null")).collect()}
    assert all(fingerprint[i]["fingerprint"] == "0" * 16 and fingerprint[i]["component_id"] == 1 for i in (1, 2, 3))
    tokens = {r["doc_id"]: r["n_tokens"] for r in bpe.digests(docs, PATH).collect()}
    assert tokens[1] == tokens[2] == tokens[3] == 0 and tokens[4] == 30_000
    rules = {r["doc_id"]: r for r in line_rules.judge(docs).collect()}
    assert rules[1]["n_words"] == 0 and rules[4]["n_repeat_words"] == 30_000 and rules[5]["word_chars"] == 150_000
    spans = {r["doc_id"]: r["base"] for r in pii.find(docs).collect()}
    assert len(spans[6]) == 16 and spans[1] == spans[5] == []


def test_packing_and_passages(docs):
    packed = packing.pack(docs, PATH)
    assert packed.groupBy("doc_id").count().count() == 7
    assert packing.pack(docs.limit(0), PATH).count() == 0
    assert chaining.passages(docs).where("doc_id = source_id").count() == 0
    assert chaining.passages(docs.limit(0)).count() == 0


def test_stages_keep_the_columns(spark, docs):
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() >= 0
    assert line_rules.clean(docs).count() == 0  # too short, or repeats of the same words
    assert pii.masked(docs).where("text like '%<EMAIL>%<IP>%'").count() == 2


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, [1.0, 0.0]),
        (2, 1, [2.0, 0.0]),
        (3, 1, [1.0, 0.0]),
        (3, 1, [1.0, 0.0]),
        (4, 2, [1.0, 0.0]),
        (5, None, [1.0, 0.0]),
        (6, 1, None),
        (7, 1, []),
        (8, 1, [0.0, 0.0]),
        (9, 1, [nan, 1.0]),
        (10, 1, [inf, 1.0]),
        (11, 1, [1.0, None]),
        (12, 1, [1.0, 0.0, 0.0]),
        (13, 1, [1e300, 1e290]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("least", F.lit("x"))
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in hnsw.near_duplicates(df).collect()]
    near = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (13, 4, 1, False)]
    assert sorted(got) == sorted(near + [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)])
    assert hnsw.near_duplicates(df.limit(0)).count() == 0


def test_turns(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (3, 1, "user", "b"), (3, 1, "user", "b"), (3, 2, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("path", F.lit(1))
    got = {r["tree"]: r for r in chat.conversations(chat.tree_of_turns(df)).collect()}
    assert got[3]["formatted"] == "<|user|>b</s><|user|>b</s><|assistant|></s>"
    assert got[None]["formatted"] == "<||></s><|user|>a</s>"
    assert chat.conversations(chat.tree_of_turns(df.limit(0))).count() == 0


def test_texts_go_to_python_in_batches_of_few_bytes(spark):
    seen = common.map_rows(
        spark.range(3000).selectExpr("id", "repeat('words and ', 1000) AS text").repartition(1),
        lambda batch: {"n": [batch.nbytes] * batch.num_rows},
        "n long",
    )
    assert seen.agg(F.max("n")).first()[0] < 8_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == common.BATCH_BYTES


def test_worker_gives_memory_back(spark):
    def run(batches):
        list(batches)
        held = [bytes(100_000) for _ in range(3000)]  # below the size of blocks that go back by themselves
        last, held = held[-1], None
        if give:
            common.give_back()
        with open("/proc/self/statm") as f:
            yield pa.RecordBatch.from_pydict({"mb": [int(f.read().split()[1]) * 4096 // 1_000_000]})
        del last

    found = []
    for give in (False, True):
        found.append(spark.range(1).repartition(1).mapInArrow(run, "mb long").first()[0])
    assert found[1] < found[0] - 100
