"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import bpe, chaining, chat, divergence, hnsw, language, line_rules, negatives, packing, pii, quality
from panelwright.llm import simhash, topk
from panelwright.llm.common import read_table
from panelwright.llm.sql import CHAT, DIVERGENCE, HARD_NEGATIVES, LINE_RULES, TOP_K
from panelwright.workload.book import Book

book = Book()
#: The tokenizer file; its place is a parameter of the operators.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@book.query("op2_bpe_segment_tree")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), TOKENIZER)


@book.query("op3_line_frequency_rules", LINE_RULES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(read_table(spark, sf_dir, "documents"))


@book.query("op5_simhash_ball_hashing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def _listed(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@book.query("op7_skip_chain_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans")
    )


@book.query("op8_nnls_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER)


@book.query("op10_collinear_chaining")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(read_table(spark, sf_dir, "documents"))


@book.query("op6_kneser_ney_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


#: A conversation whose texts are made of control strings.
_TRAP = """
SELECT CAST(-7 AS BIGINT) AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)
"""


@book.query("op9_reply_tree_chat", CHAT)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.conversations(chat.tree_of_turns(rows.unionByName(spark.sql(_TRAP))))
    turns = chat.read_back(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = chat.loss_text(F.col("formatted"), F.col("loss"))
    return made.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@book.query("op1_weak_label_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"))


@book.query("op4_hnsw_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@book.query("op11_angular_hard_negatives", HARD_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(rows.withColumn("label", moved))


@book.query("op12_source_divergence", DIVERGENCE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


@book.query("op13_histogram_top_k", TOP_K)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))
