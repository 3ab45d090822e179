"""Quality classifier from weak labels.

Overlapping heuristics each vote good, bad or not at all on a document. How often each pattern of votes occurs is all
that expectation-maximisation needs to estimate every heuristic's accuracies and every pattern's posterior. The posteriors
label all documents, and these train a linear scorer over hashed words and word shapes: every bucket's weight is the
log odds of its posterior-weighted counts over the whole corpus; a logistic curve, fitted on a bounded sample of scores,
turns a document's mean weight into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import map_rows, narrow_batches, stored
from panelwright.llm.words import Words, mix, shingle_hashes, split_words, text_bytes

BUCKETS = 1 << 16
#: Scores, least by their hash, that the logistic curve is fitted on.
CURVE_SAMPLE = 20_000
EM_ROUNDS = 100
#: Probability of good quality from which a document is kept.
KEEP = 0.5
GOOD, NONE, BAD = 1, 0, -1
_U = np.uint64


def _per_doc(values: np.ndarray, words: Words) -> np.ndarray:
    """Sums of one value a word over the words of each row."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[words.first[1:]] - sums[words.first[:-1]]


def repeated(words: Words) -> np.ndarray:
    """Whether a three-word window begins at each word that stands earlier in the document, too."""
    code, at = shingle_hashes(words, 3)
    row = words.doc[at]
    key = np.lexsort((at, code, row))
    again = np.zeros(len(key), np.bool_)
    if len(key):
        again[1:] = (code[key][1:] == code[key][:-1]) & (row[key][1:] == row[key][:-1])
    out = np.zeros(len(words.hash), np.bool_)
    out[at[key[again]]] = True
    return out


def measures(column: pa.Array, words: Words) -> dict[str, np.ndarray]:
    """Figures of each row of a batch."""
    raw, offsets = text_bytes(column)
    n = np.diff(words.first).astype(np.float64)
    some = np.maximum(n, 1)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)

    upper = bytes_in((raw >= 65) & (raw <= 90))
    lower = bytes_in(((raw >= 97) & (raw <= 122)) | (raw >= 128))
    symbols = bytes_in(np.isin(raw, np.frombuffer(b"#*$%&|<>{}[]\\^~", np.uint8)))
    marks = bytes_in(np.isin(raw, np.frombuffer(b"!?", np.uint8)))
    stops = bytes_in(np.isin(raw, np.frombuffer(b".,;:", np.uint8)))
    digits = bytes_in((raw >= 48) & (raw <= 57))
    key = np.lexsort((words.hash, words.doc))
    repeat = np.zeros(len(key), np.bool_)
    if len(key):
        repeat[1:] = (words.hash[key][1:] == words.hash[key][:-1]) & (words.doc[key][1:] == words.doc[key][:-1])
    again = np.bincount(words.doc[key], repeat, len(n)) if len(key) else np.zeros(len(n))
    thrice = np.bincount(words.doc, repeated(words), len(n)) if len(words.doc) else np.zeros(len(n))
    return {
        "words": n,
        "length": _per_doc((words.end - words.start).astype(np.float64), words) / some,
        "upper": upper / np.maximum(upper + lower, 1),
        "symbols": symbols / some,
        "dense": symbols / np.maximum(np.diff(offsets), 1),
        "marks": marks / some,
        "stops": stops / some,
        "digits": digits / some,
        "again": again / some,
        "windows": thrice / np.maximum(n - 2, 1),
    }


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """A row of votes for each document. Most heuristics know one fault and abstain where they don't see it; each fault has
    two that overlap. The last three know plain prose."""
    n = m["words"]
    faults = [
        m["symbols"] > 0.3,
        m["dense"] > 0.05,
        m["upper"] > 0.4,
        m["marks"] > 0.3,
        m["windows"] > 0.25,
        (m["again"] > 0.85) & (n >= 30) & (n < 500),
        (n > 0) & ((m["length"] < 2) | (m["length"] > 16)),
        m["digits"] > 2,
    ]
    plain = [
        (n > 0) & (m["symbols"] < 0.05) & (m["upper"] < 0.2) & (m["marks"] < 0.1),
        (n > 0) & (m["dense"] < 0.01) & (m["windows"] < 0.05),
        (m["stops"] > 0.03) & (m["stops"] < 0.5) & (m["symbols"] < 0.05) & (m["windows"] < 0.1),
    ]
    return np.stack([-f.astype(np.int8) for f in faults] + [p.astype(np.int8) for p in plain], axis=1)


class Labels(NamedTuple):
    """Share of good documents, chance of each vote (bad, none, good) of each labeller given the class (bad, good), and the
    posterior chance of good of each pattern."""

    prior: float
    chance: np.ndarray
    posterior: dict[str, float]


def maximise(patterns: list[str], counts: np.ndarray) -> Labels:
    """Expectation-maximisation over vote patterns, which are bounded in number by the labellers. Starts from the majority
    vote, so that good means what most labellers call good; ties and no votes start at even odds."""
    v = np.array([[ord(c) - ord("b") for c in p] for p in patterns])  # -1, 0, 1
    balance = v.sum(axis=1)
    q = np.where(balance > 0, 0.9, np.where(balance < 0, 0.1, 0.5))
    hot = np.stack([v == k for k in (BAD, NONE, GOOD)], axis=2).astype(float)
    for _ in range(EM_ROUNDS):
        weight = np.stack([counts * (1 - q), counts * q])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        chance = np.einsum("cp,plk->clk", weight, hot) + 1
        chance /= chance.sum(axis=2, keepdims=True)
        log = np.einsum("plk,clk->cp", hot, np.log(chance)) + np.log([[1 - prior], [prior]])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        moved = np.abs(new - q).max()
        q = new
        if moved < 1e-6:
            break
    return Labels(float(prior), chance, dict(zip(patterns, q.tolist())))


def _patterns(found: np.ndarray) -> list[str]:
    return [bytes(row).decode() for row in (found + ord("b")).astype(np.uint8)]


def shapes(words: Words, raw: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: classes of its bytes (upper, lower, digit, others as they are) without repeats."""
    kind = raw.astype(np.uint64) + _U(256)
    kind[(raw >= 97) & (raw <= 122) | (raw >= 128)] = 1
    kind[(raw >= 65) & (raw <= 90)] = 2
    kind[(raw >= 48) & (raw <= 57)] = 3
    new = np.ones(len(kind), np.bool_)
    new[1:] = kind[1:] != kind[:-1]
    new[words.start] = True
    rank = np.cumsum(new)
    first = np.zeros(len(kind) + 1, np.int64)
    first[words.start] = rank[words.start]
    base = np.maximum.accumulate(first)[:-1]
    part = mix(kind + ((rank - base).astype(np.uint64) << _U(32))) * new
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
    return mix(sums[words.end] - sums[words.start])


def buckets(words: Words, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words, and of all their shapes with whether they begin a repeat, in the order of the words."""
    top = _U(64 - int(BUCKETS).bit_length() + 1)
    form = shapes(words, raw) + _U(1) + repeated(words)
    return (mix(words.hash) >> top).astype(np.int64), (mix(form) >> top).astype(np.int64)


def label_patterns(docs: DataFrame) -> DataFrame:
    """``pattern`` of every row: b for no vote, a for bad, c for good, a letter to a labeller."""

    def work(batch: pa.RecordBatch) -> dict:
        words = split_words(batch.column("text"))
        return {"pattern": _patterns(votes(measures(batch.column("text"), words)))}

    return map_rows(docs.select("text"), work, "pattern string")


def bucket_counts(docs: DataFrame, posterior: dict[str, float]) -> DataFrame:
    """``bucket, good, bad``: posterior-weighted numbers of documents per feature, each document's features sharing a
    weight of one. A task adds up all its documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS))
        for batch in narrow_batches(batches):
            column = batch.column("text")
            words = split_words(column)
            if not len(words.hash):
                continue
            q = np.array([posterior[p] for p in _patterns(votes(measures(column, words)))])
            share = 1 / np.maximum(np.diff(words.first), 1)
            for bucket in buckets(words, text_bytes(column)[0]):
                for k, own in enumerate((q, 1 - q)):
                    sums[k] += np.bincount(bucket, (own * share)[words.doc], BUCKETS)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["bucket", "good", "bad"]
        )

    counted = docs.select("text").mapInArrow(run, "bucket long, good double, bad double")
    return counted.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


class Scorer(NamedTuple):
    weight: np.ndarray
    slope: float
    shift: float


def _margins(docs: DataFrame, weight: Broadcast, posterior: dict[str, float], columns: str) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        column = batch.column("text")
        words = split_words(column)
        some = np.maximum(np.diff(words.first), 1)
        margin = sum(_per_doc(weight.value[b], words) for b in buckets(words, text_bytes(column)[0])) / some
        found = _patterns(votes(measures(column, words)))
        kept = {n: batch.column(n) for n in batch.schema.names if n != "text"}
        return kept | {"margin": margin, "weak": [posterior.get(p, 0.5) for p in found], "words": np.diff(words.first)}

    return map_rows(docs, work, ", ".join([*filter(None, [columns]), "margin double", "weak double", "words long"]))


def fit_curve(x: np.ndarray, goal: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a weak pull to slope one."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -50, 50)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - goal) * x).sum() + 0.1 * (slope - 1), (p - goal).sum() + 0.1 * shift])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, score, weak, quality_pred, kept`` of every row.

    ``weak`` is the labellers' posterior of good quality, ``score`` the linear scorer's; ``quality_pred`` is 1 and ``kept``
    true from KEEP on. Null, empty and blank texts get score 0. Repeated rows count as often as they occur; an empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most three votes to the power of the labellers
    tally = stored(label_patterns(texts).groupBy("pattern").count(), "vote_patterns").orderBy("pattern").collect()
    if not tally:
        kinds = {"score": "double", "weak": "double", "quality_pred": "int", "kept": "boolean"}
        return texts.select("doc_id", *[F.lit(None).cast(k).alias(n) for n, k in kinds.items()])
    labels = maximise([r["pattern"] for r in tally], np.array([r["count"] for r in tally], float))
    weight = np.zeros(BUCKETS)
    sums = np.full((2, BUCKETS), 0.0)
    for r in bucket_counts(texts, labels.posterior).collect():  # at most BUCKETS rows
        sums[:, r["bucket"]] = r["good"], r["bad"]
    total = sums.sum(axis=1, keepdims=True)
    prior = total / max(total.sum(), 1e-9)
    weight = np.log((sums[0] + prior[0]) / (total[0] + 1)) - np.log((sums[1] + prior[1]) / (total[1] + 1))
    weight[sums.sum(axis=0) == 0] = 0.0
    shared = spark.sparkContext.broadcast(weight)
    scored = stored(_margins(texts, shared, labels.posterior, "doc_id long"), "quality_margins")
    sample = scored.where("words > 0").select("margin", "weak").orderBy(F.xxhash64("doc_id", "margin")).limit(CURVE_SAMPLE)
    rows = sample.collect()
    slope, shift = fit_curve(np.array([r["margin"] for r in rows]), np.array([r["weak"] for r in rows]))
    curve = 1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(shift))))
    score = F.when(F.col("words") > 0, curve).otherwise(F.lit(0.0))
    return scored.select(
        "doc_id", score.alias("score"), "weak", (score >= KEEP).cast("int").alias("quality_pred"), (score >= KEEP).alias("kept")
    )
