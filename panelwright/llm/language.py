"""Language identification with interpolated Kneser-Ney character models.

Character n-grams up to four letters are counted per language with Spark; lower orders use continuation counts (how many
different characters precede them). Grams are hashed to HASH_BITS bits, so each order has at most 2**HASH_BITS rows per
language: the model has a proven bound and goes to all tasks as sorted hash arrays with one column of log probabilities
per language. A text belongs to the language with the lowest cross-entropy per character; a calibration part of
the learning documents sets the scale of the score and the cross-entropy above which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import map_rows, narrow_batches, stored
from panelwright.llm.words import mix

ORDER = 4
HASH_BITS = 20
UNKNOWN = "und"
#: Characters that a text not seen in training may use: the floor of the unigram model.
ALPHABET = 4096
#: Calibration texts, least by hash of their scores, that set the scale.
CALIBRATION = 5000
#: Share of the calibration texts of a language that the rejection threshold lets pass.
PASSED = 0.999
_U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code of each code point: letters as 16 bits (higher planes folded), all else 0, the word boundary."""
    code = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if chr(c).isalpha():
            code[c] = (c & 0xFFFF) or 1
    return code


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """ORDER-grams of the lower-cased letters of the texts, four 16-bit codes in a word, newest last, and the
    number of grams of each text. Every run of other characters is one boundary; texts without a letter have none."""
    letters = _letters()
    lengths, parts = [], []
    for t in texts:
        code = letters[np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        if code.any():
            keep = code > 0
            keep[1:] |= code[:-1] > 0  # the first boundary after a letter stays
            code = code[keep]
            parts.append(np.concatenate([np.zeros(ORDER - 1, np.uint16), code]).astype(np.uint64))
            lengths.append(len(code))
        else:
            lengths.append(0)
    if not parts:
        return np.zeros(0, np.uint64), np.array(lengths, np.int64)
    code = np.concatenate(parts)
    gram = np.zeros(len(code), np.uint64)
    for k in range(ORDER):
        gram[k:] |= code[: len(code) - k] << _U(16 * k)
    starts = np.zeros(len(code), np.bool_)
    size = np.array([len(p) for p in parts])
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    for k in range(ORDER - 1):
        starts[at + k] = True
    return gram[~starts], np.array(lengths, np.int64)


def slot(gram: np.ndarray) -> np.ndarray:
    return (mix(gram + _U(0x632BE59BD9B4E019)) >> _U(64 - HASH_BITS)).astype(np.int64)


def _low(gram: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` characters of a gram."""
    return gram & _U((1 << 16 * order) - 1)


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all texts; tasks add up before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                gram, n = _summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )
            held.clear()

        for batch in narrow_batches(batches):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in set(langs):
                gram, _ = grams([t for t, x in zip(texts, langs) if x == lang])
                found, n = np.unique(gram, return_counts=True)
                held.setdefault(lang, []).append((found, n))
                size += len(found)
            if size > 2_000_000:
                for lang, parts in held.items():
                    held[lang] = [_summed(parts)]
                size = sum(len(p[0][0]) for p in held.values())
                if size > 1_000_000:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = docs.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram = np.concatenate([p[0] for p in parts])
    order = np.argsort(gram)
    gram, n = gram[order], np.concatenate([p[1] for p in parts])[order]
    new = np.flatnonzero(np.diff(gram, prepend=gram[:1] ^ _U(1)))
    return gram[new], np.add.reduceat(n, new) if len(new) else n


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``order, lang, gram, logp, gamma`` of all grams of all orders.

    ``logp`` is the interpolated log probability of the last character after the others, ``gamma`` the log weight that is
    left for shorter histories after this gram as a history (null if it is none).
    """
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        last = F.col("gram").bitwiseAND((1 << 16 * k) - 1)
        tables[k] = stored(
            tables[k + 1].groupBy("lang", last.alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams_{k}"
        )
    out, lower = None, None
    for k in range(1, ORDER + 1):
        history = F.shiftrightunsigned("gram", 16)
        table = tables[k].withColumn("history", history)
        # absolute discount from the grams seen once and twice
        discount = table.groupBy("lang").agg(
            (
                F.count(F.when(F.col("n") == 1, 1))
                / (F.count(F.when(F.col("n") == 1, 1)) + 2 * F.count(F.when(F.col("n") == 2, 1)) + 1)
            ).alias("seen"),
        )
        totals = table.groupBy("lang", "history").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        totals = totals.join(discount, "lang").withColumn("d", F.least(F.greatest("seen", F.lit(0.1)), F.lit(0.9)))
        totals = totals.withColumn("left", F.col("d") * F.col("kinds") / F.col("total"))
        table = table.join(totals, ["lang", "history"])
        if lower is None:
            below = F.lit(1.0 / ALPHABET)
        else:
            table = table.withColumn("suffix", F.col("gram").bitwiseAND((1 << 16 * (k - 1)) - 1)).join(
                lower, ["lang", "suffix"]
            )
            below = F.col("below")
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("left") * below
        solved = stored(table.select("lang", "gram", F.log(p).alias("logp")), f"model_{k}")
        lower = solved.select("lang", F.col("gram").alias("suffix"), F.exp("logp").alias("below"))
        weights = totals.select("lang", F.col("history").alias("gram"), F.log("left").alias("gamma"))
        grams_k = solved.select(F.lit(k).alias("order"), "lang", "gram", "logp", F.lit(None).cast("double").alias("gamma"))
        weights = weights.select(
            F.lit(k - 1).alias("order"), "lang", "gram", F.lit(None).cast("double").alias("logp"), "gamma"
        )
        both = grams_k.unionByName(weights)
        out = both if out is None else out.unionByName(both)
    return out


class Model(NamedTuple):
    langs: list[str]
    slots: list[np.ndarray]  # sorted hashes of the grams of each order, from 0 (nothing) to ORDER
    logp: list[np.ndarray]  # a row per hash and a column per language
    gamma: list[np.ndarray]

    def find(self, order: int, gram: np.ndarray) -> np.ndarray:
        """Row of each gram, -1 if it is in no language's model."""
        key = slot(gram)
        at = np.minimum(np.searchsorted(self.slots[order], key), max(len(self.slots[order]) - 1, 0))
        if not len(self.slots[order]):
            return np.full(len(gram), -1)
        return np.where(self.slots[order][at] == key, at, -1)

    def resolve(self, order: int, gram: np.ndarray) -> np.ndarray:
        """Log probability of the last character per language, with shorter histories where a gram is not known."""
        if order == 0:
            return np.full((len(gram), len(self.langs)), np.log(1.0 / ALPHABET), np.float32)
        at = self.find(order, gram)
        found = np.where(at[:, None] >= 0, self.logp[order][at], np.nan)
        lack = np.isnan(found)
        rows = np.flatnonzero(lack.any(axis=1))
        if len(rows):
            some = gram[rows]
            shorter = self.resolve(order - 1, _low(some, order - 1))
            history = self.find(order - 1, some >> _U(16))
            weight = np.where(history[:, None] >= 0, self.gamma[order - 1][history], 0.0)
            found[rows] = np.where(lack[rows], shorter + np.nan_to_num(weight), found[rows])
        return found


def build(table: DataFrame) -> Model:
    """The model of a ``kneser_ney`` table. Grams are folded to hashes on the executors, so that at most 2**HASH_BITS
    rows per order and language come to the driver; grams that share a hash share the greater values."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = slot(batch.column("gram").to_numpy().astype(np.uint64))
            yield batch.append_column("slot", pa.array(key))

    folded = table.mapInArrow(fold, "order int, lang string, gram long, logp double, gamma double, slot long")
    folded = folded.groupBy("order", "lang", "slot").agg(
        F.max("logp").alias("logp"), F.max("gamma").alias("gamma"), F.min("gram").alias("gram")
    )
    rows = folded.withColumns({"logp": F.col("logp").cast("float"), "gamma": F.col("gamma").cast("float")}).toPandas()
    langs = sorted(rows["lang"].unique())
    column = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    slots, logp, gamma = [], [], []
    for k in range(ORDER + 1):
        own = rows["order"].to_numpy() == k
        keys, at = np.unique(rows["slot"].to_numpy()[own], return_inverse=True)
        for values, name in ((logp, "logp"), (gamma, "gamma")):
            cells = np.full((max(len(keys), 1), len(langs)), np.nan, np.float32)
            cells[at, column[own]] = rows[name].to_numpy()[own]
            values.append(cells)
        slots.append(keys)
    model = Model(langs, slots, logp, gamma)
    # the longest grams are solved for all languages at once, each from one gram that has its hash
    longest = rows[rows["order"] == ORDER].groupby("slot")["gram"].min().sort_index().to_numpy().astype(np.uint64)
    if len(longest):
        logp[ORDER] = model.resolve(ORDER, longest).astype(np.float32)
    return model


class Scorer:
    """A model with a directory into its sorted hashes."""

    def __init__(self, model: Model) -> None:
        self.model, self.table = model, model.logp[ORDER]
        self.at = np.full(1 << HASH_BITS, -1, np.int32)
        self.at[model.slots[ORDER]] = np.arange(len(model.slots[ORDER]))

    def entropy(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy per character of each text and language; nan without a letter."""
        gram, lengths = grams(texts)
        out = np.full((len(texts), len(self.model.langs)), np.nan)
        if not len(gram):
            return out
        row = self.at[slot(gram)]
        values = self.table[np.maximum(row, 0)]
        rare = np.flatnonzero(row < 0)
        if len(rare):
            kinds, back = np.unique(gram[rare], return_inverse=True)
            values[rare] = self.model.resolve(ORDER, kinds)[back]
        full = np.flatnonzero(lengths)
        starts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
        out[full] = -np.add.reduceat(values.astype(np.float64), starts, axis=0) / lengths[full, None]
        return out


_scorers: dict[str, Scorer] = {}


def _split(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _scores(docs: DataFrame, shared: Broadcast, name: str, columns: str) -> DataFrame:
    """Given columns and ``entropy``, an array per language, null without a letter. ``name`` is the model's own, so that
    a Python worker prepares it once."""

    def work(batch: pa.RecordBatch) -> dict:
        scorer = _scorers.get(name)
        if scorer is None:
            _scorers.clear()
            scorer = _scorers[name] = Scorer(shared.value)
        found = scorer.entropy(batch.column("text").to_pylist())
        plain = [None if np.isnan(x[0]) else x.tolist() for x in found]
        return {n: batch.column(n) for n in batch.schema.names if n != "text"} | {"entropy": plain}

    return map_rows(docs, work, f"{columns}, entropy array<double>")


class Calibration(NamedTuple):
    scale: float
    limits: dict[str, float]


def calibrate(scored: DataFrame, langs: list[str]) -> Calibration:
    """The scale of the softmax over cross-entropies that gives the calibration texts' own languages the highest
    likelihood, and per language the cross-entropy that PASSED of its texts stay below."""
    names = F.array(*[F.lit(x) for x in langs])
    own = F.element_at("entropy", F.array_position(names, F.col("lang")).cast("int"))
    known = scored.where(F.col("entropy").isNotNull() & F.col("lang").isin(langs))
    limits = known.groupBy("lang").agg(F.percentile_approx(own, PASSED).alias("limit")).collect()
    rows = known.select("lang", "entropy").orderBy(F.xxhash64("entropy"), "lang").limit(CALIBRATION).collect()
    scale = 10.0
    if rows:
        x = -np.array([r["entropy"] for r in rows])
        goal = np.array([langs.index(r["lang"]) for r in rows])
        best = -np.inf
        for s in (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0):
            z = s * (x - x.max(axis=1, keepdims=True))
            fit = float(np.mean(z[np.arange(len(goal)), goal] - np.log(np.exp(z).sum(axis=1))))
            if fit > best:
                best, scale = fit, s
    return Calibration(scale, {r["lang"]: r["limit"] for r in limits})


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, entropy, rejected`` of every row.

    Documents whose crc32(doc_id as text) mod 4 is 2 are held out from all learning; of the others, remainder 3 calibrates
    and the rest is counted. ``score`` is the share of the predicted language in a softmax over cross-entropies;
    ``rejected`` says that the text is less like the language than nearly all calibration texts. A text that is null,
    empty or without a letter gets ``und``, score 0 and no entropy, as do all if no labelled text has a letter.
    Repeated rows count as often as they occur; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    part = _split(F.col("doc_id"))
    learn = docs.where(F.coalesce(part, F.lit(2)) != 2).where("lang is not null and text is not null")
    counts = stored(count_grams(learn.where(part < 2).select("text", "lang")), "gram_counts")
    model = build(kneser_ney(counts))
    head = docs.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "text")
    if not model.langs:
        none = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy")]
        return head.select("doc_id", "held_out", *none, F.lit(False).alias("rejected"))
    shared, name = spark.sparkContext.broadcast(model), uuid4().hex  # bounded: HASH_BITS, ORDER and the languages
    checked = _scores(learn.where(part == 3).select("lang", "text"), shared, name, "lang string")
    checked = stored(checked, "calibration")
    scale, limits = calibrate(checked, model.langs)
    names = F.array(*[F.lit(x) for x in model.langs])
    caps = F.array(*[F.lit(float(limits.get(x, float("inf")))) for x in model.langs])
    scored = _scores(head, shared, name, "doc_id long, held_out boolean")
    least = F.array_min("entropy")
    best = F.array_position("entropy", least).cast("int")
    share = 1 / F.aggregate(
        "entropy", F.lit(0.0), lambda a, x: a + F.exp(F.greatest(-scale * (x - least), F.lit(-700.0)))
    )
    return scored.select(
        "doc_id",
        "held_out",
        F.when(F.col("entropy").isNull(), F.lit(UNKNOWN)).otherwise(F.get(names, best - 1)).alias("lang_pred"),
        F.when(F.col("entropy").isNull(), F.lit(0.0)).otherwise(share).alias("score"),
        least.alias("entropy"),
        (F.col("entropy").isNull() | (least > F.get(caps, best - 1))).alias("rejected"),
    )
