"""Packing of token sequences by non-negative least squares over length combinations.

Documents are cut at multiples of the window; the histogram of piece lengths (at most ``window`` bins) goes to the
driver. Shallow combinations of lengths that fill a window exactly are enumerated, their repeat counts are solved by
non-negative least squares against the histogram and rounded down, and what is left is packed greedily, longest first.
The plan says which ranks of each length go to which sequences; pieces are ranked within their length by counts per
salt, so that a length with very many pieces is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.bpe import encode_ids
from panelwright.llm.common import map_rows, stored

WINDOW = 2048
END = 1
#: Pieces of one length that one task ranks, about.
RANKED = 50_000
#: Lengths, by their number of pieces, that enter combinations of three and more.
FREQUENT = 96


class Share(NamedTuple):
    """Ranks ``low`` to ``high`` (exclusive) of pieces of one length, dealt over ``times`` sequences from ``base`` on;
    the pieces dealt first lie at ``offset``, the next round behind them."""

    length: int
    low: int
    high: int
    base: int
    times: int
    offset: int


def combinations(hist: np.ndarray) -> list[tuple[int, ...]]:
    """Combinations of lengths with pieces that add up to the window: all pairs, and repeats of a frequent length, or
    of two frequent lengths, with the length that completes them."""
    window = len(hist) - 1
    have = np.flatnonzero(hist[:window])
    found = {(int(a), window - int(a)) for a in have if 2 * a >= window and hist[window - a]}
    often = have[np.argsort(-hist[have], kind="stable")][:FREQUENT].tolist()
    for a in often:
        for times in range(2, window // a + 1):
            rest = window - times * a
            if rest == 0 or hist[rest]:
                found.add(tuple(sorted([a] * times + [rest] * (rest > 0), reverse=True)))
            if times >= 8:
                break
        for b in often:
            rest = window - a - b
            if 0 < rest and hist[rest]:
                found.add(tuple(sorted((a, b, rest), reverse=True)))
    return sorted(found)


def least_squares(combos: list[tuple[int, ...]], hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist|^2, by accelerated projected gradients; A holds how often each
    combination uses each length."""
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.concatenate([np.array(c, np.int64) for c in combos])
    uses = lambda x: np.bincount(row, x[column], len(hist))
    pull = lambda r: np.bincount(column, r[row], len(combos))
    size = np.bincount(column).astype(float)
    bound = float(np.max(np.bincount(row, size[column], len(hist))))  # no less than the norm of A'A
    goal = hist.astype(float)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - pull(uses(y) - goal) / bound)
        ahead = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / ahead * (new - x), new, ahead
    return x


def _greedy(left: np.ndarray) -> Iterable[tuple[dict[int, int], int]]:
    """Patterns {length: count} and their number: longest first, then the longest that still fits. A pattern repeats as
    long as the pieces last, so every one uses up a length."""
    while left.any():
        room, pattern = len(left) - 1, {}
        spare = left.copy()
        while room > 0:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            a = int(fits[-1])
            n = int(min(spare[a], room // a))
            pattern[a] = n
            spare[a] = 0
            room -= n * a
        times = min(int(left[a]) // n for a, n in pattern.items())
        for a, n in pattern.items():
            left[a] -= n * times
        yield pattern, times


def plan(hist: np.ndarray) -> list[Share]:
    """``hist[n]`` pieces of length n; the last index is the window. Every piece gets a place exactly once."""
    left = hist.astype(np.int64).copy()
    window = len(left) - 1
    patterns: list[tuple[dict[int, int], int]] = []
    if left[window]:
        patterns.append(({window: 1}, int(left[window])))
        left[window] = 0
    combos = combinations(left)
    if combos:
        solved = least_squares(combos, left)
        for k in np.argsort(-solved, kind="stable"):
            need: dict[int, int] = {}
            for a in combos[k]:
                need[a] = need.get(a, 0) + 1
            times = min(int(solved[k] + 0.5), *(int(left[a]) // n for a, n in need.items()))
            if times > 0:
                patterns.append((need, times))
                for a, n in need.items():
                    left[a] -= n * times
    patterns.extend(_greedy(left))
    used = np.zeros(window + 1, np.int64)
    shares, base = [], 0
    for pattern, times in patterns:
        offset = 0
        for a in sorted(pattern, reverse=True):
            n = pattern[a]
            shares.append(Share(a, int(used[a]), int(used[a]) + n * times, base, times, offset))
            used[a] += n * times
            offset += n * a
        base += times
    return shares


def pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) of every piece: whole windows and the rest of each
    document, its end token included."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode_ids(path, batch.column("text"))):
            ids = np.append(ids.astype("<u4"), np.uint32(END))
            for start in range(0, len(ids), window):
                part = ids[start : start + window]
                row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                rows.append((*row, part.astype(np.int32)) if with_ids else row)
        return dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


def _ranked(cut: DataFrame) -> DataFrame:
    """``rank`` from 0 among the pieces of one length."""
    salts = max(1, -(-cut.count() // RANKED))
    cut = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    counts = cut.groupBy("length", "_salt").count()
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "start")
    numbered = cut.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(counts, ["length", "_salt"]).withColumn("rank", F.col("_before") + F.col("_own"))


def pack(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; no sequence exceeds the window.

    Null and empty texts are one end token; rows that repeat a ``doc_id`` are packed each for itself; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, window, with_ids), "pieces")
    hist = np.zeros(window + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``window`` rows
        hist[row["length"]] = row["count"]
    schema = "length long, low long, high long, base long, times long, first long"
    shares = spark.createDataFrame([tuple(s) for s in plan(hist)], schema)
    # the plan's size follows from the window, not from the documents
    placed = _ranked(cut).join(F.broadcast(shares), "length").where("rank >= low and rank < high")
    at = F.col("rank") - F.col("low")
    out = placed.withColumn("sequence_id", F.col("base") + at % F.col("times")).withColumn(
        "offset", F.col("first") + F.floor(at / F.col("times")) * F.col("length")
    )
    return out.select(*cut.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of pieces packed with their ids: the token ids in order, at most a window each."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
