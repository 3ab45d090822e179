"""Integer vectors: quantised rows, exact inner products in blocks and the best rows of each query."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import stored

SCALE = 256
#: Rows of candidates that a task multiplies with a block of queries at a time.
CHUNK = 512
#: A score that no pair has.
NO_SCORE = -(1 << 62)


def quantised(vectors: DataFrame, *columns: str) -> DataFrame:
    """``row, vec_id, q, norm2`` and the given columns of the rows whose vector has neither null nor non-finite components:
    ``q`` holds floor(SCALE * x), ``row`` numbers the rows, so that equal rows stay apart. The table is written."""

    def odd(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    rows = vectors.where("vec_id is not null and embedding is not null").where(~F.exists("embedding", odd))
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), *columns, q.alias("q"))
    norm2 = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "*", norm2.alias("norm2")), "vectors")


def largest_product(table: DataFrame) -> int:
    """A bound on the inner products of all pairs of rows and on all sums of some of their terms; 0 for an empty table."""
    norm2 = table.agg(F.max("norm2")).first()[0] or 0.0
    if norm2 >= 1 << 61:
        raise ValueError("the vectors' inner products don't fit a 64-bit integer")
    return int(norm2 * (1 + 1e-9)) + 1


def blocks(queries: DataFrame, size: int) -> Iterator[list]:
    """The queries' rows in blocks of at most ``size``, sorted by ``row``; the driver holds about one block at a time."""
    parts = max(1, -(-queries.count() // size))
    for part in range(parts):
        rows = queries.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).collect()
        rows.sort(key=lambda r: r["row"])
        for start in range(0, len(rows), size):
            yield rows[start : start + size]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as a matrix; shorter lists go on with zeros, components beyond ``width`` are left out."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), width), np.int64)
    out[row[at < width], at[at < width]] = values[at < width]
    return out


def query_matrix(rows: list) -> np.ndarray:
    return matrix(pa.array([r["q"] for r in rows], pa.list_(pa.int64())), max(len(r["q"]) for r in rows))


def exact_kind(bound: int) -> type:
    """The fastest type in which all sums up to ``bound`` are exact."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def scores(candidates: np.ndarray, queries: np.ndarray, kind: type) -> np.ndarray:
    """Inner products, a row per candidate and a column per query; ``kind`` is the type of exact_kind."""
    return (candidates.astype(kind) @ queries.astype(kind).T).astype(np.int64)


def chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def own_places(rows: np.ndarray, query_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(candidate, query) indices of the rows that are queries themselves; ``query_rows`` ascends."""
    at = np.minimum(np.searchsorted(query_rows, rows), len(query_rows) - 1)
    own = np.flatnonzero(query_rows[at] == rows)
    return own, at[own]


class Best:
    """The ``k`` best (score, vec_id) of each query: higher scores first, ties by the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.queries, self.k = queries, k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.vec_id = np.zeros(0, np.int64)
        #: The k-th best score of each query so far; lower scores can't be among the best.
        self.floor = np.full(queries, NO_SCORE, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(query):
            return
        query = np.concatenate([self.query, query])
        score = np.concatenate([self.score, score])
        vec_id = np.concatenate([self.vec_id, vec_id])
        order = np.lexsort((vec_id, -score, query))
        query, score, vec_id = query[order], score[order], vec_id[order]
        first = np.searchsorted(query, np.arange(self.queries))
        rank = np.arange(len(query)) - first[query]
        keep = rank < self.k
        self.query, self.score, self.vec_id = query[keep], score[keep], vec_id[keep]
        self.floor[query[rank == self.k - 1]] = score[rank == self.k - 1]
