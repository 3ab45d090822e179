"""Exact top-k search by distributed histogram selection.

Every query is scored against every row. The queries go to all tasks in blocks of QUERIES rows, which bounds what is
broadcast; the candidates are read where they lie and are not shuffled.

1. A round counts the scores of each query in BINS equal bins of the range that still holds its k-th value; the counts of
   all tasks are added, and the bin with the k-th value is the next round's range, until bins are single integers. Two
   rounds suffice for unit vectors. A task sends no bin below its own k-th value, as the k-th of all is not lower.
2. The last pass keeps the scores from the k-th value on. Of equal scores a task keeps the k smallest ids, so copies of one
   vector in any number send k rows a task. Ties are broken by the smaller id.

Scores are made anew in each round and never stored: they are as many as queries times rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import vectors
from panelwright.session import scratch_folder

TOP = 5
QUERY_EVERY = 50
#: Queries that are sent to all tasks at a time.
QUERIES = 1024
#: Bins of a histogram; a power of two.
BINS = 512


class Block:
    """A block of queries, as the tasks get it."""

    def __init__(self, rows: list, k: int, bound: int) -> None:
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.q = vectors.query_matrix(rows)
        self.kind = vectors.exact_kind(bound)
        self.k = k
        #: Each query's range starts at ``low`` and has BINS bins of 2**shift scores.
        self.low = np.full(len(rows), -bound, np.int64)
        self.shift = max(0, (2 * bound + 1).bit_length() - BINS.bit_length() + 1)
        #: How many of the k lie in the range; those above it are sure.
        self.need = np.full(len(rows), k, np.int64)
        #: Queries with fewer than k candidates, which take all.
        self.all = np.zeros(len(rows), np.bool_)

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for chunk in vectors.chunks(batches):
            found = vectors.scores(vectors.matrix(chunk.column("q"), self.q.shape[1]), self.q, self.kind)
            found[vectors.own_places(chunk.column("row").to_numpy(), self.row)] = vectors.NO_SCORE
            yield chunk, found

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``query, need, bin, n``: the bins of the ranges from the task's own k-th value on."""
        n = len(self.row)
        counts = np.zeros((n, BINS), np.int64)
        first = np.zeros(n, np.int64)
        for _, found in self.scored(batches):
            bins = (found - self.low) >> self.shift
            at, query = np.nonzero((bins >= first) & (bins < BINS))
            counts += np.bincount(query * BINS + bins[at, query], minlength=n * BINS).reshape(n, BINS)
            higher = np.cumsum(counts[:, ::-1], axis=1)
            first = np.maximum(0, BINS - 1 - (higher < self.need[:, None]).sum(1))
        query, bins = np.nonzero(counts * (np.arange(BINS) >= first[:, None]))
        columns = [query, self.need[query], bins, counts[query, bins]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "need", "bin", "n"])

    def refine(self, candidates: DataFrame) -> bool:
        """One round: the ranges become the bins that hold the k-th values. False when they are single scores."""
        parts = candidates.mapInArrow(self.counts, "query long, need long, bin long, n long")
        sums = parts.groupBy("query", "need", "bin").agg(F.sum("n").alias("n"))
        higher = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin")))
        holds = sums.withColumn("upto", higher).where("upto >= need and upto - n < need")
        low, need = self.low.copy(), self.need.copy()
        full = np.zeros(len(self.row), np.bool_)
        for r in holds.select("query", "bin", (F.col("upto") - F.col("n")).alias("above")).collect():
            low[r["query"]] += r["bin"] << self.shift
            need[r["query"]] -= r["above"]
            full[r["query"]] = True
        # without a k-th value there are fewer than k candidates; this shows in the first round and stays so
        self.all |= ~full
        more = self.shift > 0
        self.low, self.need = low, need
        self.shift = max(0, self.shift - BINS.bit_length() + 1)
        return more

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``query, vec_id, score`` of the scores that are not below the k-th value, k a query at most."""
        least = np.where(self.all, vectors.NO_SCORE + 1, self.low)
        kept = vectors.Best(len(self.row), self.k)
        for chunk, found in self.scored(batches):
            at, query = np.nonzero(found >= np.maximum(least, kept.floor))
            kept.add(query, found[at, query], chunk.column("vec_id").to_numpy()[at])
        columns = [kept.query, kept.vec_id, kept.score]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "vec_id", "score"])


def search(df: DataFrame, k: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest integer inner product for each row whose ``vec_id`` is
    divisible by ``every``.

    Rows without ``vec_id`` or vector and vectors with a null or non-finite component take no part. Only a query's own row
    is no candidate of it: rows that repeat an id, or a whole row, are queries and candidates each for itself. A query with
    fewer than ``k`` candidates gets all. Ties go to the smaller ``vec_id``. Vectors of different lengths compare as if
    the shorter one went on with zeros. Vectors whose products don't fit 64 bits raise an error. An empty table gives no
    rows; other columns are ignored.
    """
    spark = df.sparkSession
    table = vectors.quantised(df)
    bound = vectors.largest_product(table)
    candidates = table.select("row", "vec_id", "q")
    folder, schema = scratch_folder(spark, "top_k"), "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for rows in vectors.blocks(candidates.where(F.col("vec_id") % every == 0), QUERIES):
        block = Block(rows, k, bound)
        while block.refine(candidates):
            pass
        found = candidates.mapInArrow(block.best, "query long, vec_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, r["vec_id"]) for i, r in enumerate(rows)], "query long, query_id long")
        # a block of at most QUERIES ids
        named = found.join(F.broadcast(ids), "query").select("query_id", "rank", "vec_id", "score")
        named.write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)
