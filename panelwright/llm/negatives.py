"""Hard negatives by angular triangle filtering.

1. REFERENCES rows are reference directions. Every row stores its angles to them, and the rows are laid out by their nearest
   reference and the angle to it, so that the rows of a chunk lie close together.
2. The angle between an anchor and a row is at least the greatest difference of their angles to a reference, and at most the
   smallest sum (or what the sum leaves of a full turn). The cosines of both, times the norms, bound the score; the
   bounds are widened by more than all rounding.
3. An anchor asks for a window of scores: from its k-th best positive so far on, or what its positives allow a negative.
   Whole chunks and then rows whose bounds miss the window are left out; the others get integer scores.

Anchors go to all tasks in blocks of ANCHORS rows. No row is sent to a task for its label, so a label may hold any share of
the rows. Results don't depend on the references.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import vectors
from panelwright.llm.common import stored
from panelwright.session import scratch_folder

POSITIVES = 5
NEGATIVES = 5
ANCHOR_EVERY = 100
#: A negative's score is at least this share of the positive's, in percent, and at most the positive's.
LEAST_PERCENT = 80
#: Reference directions: a bounded sample by hash; it decides how much is filtered, never what is found.
REFERENCES = 32
#: Anchors that are sent to all tasks at a time.
ANCHORS = 1024
#: Error of an angle's cosine by rounding, many times over: angles are stored as 32-bit floats.
SLACK = 1e-5


def angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of integer vectors to unit references, a row per vector; those of a zero vector are right angles. ``norm`` is
    of the whole vectors, also where ``q`` leaves out components that no reference has."""
    cosine = (q @ references.T) / np.maximum(norm, 1e-300)[:, None]
    return np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def _index(table: DataFrame, references: np.ndarray) -> DataFrame:
    """The rows with ``angles``, ordered by nearest reference and angle to it."""
    arrow = pa.schema(
        [("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64())), ("norm2", pa.float64())]
        + [("angles", pa.list_(pa.float32())), ("nearest", pa.int32()), ("angle", pa.float32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vectors.chunks(batches, 4096):
            norm = np.sqrt(batch.column("norm2").to_numpy())
            found = angles(vectors.matrix(batch.column("q"), references.shape[1]), norm, references)
            nearest = found.argmin(1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, found.size + 1, len(references)), pa.int32()), pa.array(found.ravel())
            )
            columns = [batch.column(f.name) for f in list(arrow)[:5]]
            columns += [lists, pa.array(nearest, pa.int32()), pa.array(found[np.arange(len(found)), nearest])]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    schema = (
        "row long, vec_id long, label long, q array<long>, norm2 double, angles array<float>, nearest int, angle float"
    )
    made = table.select("row", "vec_id", "label", "q", "norm2").mapInArrow(run, schema)
    # the row number also splits copies of one vector, whatever their share
    return stored(
        made.repartitionByRange("nearest", "angle", "row").sortWithinPartitions("nearest", "angle", "row"), "angles"
    )


def score_bounds(
    low: np.ndarray, high: np.ndarray, least_norm: np.ndarray, most_norm: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer score at angles from ``low`` to ``high`` for products of norms between the given ones,
    widened so that rounding can't leave a score outside."""
    most, least = np.cos(low), np.cos(high)
    margin = 1 + SLACK * most_norm
    upper = np.where(most >= 0, most * most_norm, most * least_norm) + margin
    lower = np.where(least >= 0, least * least_norm, least * most_norm) - margin
    return lower, upper


class Anchors:
    """A block of anchors, as the tasks get it."""

    def __init__(self, rows: list, bound: int) -> None:
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.label = np.array([r["label"] for r in rows], np.int64)
        self.q = vectors.query_matrix(rows)
        self.angles = np.array([r["angles"] for r in rows], np.float32)
        self.norm = np.sqrt(np.array([r["norm2"] for r in rows]))
        self.kind = vectors.exact_kind(bound)
        #: Windows of scores of an anchor's positives, a column each; empty ones have ``most`` below ``least``.
        self.least = np.zeros((len(rows), 0), np.int64)
        self.most = np.zeros((len(rows), 0), np.int64)

    def overlapping(
        self, chunk: pa.RecordBatch, least: np.ndarray, most: np.ndarray, alike: bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of the pairs of equal (``alike``) or different labels whose score bounds overlap the
        anchor's window from ``least`` to ``most``; only those are scored."""
        none = np.zeros(0, np.int64)
        size = chunk.num_rows
        label = chunk.column("label").to_numpy()
        norm = np.sqrt(chunk.column("norm2").to_numpy())
        own = chunk.column("angles").flatten().to_numpy().reshape(size, -1)
        # the chunk as a whole
        low, high = own.min(0), own.max(0)
        near = np.maximum(np.maximum(self.angles - high, low - self.angles), 0).max(1)
        far = np.minimum(self.angles + high, 2 * np.pi - self.angles - low).min(1)
        lower, upper = score_bounds(
            near, np.minimum(far, np.pi), self.norm * norm.min(), self.norm * norm.max()
        )
        some = np.isin(self.label, label) if alike else (self.label != label.min()) | (self.label != label.max())
        anchor = np.flatnonzero((upper >= least) & (lower <= most) & (least <= most) & some)
        if not len(anchor):
            return none, none, none
        # each row of it
        mine = self.angles[anchor]
        near = np.zeros((size, len(anchor)), np.float32)
        far = np.full((size, len(anchor)), np.pi, np.float32)
        for k in range(own.shape[1]):
            x, y = own[:, k, None], mine[None, :, k]
            np.maximum(near, np.abs(x - y), out=near)
            total = x + y
            np.minimum(far, np.minimum(total, np.float32(2 * np.pi) - total), out=far)
        product = norm[:, None] * self.norm[None, anchor]
        lower, upper = score_bounds(near, far, product, product)
        pair = (upper >= least[anchor]) & (lower <= most[anchor])
        pair &= (label[:, None] == self.label[anchor]) == alike
        if alike:
            at, other = vectors.own_places(chunk.column("row").to_numpy(), self.row)
            place = np.full(len(self.row), -1)
            place[anchor] = np.arange(len(anchor))
            seen = place[other] >= 0
            pair[at[seen], place[other[seen]]] = False
        rows, columns = np.flatnonzero(pair.any(1)), np.flatnonzero(pair.any(0))
        if not len(rows):
            return none, none, none
        q = vectors.matrix(chunk.column("q").take(pa.array(rows)), self.q.shape[1])
        found = vectors.scores(q, self.q[anchor[columns]], self.kind)
        at, column = np.nonzero(pair[np.ix_(rows, columns)])
        return rows[at], anchor[columns[column]], found[at, column]

    def positives(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``query, vec_id, score``: the best rows of each anchor's label that a task has."""
        best = vectors.Best(len(self.row), POSITIVES)
        for chunk in vectors.chunks(batches):
            at, anchor, score = self.overlapping(
                chunk, best.floor, np.full(len(self.row), -vectors.NO_SCORE), True
            )
            best.add(anchor, score, chunk.column("vec_id").to_numpy()[at])
        columns = [best.query, best.vec_id, best.score]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "vec_id", "score"])

    def with_windows(self, positives: list) -> None:
        """Take the windows of ``(query, rank, score)`` rows; ``rank`` from 1."""
        slots = max((r["rank"] for r in positives), default=0)
        self.least = np.ones((len(self.row), slots), np.int64)
        self.most = np.zeros((len(self.row), slots), np.int64)
        for r in positives:
            self.least[r["query"], r["rank"] - 1] = -(-LEAST_PERCENT * r["score"] // 100)
            self.most[r["query"], r["rank"] - 1] = r["score"]

    def negatives(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``query, slot, vec_id, score``: the best rows of other labels in each window that a task has."""
        slots = self.least.shape[1]
        best = vectors.Best(len(self.row) * slots, NEGATIVES)
        empty = self.least > self.most
        for chunk in vectors.chunks(batches) if slots else ():
            floor = np.maximum(self.least, best.floor.reshape(-1, slots))
            least = np.where(empty, -vectors.NO_SCORE, floor).min(1)
            most = np.where(empty, vectors.NO_SCORE, self.most).max(1)
            at, anchor, score = self.overlapping(chunk, least, most, False)
            vec_id = chunk.column("vec_id").to_numpy()[at]
            for slot in range(slots):
                ok = (score >= floor[anchor, slot]) & (score <= self.most[anchor, slot])
                best.add(anchor[ok] * slots + slot, score[ok], vec_id[ok])
        slot = (best.query % max(slots, 1) + 1).astype(np.int32)
        columns = [best.query // max(slots, 1), slot, best.vec_id, best.score]
        names = ["query", "slot", "vec_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _references(table: DataFrame) -> np.ndarray:
    """The directions of REFERENCES rows by hash; the filter before the order bounds what tasks send to the driver."""
    parts = max(1, table.count() // (8 * REFERENCES))
    some = table.where((F.col("norm2") > 0) & (F.pmod(F.xxhash64("row"), F.lit(parts)) == 0))
    rows = some.orderBy(F.xxhash64("row", F.lit(1)), "row").limit(REFERENCES).collect()
    if not rows:
        return np.ones((1, 1))
    return vectors.query_matrix(rows) / np.sqrt([r["norm2"] for r in rows])[:, None]


def mine(df: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors, the rows whose ``vec_id``
    is divisible by ``every``: the NEGATIVES rows of other labels with the highest scores between LEAST_PERCENT percent of a
    positive's score and that score, for each of the anchor's POSITIVES best other rows of its own label.

    Columns ``vec_id``, ``embedding`` and ``label`` (integers). Rows without id, label or vector and vectors with a null
    or non-finite component take no part. Ties go to the smaller ``vec_id``. Rows that repeat an id, or a whole row, count
    each for itself; only an anchor's own row is no positive of it. A positive of negative score has no negatives, one of
    score zero those of score zero. Vectors of different lengths compare as if the shorter one went on with zeros. Vectors
    whose products don't fit 64 bits raise an error. An empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    labelled = df.where("label is not null").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    table = vectors.quantised(labelled, "label")
    bound = vectors.largest_product(table)
    references = _references(table)
    index = _index(table, references)
    folder = scratch_folder(spark, "hard_negatives")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    spark.createDataFrame([], schema).write.parquet(folder)
    for rows in vectors.blocks(index.where(F.col("vec_id") % every == 0), ANCHORS):
        block = Anchors(rows, bound)
        found = index.mapInArrow(block.positives, "query long, vec_id long, score long")
        best = _ranked(found, ["query"], POSITIVES).collect()  # POSITIVES rows for each anchor of the block
        block.with_windows(best)
        made = index.mapInArrow(block.negatives, "query long, slot int, vec_id long, score long")
        pairs = [(r["query"], r["rank"], rows[r["query"]]["vec_id"], r["vec_id"], r["score"]) for r in best]
        names = spark.createDataFrame(
            pairs, "query long, slot int, anchor_id long, positive_id long, positive_score long"
        )
        out = _ranked(made, ["query", "slot"], NEGATIVES).join(F.broadcast(names), ["query", "slot"])
        out = out.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        out.select(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)
