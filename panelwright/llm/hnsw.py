"""Near-duplicate vectors with hierarchical navigable small-world graphs.

Equal vectors of a label are one class. The classes of a label are dealt into shards of about SHARD vectors, a graph is built for
each shard, and the vectors of every shard of the label, in blocks, query every shard. Queries whose cosines a bound over some of
the coordinates keeps below the threshold for all of a shard have no links there and don't walk its graph. A beam is widened for a query
while all it holds is over the threshold, and for a whole block while an audit of some of its queries
against brute force finds less than RECALL of their links. Candidates are verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import components, stored

THRESHOLD = 0.98
#: Vectors of a graph, about.
SHARD = 2048
#: Links that a new vector gets; at most twice as many are kept.
DEGREE = 16
#: Beam of the building; the first beam of the queries.
BEAM = 64
RECALL = 0.999
#: One query in this many is audited.
AUDIT = 20
#: Queries that walk a graph together.
TOGETHER = 256
#: Coordinates that bound a cosine from above at least, of few components; of many, three in eight.
HEAD = 24
#: Shards that query in one task, at most; each of the label's graphs is sent to as many tasks as this makes.
ASKED = 16


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square over- or underflows."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Graph:
    """Layers of neighbour lists over unit vectors. ``near[l][i]`` holds i's neighbours on layer l, padded with -1; a vector
    is on layer l if ``level[i] >= l``. Levels come from the position: every DEGREE-th vector is one layer higher."""

    def __init__(self, vectors: np.ndarray, near: list[np.ndarray] | None = None) -> None:
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        at = np.arange(n)
        self.level = np.zeros(n, np.int64)
        step = DEGREE
        while step < n:
            self.level[at % step == 0] += 1
            step *= DEGREE
        self.near = near
        if near is None:
            self.near = [np.full((n, 2 * DEGREE), -1, np.int32) for _ in range(int(self.level.max(initial=0)) + 1)]
            self._build(n)

    def _build(self, n: int) -> None:
        done = min(n, BEAM)
        for layer in range(len(self.near)):
            self._link(np.arange(done)[self.level[:done] >= layer], None, layer)
        while done < n:
            new = np.arange(done, min(n, done + max(BEAM, done // 2)))
            start = np.zeros((len(new), 1), np.int64)  # vector 0 is on every layer
            for layer in range(len(self.near) - 1, -1, -1):
                found, _ = self.walk(self.x[new], start, BEAM, layer)
                own = self.level[new] >= layer
                if own.any():
                    self._link(new[own], found[own], layer)
                start = found[:, :1]
            done = int(new[-1]) + 1

    def _link(self, new: np.ndarray, found: np.ndarray | None, layer: int) -> None:
        """Link new vectors to what their search found and to each other, both ways."""
        near = self.near[layer]
        if len(new) < 2 and found is None:
            return
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            mates = self.x[part] @ self.x[new].T
            mates[np.arange(len(part)), np.arange(at, at + len(part))] = -np.inf
            k = min(DEGREE, len(new) - 1)
            options = np.zeros((len(part), 0), np.int64)
            if k > 0:
                options = new[np.argpartition(-mates, k - 1, axis=1)[:, :k]]
            if found is not None:
                options = np.concatenate([options, found[at : at + TOGETHER]], axis=1)
            near[part, :DEGREE] = self._choose(part, options, DEGREE)
        # the other direction: each target takes its new neighbours and keeps the best
        target = near[new, :DEGREE].ravel()
        source = np.repeat(new, DEGREE)[target >= 0]
        target = target[target >= 0].astype(np.int64)
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        slot = np.arange(len(target)) - np.repeat(first, count)
        for at in range(0, len(nodes), TOGETHER):
            part = nodes[at : at + TOGETHER]
            rows = slice(first[at], first[at] + int(count[at : at + TOGETHER].sum()))
            wide = np.full((len(part), int(count[at : at + TOGETHER].max())), -1, np.int64)
            wide[np.repeat(np.arange(len(part)), count[at : at + TOGETHER]), slot[rows]] = source[rows]
            options = np.concatenate([near[part].astype(np.int64), wide], axis=1)
            near[part] = self._choose(part, options, 2 * DEGREE)

    def _choose(self, nodes: np.ndarray, options: np.ndarray, keep: int) -> np.ndarray:
        """Of each node's options the nearest that are nearer to it than to any chosen one; then the nearest others."""
        options = np.where(options == nodes[:, None], -1, options)
        ordered = np.sort(options, axis=1)
        repeat = np.zeros(options.shape, np.bool_)
        repeat[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
        options = np.where(repeat, -1, ordered)
        alike = np.einsum("qmd,qd->qm", self.x[np.maximum(options, 0)], self.x[nodes])
        alike = np.where(options >= 0, alike, -np.inf)
        order = np.argsort(-alike, axis=1)[:, : 3 * keep]
        options, alike = np.take_along_axis(options, order, 1), np.take_along_axis(alike, order, 1)
        x = self.x[np.maximum(options, 0)]
        between = np.einsum("qmd,qkd->qmk", x, x)
        chosen = np.zeros(options.shape, np.bool_)
        closest = np.full(options.shape, -np.inf, np.float32)  # similarity to the nearest chosen one
        for m in range(options.shape[1]):
            take = (options[:, m] >= 0) & (closest[:, m] < alike[:, m]) & (chosen.sum(axis=1) < keep)
            chosen[:, m] = take
            closest = np.where(take[:, None], np.maximum(closest, between[:, m]), closest)
        rank = np.where(options >= 0, np.where(chosen, 0, 1), 2)
        best = np.argsort(rank, axis=1, kind="stable")[:, :keep]
        out = np.full((len(nodes), keep), -1, np.int64)
        out[:, : best.shape[1]] = np.take_along_axis(options, best, 1)
        return out

    def walk(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities, best first, of what beams of the given width find; -1 where a beam isn't full."""
        ids = np.full((len(queries), beam), -1, np.int64)
        alike = np.full((len(queries), beam), -np.inf, np.float32)
        for at in range(0, len(queries), TOGETHER):
            s = slice(at, at + TOGETHER)
            ids[s], alike[s] = self._walk(queries[s], start[s], beam, layer)
        return ids, alike

    def _walk(self, queries, start, beam, layer):
        q, n = len(queries), len(self.x)
        seen = np.zeros((q, n), np.bool_)
        ids = np.full((q, beam), -1, np.int64)
        alike = np.full((q, beam), -np.inf, np.float32)
        k = min(start.shape[1], beam)
        ids[:, :k] = start[:, :k]
        alike[:, :k] = np.einsum("qmd,qd->qm", self.x[np.maximum(ids[:, :k], 0)], queries)
        alike[ids < 0] = -np.inf
        rows = np.arange(q)
        seen[np.repeat(rows, k), np.maximum(ids[:, :k], 0).ravel()] = True
        spent = ids < 0
        live = rows
        width = max(1, min(4, beam // 8))  # entries that are followed in one step
        while len(live):
            worth = np.where(spent[live], -np.inf, alike[live])
            pick = np.argpartition(-worth, width - 1, axis=1)[:, :width] if width < beam else np.argsort(-worth, axis=1)
            open_ = np.take_along_axis(worth, pick, 1) > -np.inf
            going = open_.any(axis=1)
            live, pick, open_ = live[going], pick[going], open_[going]
            if not len(live):
                break
            spent[live[:, None], pick] = True
            source = np.where(open_, ids[live[:, None], pick], 0)
            found = np.where(open_[:, :, None], self.near[layer][source], -1).reshape(len(live), -1)
            found = np.sort(found, axis=1)
            fresh = found >= 0
            fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
            fresh &= ~seen[live[:, None], np.maximum(found, 0)]
            r, c = np.nonzero(fresh)
            seen[live[r], found[r, c]] = True
            new = np.full(found.shape, -np.inf, np.float32)
            new[r, c] = np.einsum("md,md->m", self.x[found[r, c]], queries[live[r]])
            both = np.concatenate([alike[live], new], axis=1)
            best = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
            alike[live] = np.take_along_axis(both, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, found, -1)], axis=1), best, 1)
            old = np.concatenate([spent[live], ~fresh], axis=1)
            spent[live] = np.take_along_axis(old, best, 1)
        order = np.argsort(-alike, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(alike, order, 1)

    def over(self, queries: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) of what the beams find over the threshold. A beam that holds nothing below it is doubled."""
        start = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.near) - 1, 0, -1):
            start = self.walk(queries, start, 1, layer)[0]
        rows, columns = [], []
        left = np.arange(len(queries))
        while len(left):
            beam = min(beam, len(self.x))
            ids, alike = self.walk(queries[left], start[left], beam, 0)
            full = (alike[:, -1] >= threshold) & (beam < len(self.x))
            r, c = np.nonzero((alike >= threshold) & (ids >= 0) & ~full[:, None])
            rows.append(left[r])
            columns.append(ids[r, c])
            left = left[full]
            beam *= 2
        return np.concatenate(rows), np.concatenate(columns)


def may_link(exact: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Which unit queries may have a cosine of THRESHOLD or more with any of the unit vectors.

    A product is at most that of some coordinates and the product of the lengths of the rest (Cauchy-Schwarz). The coordinates
    are those that vary most among the vectors; rounding only lets a query pass."""
    head = np.argsort(-exact.var(axis=0))[: max(HEAD, 3 * exact.shape[1] // 8)]

    def bounding(x: np.ndarray) -> np.ndarray:
        part = x[:, head]
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("md,md->m", part, part)))
        return np.concatenate([part, rest[:, None]], axis=1).astype(np.float32)

    own, asked = bounding(exact).T, bounding(queries)
    found = [(asked[at : at + TOGETHER] @ own).max(axis=1) for at in range(0, len(asked), TOGETHER)]
    return np.concatenate(found) >= THRESHOLD - 1e-4


def links(graph: Graph, exact: np.ndarray, queries: np.ndarray, audited: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs of unit vectors with a cosine of THRESHOLD or more. ``audited`` queries are compared with all
    vectors of the graph, and the first beam is doubled until RECALL of their links is found."""
    beam = BEAM
    near = np.flatnonzero(may_link(exact, queries))
    if not len(near):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    truth = queries[np.intersect1d(audited, near)] @ exact.T >= THRESHOLD
    while True:
        q, v = graph.over(queries[near].astype(np.float32), THRESHOLD - 1e-5, beam)
        q = near[q]
        good = np.einsum("md,md->m", queries[q], exact[v]) >= THRESHOLD
        q, v = q[good], v[good]
        mine = np.isin(q, audited)
        if mine.sum() >= RECALL * truth.sum() or beam >= len(exact):
            return q, v
        beam *= 2


_SHARD = "label {}, dim long, shard long, shards long, ids binary, vectors binary, near binary, layers int"


def shards(classes: DataFrame) -> DataFrame:
    """One row per shard of a label and dimension: ids, vectors and graph as bytes."""
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("shards"))
    dealt = classes.join(sizes, ["label", "dim"]).select(
        "label", "dim", F.pmod(F.xxhash64("least"), F.col("shards")).alias("shard"), "shards", "least", "embedding"
    )
    kind = classes.schema["label"].dataType.simpleString()

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("least")
        vectors = np.array(table.column("embedding").to_pylist(), np.float64)
        graph = Graph(unit(vectors))
        row = {
            "label": pa.array([key[0].as_py()], key[0].type),
            "dim": [vectors.shape[1]],
            "shard": [key[2].as_py()],
            "shards": [key[3].as_py()],
            "ids": [table.column("least").to_numpy().astype(np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
            "near": [np.stack(graph.near).astype(np.int32).tobytes()],
            "layers": pa.array([len(graph.near)], pa.int32()),
        }
        return pa.table(row)

    grouped = dealt.groupBy("label", "dim", "shard", "shards")
    return grouped.applyInArrow(build, _SHARD.format(kind))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            ids, asked = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["asked"], np.int64)
            exact = unit(np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1))
            queries = unit(np.frombuffer(row["queries"], np.float64).reshape(len(asked), -1))
            near = np.frombuffer(row["near"], np.int32).reshape(row["layers"], len(ids), -1)
            q, v = links(Graph(exact, list(near)), exact, queries, np.arange(0, len(asked), AUDIT))
            u, v = asked[q], ids[v]
            other = u != v
            yield pa.RecordBatch.from_arrays([pa.array(u[other]), pa.array(v[other])], names=["u", "v"])


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, label, embedding``).

    Only rows with the same label and number of components are compared. A row whose label or vector is null, or whose vector
    is empty, zero, or holds null or non-finite components, has no links and is its own component. Equal vectors of a
    label link with each other, repeated rows included. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.col("label").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    fit = F.coalesce(fit, F.lit(False))
    good = rows.where(fit).withColumn("dim", F.size("embedding").cast("long"))
    classes = good.groupBy("label", "dim", "embedding").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    classes = stored(classes, "vector_classes")
    index = stored(shards(classes), "vector_graphs")
    turn = F.floor(F.col("shard") / ASKED).alias("turn")
    asking = index.select("label", "dim", turn, F.col("ids").alias("asked"), F.col("vectors").alias("queries"))
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("shards") - 1) / ASKED)))
    meet = index.withColumn("turn", turns).join(asking.hint("merge"), ["label", "dim", "turn"])
    meet = meet.select("ids", "vectors", "near", "layers", "asked", "queries")
    found = meet.mapInArrow(_search, "u long, v long")
    # either direction of a link may have been found
    pairs = found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = stored(pairs, "vector_links")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    copies = classes.select(F.col("least").alias("v"), "copies")
    linked = both.join(copies, "v").groupBy(F.col("u").alias("least")).agg(F.sum("copies").alias("others"))
    joined = components(pairs, "vector_components").withColumnRenamed("node", "least")
    known = classes.join(linked, "least", "left").join(joined, "least", "left")
    known = known.select(
        "label",
        "embedding",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("component_id"),
    )
    known = stored(known, "vector_components")
    ends = good.drop("dim").join(known.hint("merge"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ends.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
