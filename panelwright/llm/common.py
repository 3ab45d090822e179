"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.session import scratch_folder, stored

__all__ = ["components", "drop_folder", "give_back", "map_rows", "narrow_batches", "read_table", "rewrite_texts", "stored"]

#: Spans that are sent to all tasks.
BROADCAST_SPANS = 500_000
#: Bytes of rows that go to a Python task at a time, besides one row of any length; both sides hold them several times.
BATCH_BYTES = "4m"
#: Characters of text that a Python task holds at a time, besides one document of any length.
SLICE_CHARS = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def give_back() -> None:
    """Return freed memory to the system, as a Python worker goes on with other tasks; the C library keeps what lies between
    blocks in use until it is asked."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Let the session send rows to Python tasks by BATCH_BYTES, as a number of rows says little about the memory of texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def narrow_batches(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that memory follows the longest
    document and not the number of rows in a batch."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_rows(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``work`` turns a batch with a ``text`` column into columns of the given schema."""
    arrow = _arrow_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in narrow_batches(batches):
            columns = work(batch)
            yield pa.RecordBatch.from_arrays(
                [_array(columns[field.name], field.type) for field in arrow], schema=arrow
            )
        columns = batch = None
        give_back()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def rewrite_texts(
    docs: DataFrame, edits: DataFrame, change: Callable[[str, list[dict]], str], drop_blank: bool = False
) -> DataFrame:
    """``docs`` with ``text`` changed where ``edits`` (``doc_id, text_hash, spans``, stored, one row for each id and xxhash64 of a
    text) has spans for it; ``n_chars``, if there is such a column, is counted anew there. ``drop_blank`` drops texts of
    which only white space is left. Rows that share an id are changed by their own text's spans.
    Few edits go to the documents; beyond BROADCAST_SPANS, both are shuffled."""
    key, text_hash, spans = fresh(docs, "edited_id"), fresh(docs, "edited_hash"), fresh(docs, "edited_spans")
    few = (edits.agg(F.sum(F.size("spans"))).first()[0] or 0) <= BROADCAST_SPANS
    edits = edits.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.col("spans").alias(spans))
    edits = F.broadcast(edits) if few else edits.hint("merge")
    small_batches(docs.sparkSession)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(docs["text"]) == F.col(text_hash))
    joined = docs.join(edits, same, "left").drop(key, text_hash)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in narrow_batches(batches):
            found = batch.column(spans).to_pylist()
            texts = batch.column("text").to_pylist()
            counts = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else None
            stay = [True] * len(texts)
            for i, own in enumerate(found):
                if own and texts[i]:
                    texts[i] = change(texts[i], own)
                    stay[i] = not drop_blank or bool(texts[i].strip(" \t\n\v\f\r"))
                    if counts is not None:
                        counts[i] = len(texts[i])
            new = {"text": texts} | ({"n_chars": counts} if counts is not None else {})
            fields = [f for f in batch.schema if f.name != spans]
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields)).filter(pa.array(stay, pa.bool_()))
        give_back()

    return joined.mapInArrow(run, docs.schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def drop_folder(spark: SparkSession, folder: str) -> None:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _written(edges: DataFrame, label: str) -> tuple[DataFrame, str, tuple]:
    spark = edges.sparkSession
    folder = scratch_folder(spark, label)
    edges.write.parquet(folder)
    back = spark.read.schema("u long, v long").parquet(folder)
    # order-free digest of the edge set: number of edges and sum of their hashes
    mark = back.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return back, folder, tuple(mark)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest node reachable from each node that has an edge.

    ``edges`` has columns ``u`` and ``v`` (long). Large-star and small-star rounds, each a minimum per node
    and a join back, repeat until the edges are stars around the smallest nodes. Every round is a table in
    the shared folder, so a lost executor costs at most one round. A hub with very many neighbours is
    combined before its shuffle by the minimum, and the join is left to the adaptive skew split.

    Returns ``node, component``; self loops and repeated edges change nothing, no edge gives no row.
    """
    spark = edges.sparkSession
    edges = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges, folder, mark = _written(edges, label)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        # a node without a smaller neighbour is its own minimum
        large = (
            both.where("v > u")
            .join(low, "u", "left")
            .select(F.col("v").alias("u"), F.coalesce("low", "u").alias("v"))
        )
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("low").alias("v")).unionByName(
            joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        before, last = mark, folder
        edges, folder, mark = _written(small.where("u <> v").distinct(), label)
        drop_folder(spark, last)
        if mark == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
