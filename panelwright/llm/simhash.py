"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within three bits meet at a variant one flip away from one and at most two flips away from
the other. So every fingerprint emits the variants within half the radius:

* itself and its 64 single flips;
* double flips, by fingerprints with an odd number of set bits only: two fingerprints three bits apart differ
  in parity, so the odd one takes the two flips and the even one the single flip. Of three differing bits two
  lie in the same half of the word, so the 992 double flips within one half suffice.

Variants are shuffled and equal variants collide. Whoever is within one flip of a variant is within three
bits of all others there, so a star around it, each pair verified by its bit count, keeps all links in
at most as many edges as members. Fingerprints are made distinct first; a variant can then be met by no more
than the 1057 fingerprints of its own ball, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import components, map_rows, stored
from panelwright.llm.words import mix

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Variants that meet in one group of the shuffle, about.
BUCKET_KEYS = 1 << 17
#: Fingerprints whose variants a task holds at a time.
FP_BATCH = 4096


def fingerprint(text: str | None) -> bytes:
    """Eight bytes, most significant first; zero for a text without words.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles are three words joined by
    spaces (all words if fewer) and count as often as they occur. A bit is set if it is set in over half of the
    shingles' XXH64 values.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    hashed = xxhash.xxh64_digest
    digests = [
        hashed(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    ]
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(digests)).tobytes()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long. Null text counts as empty."""

    def work(batch: pa.RecordBatch) -> dict:
        made = b"".join(fingerprint(t) for t in batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(np.frombuffer(made, ">i8").astype(np.int64))}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, fp long")


def _flips() -> np.ndarray:
    one = [1 << i for i in range(64)]
    two = [one[i] | one[j] for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
    return np.array([0, *one, *two], np.uint64)


FLIPS = _flips()
#: The variants that every fingerprint emits come first: itself and the single flips.
NEAR = 65


def links(fps: DataFrame) -> DataFrame:
    """Edges ``u, v`` that join all fingerprints within three bits; ``fps`` has distinct values ``fp``."""
    n = fps.count()
    buckets = max(1, -(-n * (NEAR + len(FLIPS)) // 2 // BUCKET_KEYS))
    schema = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp in (b.slice(i, FP_BATCH).column("fp") for b in batches for i in range(0, b.num_rows, FP_BATCH)):
            fp = fp.to_numpy().astype(np.uint64)
            odd = fp[np.bitwise_count(fp) % 2 == 1]
            keys = np.concatenate(
                [(FLIPS[:NEAR, None] ^ fp).ravel(), (FLIPS[NEAR:, None] ^ odd).ravel()]
            )
            flip = np.concatenate(
                [np.repeat(np.arange(NEAR), len(fp)), np.repeat(np.arange(NEAR, len(FLIPS)), len(odd))]
            )
            bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # keeps the flips in order within a bucket
            keys, flip, bucket = keys[order], flip[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
            rows = [
                (
                    int(bucket[a]),
                    keys[a:b].tobytes(),
                    np.bincount(flip[a:b], minlength=len(FLIPS)).astype(np.uint32).tobytes(),
                )
                for a, b in zip(cuts, cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def collide(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()])
        flip = np.concatenate(
            [np.repeat(np.arange(len(FLIPS)), np.frombuffer(b, np.uint32)) for b in table.column("counts").to_pylist()]
        )
        order = np.argsort(keys)
        keys, flip = keys[order], flip[order]
        new = np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0
        run = np.cumsum(new) - 1
        several = np.bincount(run)[run] > 1
        keys, flip, run = keys[several], flip[several], run[several]
        fp = keys ^ FLIPS[flip]
        # the centre of a run: a member within one flip of the variant, the smallest of them
        centre = np.full(int(run[-1]) + 1 if len(run) else 0, np.uint64(2**64 - 1))
        near = flip < NEAR
        np.minimum.at(centre, run[near], fp[near])
        has = np.zeros(len(centre), np.bool_)
        has[run[near]] = True
        other = centre[run]
        good = has[run] & (fp != other) & (np.bitwise_count(fp ^ other) <= RADIUS)
        pairs = np.unique(np.stack([fp[good].view(np.int64), other[good].view(np.int64)], axis=1), axis=0)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    met = fps.select("fp").mapInArrow(emit, "bucket long, keys binary, counts binary")
    return met.groupBy("bucket").applyInArrow(collide, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    ``component_id`` is the smallest ``doc_id`` reachable over links of three or fewer differing bits.
    Null and empty texts have fingerprint zero and are linked like any other; repeated rows stay repeated;
    an empty table gives no rows; other columns are ignored.
    """
    marked = stored(fingerprints(docs), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_classes")
    joined = components(links(classes), "simhash_links").withColumnRenamed("node", "fp")
    # fingerprints without a link stand alone
    rooted = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    # the roots are few; written, so that both sides of the join on a hot fingerprint can be split
    roots = stored(rooted.join(least, "component").select("fp", "component_id"), "simhash_roots")
    return marked.join(roots, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the smallest ``doc_id`` of their component; columns stay."""
    found = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    gone = stored(found, "simhash_gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
