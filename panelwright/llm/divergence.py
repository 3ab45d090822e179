"""Divergence of sources by their terms, with late string materialization.

1. Each task counts its texts' terms and writes a row per (language, source, term): fixed-width digests, counts, and the
   term itself. Only digests and counts are shuffled to add up the counts.
2. The terms of the digests that a language keeps are shuffled once to their minimum and maximum per digest. If they differ,
   several terms share the digest: its terms are split, counted by text and numbered within the digest.
3. Probabilities and divergences are exact integers. A pair of sources needs joint sums only over terms that both have; what
   the other terms add follows from how many terms a source has with each count.
4. Texts are joined back to the ranked terms only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import stored

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Distinct terms that a task holds before it writes them.
HELD_TERMS = 400_000
#: Bytes of a text that are split into terms at a time.
SLICE_BYTES = 1 << 20
#: Digests that are sent to all tasks; beyond, rows are joined by a shuffle.
BROADCAST_DIGESTS = 500_000
#: Counts of one language that a task compares at a time, about, and cells of its term-by-source tables.
BLOCK_ROWS = 200_000
BLOCK_CELLS = 2_000_000

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_SIGN = 1 << 63
_COUNTED = "lang_key long, group_key long, digest long, n long, docs long, term string"


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size: runs of letters A-Z, lower-cased, and of all characters
    beyond ASCII."""
    data = text.encode().translate(_LETTERS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def digest(term: bytes, bits: int = 64) -> int:
    """The term's hash as a signed integer of ``bits`` bits."""
    return (xxhash.xxh64_intdigest(term) >> (64 - bits)) - (_SIGN if bits == 64 else 0)


def _counted(rows: DataFrame, bits: int) -> DataFrame:
    """Counts of each (language, source, term) of ``lang_key, group_key, text`` rows, a row for each part of a task."""
    names = [c.split()[0] for c in _COUNTED.split(", ")]

    def written(held: dict[tuple[int, int], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, group), (count, docs) in held.items():
            size, found = len(count), list(count)
            columns = [
                pa.array(np.full(size, lang, np.int64)),
                pa.array(np.full(size, group, np.int64)),
                pa.array([digest(t, bits) for t in found], pa.int64()),
                pa.array(list(count.values()), pa.int64()),
                pa.array([docs[t] for t in found], pa.int64()),
                pa.array(found, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            keys = zip(batch.column("lang_key").to_pylist(), batch.column("group_key").to_pylist())
            for key, text in zip(keys, batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                count, docs = held.setdefault(key, (Counter(), Counter()))
                size -= len(count)
                own: set[bytes] = set()
                for part in terms(text):
                    count.update(part)
                    own.update(part)
                docs.update(own)
                size += len(count)
                if size > HELD_TERMS:
                    yield from written(held)
                    held, size = {}, 0
        yield from written(held)

    return rows.mapInArrow(run, _COUNTED)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang_key, group_key, text`` rows, and the ``lang_key, group_key, lang, source`` of every group. Keys are hashes; if two
    groups or languages share one, the next seed is taken."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    rows = docs.select(*blank, "text")
    seed = 0
    while True:
        lang, group = F.xxhash64("lang", F.lit(seed)), F.xxhash64("lang", "source", F.lit(seed))
        keyed = rows.select(lang.alias("lang_key"), group.alias("group_key"), "lang", "source", "text")
        groups = keyed.groupBy("lang_key", "group_key", "lang", "source").agg(F.count(F.lit(1)).alias("rows"))
        groups = stored(groups.drop("rows"), "groups")
        sizes = groups.agg(
            F.count(F.lit(1)).alias("groups"),
            F.countDistinct("group_key").alias("keys"),
            F.countDistinct("lang").alias("langs"),
            F.countDistinct("lang_key").alias("lang_keys"),
        ).first()
        if sizes["groups"] == sizes["keys"] and sizes["langs"] == sizes["lang_keys"]:
            return keyed.select("lang_key", "group_key", "text"), groups
        seed += 1


def _only(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows with one of the given distinct digests."""
    few = digests.count() <= BROADCAST_DIGESTS
    return rows.join(F.broadcast(digests) if few else digests.hint("merge"), "digest", "left_semi")


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy("lang_key", "group_key", *keys).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang_key, group_key, digest, part, n, lang_n`` for the kept terms of each language, and ``digest, part, term``: their texts.
    ``part`` is 0 where one term has the digest, else it numbers the terms that share it."""
    sums = stored(_added(counted, "digest").withColumn("part", F.lit(0)), "digest_counts")
    by_lang = sums.groupBy("lang_key", "digest").agg(F.sum("docs").alias("docs"))
    digests = stored(by_lang.where(F.col("docs") >= MIN_DOCS).select("digest").distinct(), "kept_digests")
    ends = _only(counted.select("digest", "term"), digests).groupBy("digest")
    ends = stored(ends.agg(F.min("term").alias("least"), F.max("term").alias("most")), "term_ends")
    names = ends.where("least = most").select("digest", F.lit(0).alias("part"), F.col("least").alias("term"))
    shared = stored(ends.where("least <> most").select("digest"), "shared_digests")
    if shared.head(1):
        split = stored(_added(_only(counted, shared), "digest", "term"), "split_counts")
        order = Window.partitionBy("digest").orderBy("term")
        numbers = split.select("digest", "term").distinct().withColumn("part", F.row_number().over(order))
        names = names.unionByName(numbers.select("digest", "part", "term"))
        split = split.join(numbers, ["digest", "term"]).drop("term")
        sums = sums.join(shared, "digest", "left_anti").unionByName(split)
    lang = sums.groupBy("lang_key", "digest", "part").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
    lang = lang.where(F.col("lang_docs") >= MIN_DOCS).drop("lang_docs")
    kept = sums.select("lang_key", "group_key", "digest", "part", "n").join(lang, ["lang_key", "digest", "part"])
    return stored(kept, "kept_terms"), names


def _p(n: str, total: str) -> F.Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * v)), exact for any counts."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10, 0)) * (cast({n} as decimal(20, 0)) + 2))"
        f" div (cast({total} as decimal(20, 0)) + 2 * cast(v as decimal(18, 0)))"
    ).cast("long")


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _joint(rows: DataFrame) -> DataFrame:
    """``one, two, joint`` for pairs of sources (``one`` < ``two``) with terms in common: the sum of f(p1, p2) - f(p1, z2) - f(z1, p2) +
    f(z1, z2) over those terms; z is a source's p of an absent term. Terms are dealt to blocks, a table of terms by sources each."""
    parts = max(1, -(-rows.count() // BLOCK_ROWS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("digest", "part"), F.lit(parts)))
    columns = ["lang_key", "block", "group_key", "digest", "part", "p", "z"]

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // (p + q)

    def sums(table: pa.Table) -> pa.Table:
        group, at = np.unique(table.column("group_key").to_numpy(), return_inverse=True)
        code = np.stack([table.column("digest").to_numpy(), table.column("part").to_numpy()], 1)
        term = np.unique(code, axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(term, kind="stable")
        term, at, p = term[order], at[order], table.column("p").to_numpy()[order]
        z = np.zeros(len(group), np.int64)
        z[at] = table.column("z").to_numpy()[order]
        total = np.zeros((len(group), len(group)), np.int64)
        step = max(1, BLOCK_CELLS // len(group))
        for low in range(0, int(term[-1]) + 1, step):
            span = slice(*np.searchsorted(term, [low, low + step]))
            table_p = np.broadcast_to(z, (min(step, int(term[-1]) + 1 - low), len(group))).copy()
            has = np.zeros(table_p.shape, np.bool_)
            table_p[term[span] - low, at[span]] = p[span]
            has[term[span] - low, at[span]] = True
            for one in range(len(group) - 1):
                own = np.flatnonzero(has[:, one])
                mine, others = table_p[own, one][:, None], table_p[own, one + 1 :]
                # a source without the term adds nothing: its p is z there
                total[one, one + 1 :] += (
                    f(mine, others) - f(mine, z[one + 1 :]) - f(z[one], others) + f(z[one], z[one + 1 :])
                ).sum(0)
        one, two = np.triu_indices(len(group), 1)
        return pa.table({"one": group[one], "two": group[two], "joint": total[one, two]})

    found = dealt.select(*columns).groupBy("lang_key", "block").applyInArrow(sums, "one long, two long, joint long")
    return found.groupBy("one", "two").agg(F.sum("joint").alias("joint"))


def audit(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the sources of each language differ, and by which terms.

    Terms are runs of letters A-Z (lower-cased) and of characters beyond ASCII. A language keeps the terms of at least
    MIN_DOCS of its rows. With the N occurrences of kept terms and the number V of them, a term's p in a source or language
    is 1 + floor(SCALE * (count + 2) / (N + 2V)), and f(p, q) = floor((p - q)^2 / (p + q)). Part ``pair`` ranks the other sources
    of the language by the sum of f over all kept terms (0 if there are none); part ``term`` ranks the TOP_TERMS terms that
    are more frequent in the source than in its language, by f. Ties go to the lesser item in UTF-8 order.

    Columns ``text, lang, source``; null is ''. Texts of any length count whole; repeated rows count each. Sources
    without terms are listed too; an empty table gives no rows; other columns are ignored. Terms whose digests of ``bits``
    bits are equal are kept apart. Counts are exact up to 18 digits.
    """
    rows, groups = _keyed(docs)
    kept, names = kept_terms(stored(_counted(rows, bits), "term_counts"))
    lang_terms = kept.select("lang_key", "digest", "part", "lang_n").distinct()
    langs = lang_terms.groupBy("lang_key").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("group_key").agg(F.sum("n").alias("total"))
    # a row per source, also of those without terms
    sizes = groups.select("lang_key", "group_key").join(langs, "lang_key", "left").join(totals, "group_key", "left")
    sizes = sizes.fillna(0, ["v", "lang_total", "total"])
    sizes = stored(sizes.withColumn("z", F.when(F.col("v") > 0, _p("0", "total"))), "sources")
    # distinct counts of a source are few; p and z follow from them
    counts = kept.join(sizes.drop("lang_key"), "group_key")
    placed = counts.withColumn("p", _p("n", "total")).select(
        "lang_key", "group_key", "digest", "part", "p", "z", _p("lang_n", "lang_total").alias("q")
    )
    placed = stored(placed, "probabilities")

    one, two = (
        sizes.select("lang_key", "v", F.col("group_key").alias(n), F.col("z").alias(f"z_{n}")) for n in ("one", "two")
    )
    pairs = one.join(two.drop("v"), "lang_key").where("one <> two")
    # terms that a source has, against those that the other has not, by distinct p
    alone = placed.groupBy("lang_key", F.col("group_key").alias("one"), F.col("p").alias("p_one")).count()
    alone = alone.join(pairs.drop("v"), ["lang_key", "one"]).groupBy("one", "two")
    alone = alone.agg(F.sum(F.expr(f"count * ({_f('p_one', 'z_two')} - {_f('z_one', 'z_two')})")).alias("alone"))
    back = alone.select(F.col("two").alias("one"), F.col("one").alias("two"), F.col("alone").alias("back"))
    joint = _joint(placed.select("lang_key", "group_key", "digest", "part", "p", "z"))
    joint = joint.unionByName(joint.select(F.col("two").alias("one"), F.col("one").alias("two"), "joint"))
    value = F.expr(f"case when v = 0 then 0 else v * ({_f('z_one', 'z_two')}) end")
    value = value + sum(F.coalesce(F.col(c), F.lit(0)) for c in ("alone", "back", "joint"))
    key = ["one", "two"]
    pairs = pairs.join(alone, key, "left").join(back, key, "left").join(joint, key, "left")
    pairs = pairs.select(F.col("one").alias("group_key"), "two", value.cast("long").alias("value"))
    items = groups.select(F.col("group_key").alias("two"), F.col("source").alias("item"))
    pairs = pairs.join(items, "two").select("group_key", F.lit("pair").alias("part"), "item", "value")

    over = placed.where("p > q").select("group_key", "digest", F.col("part").alias("split"), F.expr(_f("p", "q")).alias("value"))
    best = Window.partitionBy("group_key").orderBy(F.desc("value"))
    over = over.withColumn("place", F.rank().over(best)).where(F.col("place") <= TOP_TERMS).drop("place")
    found = over.join(names.withColumnRenamed("part", "split"), ["digest", "split"])
    found = found.select("group_key", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("group_key").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    ranked = pairs.unionByName(found).join(groups.select("group_key", "lang", "source"), "group_key")
    return ranked.select("lang", "source", "part", "item", "value", "rank")
