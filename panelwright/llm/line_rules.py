"""Quality rules from line frequencies across documents, with DataFrame functions only.

Base rules look at one document's words. The method looks across documents: normalised lines are hashed, every
document counts once for each of its lines, and a line found in more than ``max_docs`` documents of one host is
boilerplate. Boilerplate is removed, and a document that loses most of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import stored

MIN_WORDS = 50
#: A document fails if more than this share of its words, in percent, lies in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
#: Documents of one host that may hold a line. Copies of whole documents are the matter of near-dedup, so the limit is
#: set where only template lines lie.
MAX_DOCS = 100
#: Share of its words that a document may lose with its boilerplate lines.
MAX_LOST = 0.5
#: Boilerplate lines that are sent to all tasks; beyond, they are joined by a shuffle.
BROADCAST_LINES = 500_000
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK = r"[\x20\x09-\x0D]+"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda variable is bound, not repeated."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    plain = F.btrim(text, F.lit(_BLANKS))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, _BLANK))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that are found twice or more.

    If all windows differ, there are none. Else windows become (hash, position) pairs; sorted, equal windows are
    neighbours. Each repeated window then covers three words, less the overlap with the next repeated window.
    """

    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - 2, F.lit(0))
        at = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def repeated(pairs: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False))
        twice = F.filter(pairs, lambda x, i: same(i, i - 1) | same(i, i + 1))
        return F.array_sort(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(p - s["last"], F.lit(3))).alias("n")),
            lambda s: s["n"],
        )

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        counted = _bound(pairs, lambda p: _bound(repeated(p), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(counted)

    return _bound(hashes(words), count)


def _count(text: Column, symbols: str) -> Column:
    n = F.lit(0)
    for s in symbols:
        n = n + F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
    return n.cast("long")


def _rule_columns(docs: DataFrame) -> list[Column]:
    """The base counts and ``base_failed`` of each row, from its text alone."""
    text = F.coalesce(docs["text"], F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    found = F.struct(
        _count(text, SYMBOLS).alias("n_symbols"),
        _bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _bound(_words(text), counts).alias("w"),
    )

    def rules(x: Column) -> Column:
        failed = (x["w"]["n_words"] < MIN_WORDS) | (
            100 * x["w"]["n_repeat_words"] > MAX_REPEAT_PERCENT * x["w"]["n_words"]
        )
        names = ("n_words", "word_chars", "n_repeat_words")
        return F.struct(
            *[x["w"][n].alias(n) for n in names],
            *[x[n].alias(n) for n in ("n_symbols", "n_dup_lines")],
            failed.alias("base_failed"),
        )

    return [_bound(found, rules).alias("_rules")]


def base_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and ``base_failed`` of each row; null text has no words."""
    return docs.select("doc_id", *_rule_columns(docs)).select("doc_id", "_rules.*")


def _fold(raw: Column) -> Column:
    """A line in lower case, with digits as 0 and blanks folded."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(raw), "[0-9]", "0"), _BLANK, " "))


def document_lines(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id, body, host, line, words`` of every line with a word: a hash of the whole text, a hash of the
    normalised line, and its words."""
    split = docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("body"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("raw"),
    ).where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
    return split.select(
        "doc_id",
        "body",
        "host",
        F.xxhash64(_fold(F.col("raw"))).alias("line"),
        F.size(_words(F.col("raw"))).cast("long").alias("words"),
    )


def boilerplate(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """``host, line, n_docs`` of the lines that more than ``max_docs`` documents of a host have.

    A line that one document repeats counts once, and exact copies of a document count as one: a much copied document
    is not boilerplate. A host or line with very many rows is combined before each shuffle.
    """
    once = document_lines(docs, host).groupBy("host", "line", "body").agg(F.lit(1).alias("one"))
    return once.groupBy("host", "line").agg(F.count("one").alias("n_docs")).where(F.col("n_docs") > max_docs)


def _lost(docs: DataFrame, host: str, max_docs: int) -> DataFrame:
    """``_id, lost_words, lost_lines`` of the documents with boilerplate lines."""
    frequent = stored(boilerplate(docs, host, max_docs), "boilerplate")
    lines = document_lines(docs, host)
    if frequent.count() <= BROADCAST_LINES:
        marked = lines.join(F.broadcast(frequent), ["host", "line"])
    else:
        marked = lines.join(frequent.hint("merge"), ["host", "line"])
    # a document's lines lie in one task, so nearly all of this is combined before the shuffle
    lost = marked.groupBy(F.col("doc_id").alias("_id")).agg(
        F.sum("words").alias("lost_words"), F.collect_set("line").alias("lost_lines")
    )
    return stored(lost, "lost_lines")


def _small(lost: DataFrame) -> bool:
    """Whether all lost lines together may be sent to all tasks."""
    return (lost.agg(F.sum(F.size("lost_lines"))).first()[0] or 0) <= BROADCAST_LINES


def _kept(max_lost: float) -> Column:
    return ~F.col("base_failed") & (F.col("lost_words") <= max_lost * F.col("n_words"))


def judge(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts, ``base_failed``, ``lost_words`` (words in boilerplate
    lines) and ``kept``.

    ``kept`` is false if a base rule fails or more than ``max_lost`` of the words are lost. Null and empty texts fail
    the base rules; a null host is a host of its own; rows that share a ``doc_id`` share their ``lost_words``; an empty
    table gives no rows; other columns are ignored.
    """
    lost = _lost(docs, host, max_docs).select(F.col("_id").alias("doc_id"), "lost_words")
    rules = base_rules(docs).join(lost, "doc_id", "left").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)))
    return rules.withColumn("kept", _kept(max_lost))


def clean(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that ``judge`` keeps, without their boilerplate lines; the columns stay, and ``n_chars`` of changed
    texts, if there is such a column, is counted anew."""
    lost = _lost(docs, host, max_docs)
    lost = F.broadcast(lost) if _small(lost) else lost.hint("merge")
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *_rule_columns(docs))
    joined = inner.join(lost, F.col("_row.doc_id") == F.col("_id"), "left").withColumn(
        "lost_words", F.coalesce("lost_words", F.lit(0))
    )
    kept = joined.withColumns({n: F.col("_rules")[n] for n in ("n_words", "base_failed")}).where(_kept(max_lost))
    text = F.col("_row.text")
    left = F.array_join(
        F.filter(
            F.split(text, "\n"),
            lambda raw: ~(
                raw.rlike(r"[^\x20\x09-\x0D]") & F.array_contains(F.col("lost_lines"), F.xxhash64(_fold(raw)))
            ),
        ),
        "\n",
    )
    changed = F.col("lost_lines").isNotNull()
    out = kept.select("_row", changed.alias("_changed"), F.when(changed, left).otherwise(text).alias("_text"))
    columns = {c: F.col("_row").getField(c) for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        count = F.when(F.col("_changed"), F.length("_text")).otherwise(F.col("_row.n_chars"))
        columns["n_chars"] = count.cast(docs.schema["n_chars"].dataType)
    return out.select(*[v.alias(k) for k, v in columns.items()])
