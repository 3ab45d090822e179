"""Personal data by patterns and a skip-chain conditional random field.

Patterns find what is written in full. A token with a digit or an @ is a node of the field: it has a unary potential from
its shape and neighbours, a chain potential with the next token, and a skip potential with one token of the document for all
that repeat or resemble it: the first observed one, else the first. Tokens inside a pattern's span are observed. Loopy message passing carries these
labels along the chain and the skip edges, so a phone number that is written in full once is found again where only
its local part stands. All other tokens are no nodes: their label is certain.

The potentials are trained on a bounded sample of documents, with the patterns' spans as labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import map_rows, rewrite_texts, stored

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: nothing
#: Documents, least by hash of doc_id among those with tokens to label, that the potentials are trained on.
TRAIN_DOCS = 3000
#: Neighbouring tokens of one document that enter the training; where they begin is drawn by hash from the whole document.
TRAIN_TOKENS = 200
BUCKETS = 4096
#: Log potential of the labels that an observed token doesn't have.
OBSERVED = -1e9
FEATURES = 4
#: Messages go on until none moves by more than MOVED; loops that never settle end after ROUNDS.
MOVED = 1e-3
ROUNDS = 1000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the look-behind only spares hopeless starts within a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NODE = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end in code points


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses. What stands before an @ is the longest run of allowed characters, so no
    start within a run has to be tried twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind as listed, then by start. A match that fails its test is dropped."""
    found: list[Span] = [(0, *m) for m in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]  # of any length
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group()) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            found.append((3, *m.span()))
    return found


def _hash(x: str) -> int:
    return zlib.crc32(x.encode())


def _shape(token: str) -> str:
    """Digits as 9, letters as a, in runs of at most five; the rest as it stands."""
    plain = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", token))
    return re.sub(r"9{5,}", "99999", plain)


class Nodes(NamedTuple):
    """Tokens of one document that may be personal data."""

    start: list[int]
    end: list[int]
    index: list[int]  # of the token among all tokens
    label: list[int]  # by the patterns
    features: list[int]  # FEATURES to a node
    same: list[int]  # key that repeats of the token share
    alike: list[int]  # key that similar tokens share, -1: none
    digits: list[int]


def nodes_of(text: str, spans: list[Span]) -> Nodes:
    found = Nodes([], [], [], [], [], [], [], [])
    ordered = sorted((s, e, k + 1) for k, s, e in spans)
    at = 0
    shapes: list[tuple[int, str]] = []
    for index, m in enumerate(_TOKEN.finditer(text)):
        token = m.group()
        if not _NODE.search(token):
            continue
        start, end = m.span()
        while at < len(ordered) and ordered[at][1] <= start:
            at += 1
        label = ordered[at][2] if at < len(ordered) and ordered[at][0] < end else 0
        core = token.strip(".,;:!?\"'()[]{}<>").lower()
        digits = _DIGITS.sub("", core)
        # whether the number passes the patterns' tests sets apart numbers that only look alike
        passes = 13 <= len(digits) <= 19 and luhn(digits)
        shapes.append((index, f"{_shape(token)}\t{len(digits)}\t{passes}"))
        found.start.append(start + len(token) - len(token.lstrip(".,;:!?\"'[]{}<>")))
        found.end.append(max(found.start[-1], start + len(token.rstrip(".,;:!?\"'[]{}<>"))))
        found.index.append(index)
        found.label.append(label)
        found.same.append(_hash(core) if len(core) > 2 else -1)
        # similar tokens: the last seven digits, or the same name before the @
        name = core.partition("@")[0] if "@" in core else ""
        found.alike.append(_hash("d" + digits[-7:]) if len(digits) >= 7 else _hash("n" + name) if len(name) > 2 else -1)
        found.digits.append(len(digits))
    for i, (index, shape) in enumerate(shapes):
        left = shapes[i - 1][1] if i and shapes[i - 1][0] == index - 1 else ""
        right = shapes[i + 1][1] if i + 1 < len(shapes) and shapes[i + 1][0] == index + 1 else ""
        for f in ("s" + shape, "l" + left, "r" + right, "b" + left + "\t" + shape):
            found.features.append(_hash(f) % BUCKETS)
    return found


_NODES = "starts array<int>, ends array<int>, token array<int>, label array<int>, features array<int>, same array<long>, alike array<long>, digits array<int>"
_EMPTY = Nodes([], [], [], [], [], [], [], [])


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash``, the patterns' spans as ``base`` (kind, start, end in turn) and the nodes of every document."""

    def work(batch: pa.RecordBatch) -> dict:
        base, rows = [], []
        for text in batch.column("text").to_pylist():
            if not text or not _NODE.search(text):
                base.append([])
                rows.append(_EMPTY)
                continue
            spans = base_spans(text)
            base.append([x for s in spans for x in s])
            rows.append(nodes_of(text, spans))
        names = [c.split()[0] for c in _NODES.split(", ")]
        ids = {n: batch.column(n) for n in ("doc_id", "text_hash")}
        return ids | {"base": base} | dict(zip(names, map(list, zip(*rows))))

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return map_rows(texts, work, f"doc_id long, text_hash long, base array<int>, {_NODES}")


class Model(NamedTuple):
    unary: np.ndarray  # BUCKETS x LABELS
    chain: np.ndarray  # LABELS x LABELS
    skip: float


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _clear(row: dict) -> np.ndarray:
    """Whether each token is observed or shares no key with an observed token."""
    keys = {k for name in ("same", "alike") for k, own in zip(row[name], row["label"]) if own and k >= 0}
    pairs = zip(row["label"], row["same"], row["alike"])
    return np.array([bool(own) or not (a in keys or b in keys) for own, a, b in pairs], np.bool_)


def train(found: DataFrame, rounds: int = 150) -> Model:
    """Multinomial regression for the unary potentials, log odds of neighbouring labels for the chain, and of equal
    labels on repeated tokens for the skip edges. Without labelled tokens all potentials are flat but for the skip."""
    some = found.where(F.size("label") > 0).withColumn("order", F.xxhash64("doc_id"))
    # the filter before the order bounds what all tasks together send to the driver
    bins = max(1, some.count() // (4 * TRAIN_DOCS))
    spare = F.greatest(F.size("label") - TRAIN_TOKENS, F.lit(0)) + 1
    some = some.where(F.pmod(F.xxhash64("order"), F.lit(bins)) == 0)
    some = some.withColumn("first", F.pmod(F.xxhash64("doc_id", "text_hash"), spare).cast("int"))
    pick = some.select(
        *[F.slice(c, F.col("first") + 1, TRAIN_TOKENS).alias(c) for c in ("label", "token", "same", "alike")],
        F.slice("features", F.col("first") * FEATURES + 1, FEATURES * TRAIN_TOKENS).alias("features"),
        "order",
    )
    rows = pick.orderBy("order", "features").limit(TRAIN_DOCS).collect()
    if not rows:
        return Model(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), 2.0)
    # a token that repeats or resembles an observed one is what the skip edges are to decide: it teaches nothing
    clear = [_clear(r) for r in rows]
    taught = np.concatenate(clear)
    features = np.concatenate([np.array(r["features"]).reshape(-1, FEATURES) for r in rows])[taught]
    label = np.concatenate([np.array(r["label"]) for r in rows])[taught]
    goal = np.eye(LABELS)[label]
    weight = np.zeros((BUCKETS, LABELS))
    for _ in range(rounds):
        error = goal - _softmax(weight[features].sum(axis=1))
        step = np.zeros_like(weight)
        for k in range(features.shape[1]):
            for c in range(LABELS):
                step[:, c] += np.bincount(features[:, k], error[:, c], BUCKETS)
        seen = np.bincount(features.ravel(), minlength=BUCKETS)[:, None] + 1.0
        weight += step / seen - 0.001 * weight
    pairs = np.ones((LABELS, LABELS))
    alike, pairs_seen = 1.0, 2.0
    for r, known in zip(rows, clear):
        last: dict[int, int] = {}
        for i, (key, own) in enumerate(zip(r["same"], r["label"])):
            if not known[i]:
                continue
            if i and known[i - 1] and r["token"][i] == r["token"][i - 1] + 1:
                pairs[r["label"][i - 1], own] += 1
            if key >= 0:
                if key in last:
                    pairs_seen += 1
                    alike += last[key] == own
                last[key] = own
    joint = pairs / pairs.sum()
    chain = np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))
    share = min(0.99, alike / pairs_seen)
    skip = max(2.0, float(np.log(share * (LABELS - 1) / (1 - share))))
    return Model(weight, np.clip(chain, -3, 3), skip)


def _edges(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of all edges of a batch of documents, and whether each is a skip edge. All tokens
    with a key are linked to the first observed one, else to the first, so edges grow with the tokens and not with the
    pairs of repeats, and evidence reaches every repeat in two steps."""
    a, b, skip = [], [], []
    at = 0
    for r in rows:
        token = r["token"]
        middle: dict[tuple[str, int], int] = {}
        for observed in (True, False):
            for i, own in enumerate(r["label"]):
                if bool(own) == observed:
                    for name in ("same", "alike"):
                        middle.setdefault((name, r[name][i]), i)
        for i in range(len(token)):
            if i and token[i] == token[i - 1] + 1:
                a.append(at + i - 1)
                b.append(at + i)
                skip.append(False)
            for name in ("same", "alike"):
                key = (name, r[name][i])
                if key[1] >= 0 and middle[key] != i:
                    a.append(at + middle[key])
                    b.append(at + i)
                    skip.append(True)
        at += len(token)
    return np.array(a, np.int64), np.array(b, np.int64), np.array(skip, np.bool_)


def beliefs(unary: np.ndarray, a: np.ndarray, b: np.ndarray, skip: np.ndarray, model: Model) -> np.ndarray:
    """Marginals by damped sum-product message passing over all edges at once. A message is sent anew as long as it or what
    its sender has received moves."""
    if not len(a):
        return _softmax(unary)
    factor = np.where(skip[:, None, None], model.skip * np.eye(LABELS), model.chain)
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
    half = len(a)
    message = np.zeros((2 * half, LABELS))
    live = np.arange(2 * half)
    stirred = np.zeros(len(unary), np.bool_)
    for _ in range(ROUNDS):
        total = unary.copy()
        np.add.at(total, target, message)
        x = (total[source[live]] - message[(live + half) % (2 * half)])[:, :, None] + factor[live]
        top = x.max(axis=1)
        new = np.log(np.exp(x - top[:, None, :]).sum(axis=1)) + top
        new -= new.max(axis=1, keepdims=True)
        moved = live[np.abs(new - message[live]).max(axis=1) >= MOVED]
        message[live] = (message[live] + new) / 2
        if not len(moved):
            break
        stirred[:] = False
        stirred[target[moved]] = True
        again = stirred[source]
        again[moved] = True
        live = np.flatnonzero(again)
    total = unary.copy()
    np.add.at(total, target, message)
    return _softmax(total)


def _added(row: dict, labels: np.ndarray) -> list[Span]:
    """Runs of neighbouring unobserved tokens with one label, if they hold what the kind needs at least."""
    out: list[Span] = []
    i, n = 0, len(row["token"])
    while i < n:
        j = i + 1
        if labels[i] and not row["label"][i]:
            while j < n and labels[j] == labels[i] and not row["label"][j] and row["token"][j] == row["token"][j - 1] + 1:
                j += 1
            digits = sum(row["digits"][i:j])
            kind = int(labels[i]) - 1
            if digits >= (0, 4, 13, 7)[kind] and (kind or row["alike"][i] >= 0) and row["ends"][j - 1] > row["starts"][i]:
                out.append((kind, row["starts"][i], row["ends"][j - 1]))
        i = j
    return out


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, base, spans`` of every row: the patterns' spans, and these with the field's; each an array of
    ``kind`` (a name of KINDS), ``start``, ``end`` in code points, by kind as listed, then start; ``text_hash`` is Spark's
    xxhash64 of the text.

    Null and empty texts have no spans; texts of any length are read whole, digit runs of any length included; rows are
    handled one by one, so repeated rows and ids don't matter, nor ids that are null; an empty table gives no rows; other
    columns are ignored. Overlapping spans of different kinds all stay.
    """
    found = stored(candidates(docs), "pii_nodes")
    model = train(found)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    span = "array<struct<kind:string,start:int,end:int>>"

    def named(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = part.to_pylist()
                base = [list(zip(*[iter(r["base"])] * 3)) for r in rows]
                live = [r for r in rows if r["token"]]
                extra: dict[int, list[Span]] = {}
                if live:
                    features = np.concatenate([np.array(r["features"]).reshape(-1, FEATURES) for r in live])
                    unary = model.unary[features].sum(axis=1)
                    observed = np.concatenate([np.array(r["label"]) for r in live])
                    unary[observed > 0] = OBSERVED  # many repeats together don't outvote a pattern
                    unary[observed > 0, observed[observed > 0]] = 0.0
                    marginal = beliefs(unary, *_edges(live), model)
                    best = np.where(marginal.max(axis=1) > 0.5, marginal.argmax(axis=1), 0)
                    cuts = np.cumsum([len(r["token"]) for r in live])[:-1]
                    extra = {id(r): _added(r, own) for r, own in zip(live, np.split(best, cuts))}
                spans = [named(b + extra.get(id(r), [])) for r, b in zip(rows, base)]
                ids = [part.column(n) for n in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array([named(b) for b in base], kind), pa.array(spans, kind)],
                    names=["doc_id", "text_hash", "base", "spans"],
                )

    return found.mapInArrow(label, f"doc_id long, text_hash long, base {span}, spans {span}")


def mask(text: str | None, spans: list[dict]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first by start, then
    the longest, gives the kind for all they cover."""
    if not text or not spans:
        return text
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= last:
            out += [text[last : s["start"]], f"<{s['kind'].upper()}>"]
        last = max(last, s["end"])
    return "".join(out) + text[last:]


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with all found spans masked in ``text`` and ``n_chars`` of changed texts, if there is such a column, counted
    anew. All rows stay; null stays null. Each text of a ``doc_id`` is masked by its own spans, also where the
    id is null."""
    spans = find(docs).where(F.size("spans") > 0)
    spans = spans.select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    return rewrite_texts(docs, stored(spans, "pii_spans"), mask)
