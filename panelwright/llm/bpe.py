"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The tokenizer file says what is merged; nothing is trained. A document is split at white space; the pieces that a
task has not met yet are normalised, cut into pre-tokens and encoded together: the symbols of many pre-tokens lie in
rows of one array, and a segment tree over each row keeps the merge ranks of adjacent pairs. The root is the leftmost
lowest rank; a merge updates the ranks of the pair itself and its two neighbours on their paths to the root, until
no root holds a mergeable pair.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import map_rows

_NONE = np.int64(1 << 62)
#: Bytes from which a pre-token has a tree of its own.
LONG = 512
#: Tree cells that are worked on together.
CELLS = 4_000_000
#: Distinct pieces of text that a Python task remembers.
CACHE = 200_000


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids and token strings for a byte-level BPE file with an end-of-word suffix, NFC and lower case."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.number = {i: str(i) for i in self.token}
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[alphabet[b] + suffix] for b in range(256)], np.int64)
        left, right, made = [], [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        pairs = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.rank_of, self.made = pairs[order], order, np.array(made, np.int64)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern)
        names = "|".join(map(regex.escape, self.special))
        self.outside = regex.compile(f"({names})") if names else None
        # ids of the chunks met so far: flat[begin[k] : begin[k + 1]] for the k-th
        self.cache: dict[str, int] = {}
        self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # the same for the pre-tokens of the chunks
        self.pieces: dict[str, int] = {}
        self.piece_flat, self.piece_begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # texts that plain white space alone doesn't cut into chunks
        self.odd = "|".join(["[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", *map(regex.escape, self.special)])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; _NONE if it can't be merged or either side is missing."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        good = (left >= 0) & (right >= 0) & (self.pairs[at] == key)
        return np.where(good, self.rank_of[at], _NONE)

    def encode_long(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by its own tree: the root holds rank * size + position of the next merge."""
        n = len(piece)
        ids = self.inner[np.frombuffer(piece, np.uint8)].tolist()
        ids[-1] = int(self.last[piece[-1]])
        size = 1 << (n - 1).bit_length()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        never = int(_NONE)
        leaves = [r * size + i if r < never else never for i, r in enumerate(rank)]
        tree = [never] * size + leaves + [never] * (size - len(leaves))
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        known: dict[tuple[int, int], int] = {}

        def put(at: int, left: int, right: int) -> None:
            value = never
            if left >= 0 and right >= 0:
                r = known.get((left, right))
                if r is None:
                    r = known[left, right] = int(self.ranks(np.array([left]), np.array([right]))[0])
                value = r * size + at if r < never else never
            node = at + size
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break  # nothing changes further up
                tree[node] = least

        while tree[1] < never:
            rank_, at = divmod(tree[1], size)
            gone = after[at]
            ids[at], ids[gone] = int(self.made[rank_]), -1
            follow = after[at] = after[gone]
            if follow < n:
                before[follow] = at
            put(at, ids[at], ids[follow] if follow < n else -1)
            put(gone, -1, -1)
            if before[at] >= 0:
                put(before[at], ids[before[at]], ids[at])
        return [i for i in ids if i >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, given as their bytes, one after the other, and the number of ids of each."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        size = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64))
        count = np.zeros(len(pieces), np.int64)
        parts = []
        for own in np.unique(size).tolist():
            members = np.flatnonzero(size == own)
            if own >= LONG:  # few and long: a tree each
                for i in members.tolist():
                    ids = np.array(self.encode_long(pieces[i]), np.uint32)
                    count[i] = len(ids)
                    parts.append((np.array([i]), ids))
                continue
            step = max(1, CELLS // own)
            for at in range(0, len(members), step):
                some = members[at : at + step]
                ids, rows = self._encode_rows([pieces[i] for i in some.tolist()], length[some], own)
                count[some] = rows
                parts.append((some, ids))
        begin = np.concatenate([[0], np.cumsum(count)])
        flat = np.zeros(begin[-1], np.uint32)
        for some, ids in parts:
            flat[_ranges(begin[some], count[some])] = ids
        return flat, count

    def _encode_rows(self, pieces: list[bytes], length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(pieces)
        raw = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(n, size)
        ids = self.inner[raw]
        ids[np.arange(n), length - 1] = self.last[raw[np.arange(n), length - 1]]
        ids[np.arange(size) >= length[:, None]] = -1
        # neighbours of each live symbol in its row; size: none
        after = np.broadcast_to(np.arange(1, size + 1), (n, size)).copy()
        before = np.broadcast_to(np.arange(-1, size - 1), (n, size)).copy()
        # leaves hold rank * size + position, so that the least is the leftmost of the lowest rank
        tree = np.full((n, 2 * size), _NONE, np.int64)
        rank = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, size - 1)
        tree[:, size : 2 * size - 1] = np.where(rank < _NONE, rank * size + np.arange(size - 1), _NONE)
        node = size // 2
        while node:
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
            node //= 2
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = tree[live, 1]
            at, rank = root % size, root // size
            gone = after[live, at]
            ids[live, at] = self.made[rank]
            ids[live, gone] = -1
            follow = after[live, gone]
            after[live, at] = follow
            inside = follow < size
            before[live[inside], follow[inside]] = at[inside]
            lead = before[live, at]
            here = ids[live, at]
            there = np.where(inside, ids[live, np.minimum(follow, size - 1)], -1)
            ahead = np.where(lead >= 0, ids[live, np.maximum(lead, 0)], -1)
            self._update(tree, live, size, at, self.ranks(here, there))
            self._update(tree, live, size, gone, np.full(len(live), _NONE))
            has = lead >= 0
            self._update(tree, live[has], size, lead[has], self.ranks(ahead, here)[has])
            live = live[tree[live, 1] < _NONE]
        there = ids >= 0
        return ids[there], there.sum(axis=1)

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, size: int, at: np.ndarray, rank: np.ndarray) -> None:
        """Set one leaf in each row and renew the minima on its path to the root."""
        node = at + size
        tree[rows, node] = np.where(rank < _NONE, rank * size + at, _NONE)
        while size > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            size >>= 1

    def chunks(self, text: str) -> list[str]:
        """The text cut at white space and around special tokens, which no pre-token crosses."""
        if self.outside is not None and any(s in text for s in self.special):
            parts = self.outside.split(text)
            return [c for p in parts for c in ([p] if p in self.special else self._blank(p))]
        return self._blank(text)

    @staticmethod
    def _blank(text: str) -> list[str]:
        # str.split() also cuts at the four separators 1C-1F, which are no white space to the pattern
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in regex.split(r"\s+", text) if c]
        return text.split()

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the distinct chunks that are not in the cache."""
        if len(self.cache) > CACHE:
            self.cache.clear()
            self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
            self.pieces.clear()
            self.piece_flat, self.piece_begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        known = self.cache
        new = [c for c in chunks if c not in known]
        if not new:
            return
        pieces = self.pieces
        before = len(pieces)
        number = pieces.setdefault
        cut: list[int] = []
        counts: list[int] = []
        for c in new:
            if c in self.special:
                cut.append(-1 - self.special[c])
                counts.append(1)
                continue
            # lower case goes by single characters, so a capital sigma has one form everywhere
            plain = c.lower() if c.isascii() else unicodedata.normalize("NFC", c).replace("Σ", "σ").lower()
            if plain.isalpha():
                cut.append(number(plain, len(pieces)))
                counts.append(1)
            else:
                found = [number(p, len(pieces)) for p in self.split.findall(plain)]
                cut += found
                counts.append(len(found))
        ids, count = self.encode_pieces([p.encode() for p in islice(pieces, before, None)])
        self.piece_begin = np.concatenate([self.piece_begin, self.piece_begin[-1] + np.cumsum(count)])
        self.piece_flat = np.concatenate([self.piece_flat, ids])
        # the special tokens follow the pieces
        special = sorted(self.special.values())
        ids = np.concatenate([self.piece_flat, np.array(special, np.uint32)])
        begin = np.concatenate([self.piece_begin, self.piece_begin[-1] + 1 + np.arange(len(special))])
        count = np.diff(begin)
        which = np.array(cut, np.int64)
        named = which < 0
        which[named] = len(pieces) + np.searchsorted(special, -1 - which[named])
        flat = ids[_ranges(begin[which], count[which])]
        per_chunk = np.add.reduceat(np.append(count[which], 0), np.cumsum([0, *counts[:-1]]))
        per_chunk[np.array(counts) == 0] = 0
        first = len(self.cache)
        self.cache.update(zip(new, range(first, first + len(new))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(per_chunk)])
        self.flat = np.concatenate([self.flat, flat])

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, special ones included: the file has no decoder."""
        return " ".join(map(self.token.__getitem__, ids))

    def batch(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """Ids of each text. Each distinct chunk of the texts is looked up once."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        column = column.fill_null("")
        odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False).astype(np.bool_)
        words = pc.ascii_split_whitespace(column.filter(pa.array(~odd)))
        sizes = np.zeros(len(column), np.int64)
        sizes[~odd] = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        words = words.flatten()
        if odd.any():
            split = [self.chunks(t) for t in column.filter(pa.array(odd)).to_pylist()]
            sizes[odd] = [len(x) for x in split]
            words = pa.concat_arrays([words, pa.array([c for x in split for c in x], pa.large_string())])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(distinct)
        number = np.fromiter(map(self.cache.__getitem__, distinct), np.int64, len(distinct))
        at = number[coded.indices.to_numpy(zero_copy_only=False)]
        count = np.diff(self.begin)[at]
        ids = self.flat[_ranges(self.begin[at], count)]
        # plain texts come first, then the odd ones
        order = np.argsort(odd, kind="stable")
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(sizes[order])]
        parts = np.split(ids, ends[:-1])
        out = [parts[0]] * len(parts)
        for i, part in zip(order.tolist(), parts):
            out[i] = part
        return out[: len(column)]


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for count[0] numbers, then the same from begin[1] on, and so on."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - ends + count, count)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder and cache per Python worker."""
    return Encoder(path)


def encode_ids(path: str, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
    """Ids of each text as unsigned 32-bit arrays."""
    return encoder(path).batch(texts)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` of every document: whole texts, no special tokens added, special strings inside a text
    encoded as the tokens they name. Null text is empty and has no ids; repeated rows stay; an empty table gives no
    rows; other columns are ignored."""

    def work(batch: pa.RecordBatch) -> dict:
        ids = encode_ids(path, batch.column("text"))
        return {
            "doc_id": batch.column("doc_id"),
            "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
            "decoded": [encoder(path).decode(x.tolist()) for x in ids],
        }

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encode`` gives, as digests made where the ids are."""

    def work(batch: pa.RecordBatch) -> dict:
        own = encoder(path)
        n, ids, decoded = [], [], []
        for found in own.batch(batch.column("text")):
            listed = found.tolist()
            n.append(len(listed))
            ids.append(hashlib.sha256(" ".join(map(own.number.__getitem__, listed)).encode()).hexdigest())
            decoded.append(hashlib.sha256(own.decode(listed).encode()).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)
