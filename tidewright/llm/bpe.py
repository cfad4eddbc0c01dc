"""Exact byte-level BPE encoding of whole corpora with the files of a public tokenizer.

The pairs of adjacent pieces of a word are the leaves of a segment tree that stores the leftmost minimum of their merge ranks. The root
names the next merge; a merge updates the leaves of the merged piece and of its live neighbours, each by a logarithmic walk to the root. Words of
one size class are merged together, a column of the arrays each; long words one by one. Words and segments that came before are looked up,
in caches of bounded size."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from tidewright.session import ship, spread

TOKENIZERS = "/opt/tokenizers"  # where the driver finds the tokenizer files; a parameter of all operators
#: The pattern that splits text before the merges (fixed value of the tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for ASCII text.
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
NONE = 1 << 62  # above any leaf, of words of any length
LONG = 512  # bytes from which a word is merged alone
CACHED = 1_500_000  # characters of text that a worker's segment cache, or word cache, may hold before it is emptied


class Merges:
    """Pairs of token ids to rank and merged id, as one sorted array."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], model["merges"]
        shown = _shown_bytes()
        self.byte_ids = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.by_pair = {int(k): i for i, k in enumerate(keys)}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; -1 where they don't merge (or one of them is -1)."""
        keys = left << 20 | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def _shown_bytes() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it prints, else the next free one from U+0100."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {b: chr(b) for b in prints}, 256
    for b in range(256):
        if b not in out:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


def merge_long(word: bytes, m: Merges) -> list[int]:
    """One word, with a segment tree of its own."""
    n = len(word)
    size = 1 << max(1, (n - 1).bit_length())
    token = m.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
    ranks = m.rank(np.array(token[:-1], np.int64), np.array(token[1:], np.int64))
    leaves = np.full(size, NONE, np.int64)
    leaves[: n - 1] = np.where(ranks >= 0, ranks * size + np.arange(n - 1), NONE)
    levels = [leaves]
    while len(levels[0]) > 1:
        levels.insert(0, np.minimum(levels[0][::2], levels[0][1::2]))
    tree = [NONE, *np.concatenate(levels).tolist()]
    by_pair, merged = m.by_pair, m.merged.tolist()

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            value = a if a < b else b
            if tree[i] == value:
                return
            tree[i] = value

    while tree[1] < NONE:
        rank, i = divmod(tree[1], size)
        j = nxt[i]
        token[i] = merged[rank]
        nxt[i] = k = nxt[j]
        put(j, NONE)
        if k >= 0:
            prv[k] = i
            r = by_pair.get(token[i] << 20 | token[k], -1)
            put(i, NONE if r < 0 else r * size + i)
        else:
            put(i, NONE)
        p = prv[i]
        if p >= 0:
            r = by_pair.get(token[p] << 20 | token[i], -1)
            put(p, NONE if r < 0 else r * size + p)
    out, i = [], 0
    while i >= 0:
        out.append(token[i])
        i = nxt[i]
    return out


def merge_many(words: list[bytes], size: int, m: Merges) -> list[list[int]]:
    """Words of at most `size` (a power of two) bytes, merged together: row w of each array belongs to words[w]."""
    count = len(words)
    lengths = np.fromiter(map(len, words), np.int64, count)
    raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(count, size)
    place = np.arange(size)
    inside = place < lengths[:, None]
    token = np.where(inside, m.byte_ids[raw], -1)
    nxt = np.where(place + 1 < lengths[:, None], place + 1, -1)
    prv = np.broadcast_to(place - 1, (count, size)).copy()
    ranks = np.full((count, size), -1, np.int64)
    ranks[:, :-1] = m.rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(count, size - 1)
    tree = np.full((count, 2 * size), NONE, np.int64)
    tree[:, size:] = np.where(ranks >= 0, ranks * size + place, NONE)
    for level in range(size.bit_length() - 2, -1, -1):
        a = 1 << level
        tree[:, a : 2 * a] = np.minimum(tree[:, 2 * a : 4 * a : 2], tree[:, 2 * a + 1 : 4 * a : 2])
    flat, tok, nx, pv = tree.ravel(), token.ravel(), nxt.ravel(), prv.ravel()
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        rank, i = np.divmod(flat[rows * 2 * size + 1], size)
        base, root = rows * size, rows * 2 * size
        j = nx[base + i]
        tok[base + i] = m.merged[rank]
        k = nx[base + j]
        nx[base + i] = k
        ahead = k >= 0
        pv[(base + k)[ahead]] = i[ahead]
        tok[base + j] = -2  # no longer a piece
        p = pv[base + i]
        behind = p >= 0
        r = m.rank(tok[base + i], np.where(ahead, tok[base + np.maximum(k, 0)], -1))
        q = m.rank(np.where(behind, tok[base + np.maximum(p, 0)], -1), tok[base + i])
        flat[root + size + j] = NONE
        flat[root + size + i] = np.where(r >= 0, r * size + i, NONE)
        flat[(root + size + p)[behind]] = np.where(q >= 0, q * size + p, NONE)[behind]
        root3 = np.concatenate([root, root, root[behind]])
        node = np.concatenate([i, j, p[behind]]) + size
        for _ in range(size.bit_length() - 1):
            node >>= 1
            at = root3 + 2 * node
            flat[root3 + node] = np.minimum(flat[at], flat[at + 1])
        rows = rows[flat[root + 1] < NONE]
    ids = token[token >= 0].tolist()
    ends = np.cumsum((token >= 0).sum(1)).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Encodes texts; one per Python worker and tokenizer (see encoder())."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.split, self.split_ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        # A segment ends before white space that follows something else, where no word of the pattern crosses. Text with white space
        # beyond blank, tab and line ends is split by the pattern as a whole.
        self.segment = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
        self.exotic = re.compile("[\x0b\x0c\x1c-\x1f\x85   -     　]")
        self.words: dict[str, bytes] = {}
        self.segments: dict[str, bytes] = {}
        self.held = [0, 0]

    def _learn_words(self, new: Iterable[str]) -> None:
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for w in new:
            b = w.encode("utf-8", "replace")
            if len(b) == 1:
                self.words[w] = _packed([int(self.merges.byte_ids[b[0]])])
            elif len(b) > LONG:
                self.words[w] = _packed(merge_long(b, self.merges))
            else:
                classes.setdefault(1 << (len(b) - 1).bit_length(), []).append((w, b))
        for size, members in classes.items():
            step = max(1, 400_000 // size)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for (w, _), ids in zip(part, merge_many([b for _, b in part], size, self.merges)):
                    self.words[w] = _packed(ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text, as packed 32-bit integers (see unpacked); none for an empty or null text. Special tokens' names are
        ordinary text."""
        if self.held[0] > CACHED:
            self.segments.clear()
            self.held[0] = 0
        if self.held[1] > CACHED:
            self.words.clear()
            self.held[1] = 0
        known, findall, exotic = self.segments, self.segment.findall, self.exotic.search
        split = [[] if not t else [t] if exotic(t) else findall(t) for t in texts]
        fresh = set().union(*split) - known.keys()
        if fresh:
            pieces = [(s, (self.split_ascii if s.isascii() else self.split).findall(s)) for s in fresh]
            new = set().union(*[p for _, p in pieces]) - self.words.keys()
            self._learn_words(new)
            word = self.words.__getitem__
            for s, p in pieces:
                known[s] = b"".join(map(word, p))
            self.held[0] += sum(map(len, fresh))
            self.held[1] += sum(map(len, new))
        look = known.__getitem__
        return [b"".join(map(look, s)) for s in split]


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.int32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _encoders[path]


_shipped: set[tuple[str, str]] = set()


def shipped(spark: SparkSession, path: str) -> str:
    """path, whose file is sent to executors that lack it, once per application."""
    at = (spark.sparkContext.applicationId, path)
    if at not in _shipped:
        spark.sparkContext.addFile(path)
        _shipped.add(at)
    return path


BATCH = 1_000_000  # characters encoded at a time


def vocabulary(path: str) -> int:
    """One more than the greatest id."""
    with open(path, encoding="utf-8") as f:
        return max(json.load(f)["model"]["vocab"].values()) + 1


def batches_of(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= BATCH:
            yield at, texts[at : i + 1]
            at, chars = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def encode_column(df: DataFrame, key: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """key and ids (array of int) of each row, by the tokenizer of that name in folder, without special tokens.

    Empty and null texts give an empty list. Texts are encoded whole, however long. Rows keep their number and partition; repeated rows
    give theirs each time, other columns are ignored."""
    ship(df.sparkSession)
    path = shipped(df.sparkSession, f"{folder}/{tokenizer}.json")
    kind = df.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in parts:
            texts = b.column(1).to_pylist()
            for at, some in batches_of(texts):
                ids = e.encode(some)
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
                values = unpacked(b"".join(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(some)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["key", "ids"])

    out = spread(df.select(df[key].alias("key"), df[text].cast("string").alias("text"))).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)
