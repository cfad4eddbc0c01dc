"""Texts laid into containers of a fixed capacity in tokens, with little room left and lexically related texts together.

Lexical retrieval packing. As many texts as there must be containers are the seeds, all those over half the capacity among them. A sharded inverted index with BM25 weights,
whose statistics are those of the whole corpus, returns for each seed its nearest unused texts that fit. The index lies in cells of related texts; a seed is scored
against all texts of the cells nearest to it, wherever in the corpus they come from. A text that several
seeds want goes to the seed it fits best, and a seed takes texts greedily, best first, while there is room; seeds that still have room are probed
again with the texts that are still unused. What room is left then goes to the texts that fit it most closely, related or not.
A text is split only if it exceeds the capacity by itself: into full containers, and a last piece that is packed as any text.

All of it is distributed: an index shard, and a group of containers that is filled up by size, have bounded numbers of entries; the driver sees
one number per token of the vocabulary, and a sample of sketches, bounded, from which the cells are found. Order is by size, score and a hash of key and text, so the number of cores
doesn't change which texts share a container."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import bpe
from tidewright.session import cut, dropped, ship, spread

POSTINGS = 4_000_000  # entries of an index shard, on average
GROUP = 32_768  # containers that are filled up together
NEAREST = 32  # texts that a probe returns for a seed
CELL = 512  # items of a cell of related ones, on average
VISITS = 8  # cells whose items a seed is scored against, all of them; more if there are more than 256 cells, as the root of their number
FLAT, MOST, SAMPLE = 256, 16_384, 8  # cells that are found at once, without a level above; cells at most; items a cell from which they are found
WIDTH, LONG = 256, 512  # numbers of a sketch, and its length
STEP, TIES = 10_000, (1 << 31) - 1  # steps of a score that count; the bits of a rank below the score
FULL = 0.98  # of all containers' room that should be used
PROBES, ROUNDS = 2, 3  # probes of the index; rounds of matching after each
K1, B = 1.2, 0.75


class Index:
    """One cell: postings by term, of items in order of size, so that the items that fit a room come first in every list. Terms that many of its
    items have are columns of a matrix too."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, idf: np.ndarray, mean: float, ords: np.ndarray | None = None):
        """terms, counts: of all items, flat; lengths: each item's number of terms; sizes ascend; ords: the items' hashes."""
        self.n, self.sizes = len(sizes), sizes
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        owner = np.repeat(np.arange(self.n, dtype=np.int32), lengths)
        tf = counts.astype(np.float64)
        self.terms = terms
        # Multiples of a power of two: sums are exact, in whatever order they are added.
        self.weights = np.rint(idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes / max(mean, 1e-9))[owner]) * (1 << 20)) / (1 << 20)
        order = np.argsort(terms, kind="stable")
        self.items, self.impacts = owner[order].astype(np.int64), self.weights[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(idf)))])
        self.asked = np.zeros(len(idf), np.float32)
        self.ties = mixed(np.arange(self.n) if ords is None else ords) & TIES
        common = np.flatnonzero(np.diff(self.at) > max(8, self.n // 16))
        self.column = np.full(len(idf), -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.n))
        dense = self.column[terms]
        self.matrix[dense[dense >= 0], owner[dense >= 0]] = self.weights[dense >= 0]

    def scores(self, terms: np.ndarray, fit: int) -> np.ndarray:
        """BM25 of the first `fit` items for the terms."""
        return self.all_scores(terms, np.array([len(terms)]))[0, :fit]

    def all_scores(self, terms: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 of all items (columns) for several seeds (rows), whose terms are flat."""
        seed = np.repeat(np.arange(len(lengths)), lengths)
        column = self.column[terms]
        asked = np.zeros((len(lengths), len(self.matrix)))
        asked[seed[column >= 0], column[column >= 0]] = 1
        out = asked @ self.matrix
        n = self.at[terms + 1] - self.at[terms]
        rare = (column < 0) & (n > 0)
        if rare.any():
            n, first = n[rare], self.at[terms[rare]]
            flat = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
            out += np.bincount(np.repeat(seed[rare] * self.n, n) + self.items[flat], self.impacts[flat], out.size).reshape(out.shape)
        return out

    def exact(self, terms: np.ndarray, items: np.ndarray) -> np.ndarray:
        """BM25 of the items (ascending) for all the terms."""
        n = self.starts[items + 1] - self.starts[items]
        flat = np.arange(int(n.sum())) + np.repeat(self.starts[items] - (np.cumsum(n) - n), n)
        self.asked[terms] = 1
        out = np.bincount(np.repeat(np.arange(len(items)), n), self.weights[flat] * self.asked[self.terms[flat]].astype(np.float64), len(items))
        self.asked[terms] = 0
        return out

    def all_nearest(self, terms: np.ndarray, lengths: np.ndarray, rooms: np.ndarray, turns: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For several seeds, whose terms are flat, the k best items that fit: number of the seed, place of the item, and rank. A higher rank is better:
        the score in steps of 1 / STEP, above a tie that differs with the seed's turn, so that seeds want different ones of the items with the same
        score, as copies have."""
        out = []
        at = np.concatenate([[0], np.cumsum(lengths)])
        some = max(1, (1 << 20) // max(self.n, 1))
        for a in range(0, len(lengths), some):
            b = min(len(lengths), a + some)
            rank = np.rint(self.all_scores(terms[at[a] : at[b]], lengths[a:b]) * STEP).astype(np.int64) << 31
            rank[np.arange(self.n)[None, :] >= np.searchsorted(self.sizes, rooms[a:b], "right")[:, None]] = 0
            rank |= self.ties[None, :] ^ (mixed(turns[a:b]) & TIES)[:, None]
            if self.n > k:
                near = np.argpartition(rank, self.n - k, axis=1)[:, self.n - k :]
                rank = np.take_along_axis(rank, near, 1)
            else:
                near = np.broadcast_to(np.arange(self.n), rank.shape)
            seed, j = np.nonzero(rank > TIES)
            out.append((seed + a, near[seed, j], rank[seed, j]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def nearest(self, terms: np.ndarray, room: int, k: int, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best items that fit."""
        _, near, rank = self.all_nearest(terms, np.array([len(terms)]), np.array([room]), np.array([turn]), k)
        best = np.argsort(-rank)
        return near[best], (rank[best] >> 31) / STEP


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each number, not negative."""
    x = np.asarray(x).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).view(np.int64)


def sketched(terms: np.ndarray, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of WIDTH whole numbers, of length LONG: each term's weight is added, with a sign, at two places by hash. Products of rows stand for those
    of the weights. They stay below 2 ** 24, so matrices of them are exact however they are multiplied."""
    h = mixed(np.arange(int(terms.max()) + 1 if len(terms) else 1))
    row = np.repeat(np.arange(len(lengths)), lengths) * WIDTH
    out = np.zeros(len(lengths) * WIDTH)
    for shift in (0, 20):
        at, sign = (h >> shift) % WIDTH, ((h >> (shift + 16)) & 1) * 2 - 1
        out += np.bincount(row + at[terms], weights * sign[terms], len(out))
    out = out.reshape(-1, WIDTH)
    return unit(out)


def unit(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (LONG / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9))).astype(np.float32)


def means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most k directions around which the rows of x lie: spherical k-means from the first k rows."""
    out = x[:k]
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[a : a + 8192] @ out.T, axis=1) for a in range(0, len(x), 8192)])
        order = np.argsort(near, kind="stable")
        found, first = np.unique(near[order], return_index=True)
        out = unit(np.add.reduceat(x[order].astype(np.float64), first, axis=0))
    return out


class Cells:
    """Where related items lie: directions in two levels, each of the second with the units (equal parts by hash, but for masses of like items one)
    and shards that hold its items. An item belongs to the cell nearest to it; a seed is scored against the items of the nearest `visited`."""

    def __init__(self, sample: np.ndarray, k: int, items: int, shards: int):
        """sample: sketches of some items, from which k cells are found; items: how many there are."""
        self.visited = int(np.ceil(VISITS * max(1, k / 256) ** 0.5))
        if k <= VISITS:  # every seed meets every item
            self.tops = self.leaves = np.zeros((1, WIDTH), np.float32)
            self.first, self.parts = np.array([0, 1]), np.array([k])
            share = np.ones(1)
        else:
            self.tops = means(sample[: 64 * FLAT], 1 if k <= FLAT else int(np.ceil(np.sqrt(k))))
            self.tops = self.tops[chained(self.tops)]
            top = np.concatenate([np.argmax(sample[a : a + 8192] @ self.tops.T, axis=1) for a in range(0, len(sample), 8192)])
            leaves = []
            for t in range(len(self.tops)):
                own = sample[top == t]
                some = means(own, max(1, round(k * len(own) / len(sample)))) if len(own) else self.tops[t : t + 1]
                leaves.append(some[chained(some)])
            self.first = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
            self.leaves = np.concatenate(leaves)
            share = np.bincount(self.best(sample, 1)[:, 0], minlength=len(self.leaves)) / len(sample)
            self.parts = np.maximum(1, np.ceil(share * items / (4 * CELL)).astype(np.int64))
        self.base = np.concatenate([[0], np.cumsum(self.parts)])
        weight = np.repeat(share / self.parts, self.parts) + 1e-9
        before = np.cumsum(weight) - weight / 2
        self.shard = np.unique((before / weight.sum() * shards).astype(np.int64), return_inverse=True)[1]
        self.shards = int(self.shard.max()) + 1

    def best(self, x: np.ndarray, n: int, beam: int = VISITS) -> np.ndarray:
        """The n nearest cells of each row, nearest first; -1 where there are fewer."""
        beam = min(beam, len(self.tops))
        tops = np.zeros((len(x), 1), np.int64) if beam == 1 else np.argpartition(-(x @ self.tops.T), beam - 1, axis=1)[:, :beam]
        cell, score = np.full((len(x), beam * n), -1), np.full((len(x), beam * n), -np.inf)
        row, slot = np.repeat(np.arange(len(x)), beam), np.tile(np.arange(beam), len(x))
        order = np.argsort(tops.ravel(), kind="stable")
        ends = np.searchsorted(tops.ravel()[order], np.arange(len(self.tops) + 1))
        for t in np.flatnonzero(np.diff(ends)).tolist():
            some = order[ends[t] : ends[t + 1]]
            s = x[row[some]] @ self.leaves[self.first[t] : self.first[t + 1]].T
            m = min(n, s.shape[1])
            near = np.argpartition(-s, m - 1, axis=1)[:, :m]
            where = (row[some][:, None], slot[some][:, None] * n + np.arange(m))
            cell[where], score[where] = near + self.first[t], np.take_along_axis(s, near, 1)
        return np.take_along_axis(cell, np.lexsort((cell, -score), axis=1)[:, :n], 1)

    def units(self, x: np.ndarray, ords: np.ndarray) -> np.ndarray:
        """The unit of each item, of those of its cell by hash."""
        cell = self.best(x, 1)[:, 0]
        return self.base[cell] + mixed(ords) % self.parts[cell]

    def visits(self, x: np.ndarray, ords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of seed and unit: for each seed those of its nearest cells; of a cell with more units than `visited` as many, which ones by hash."""
        cell = self.best(x, self.visited, max(VISITS, self.visited))
        seed, at = np.nonzero(cell >= 0)
        cell = cell[seed, at]
        n = np.minimum(self.parts[cell], self.visited)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        seed, cell = np.repeat(seed, n), np.repeat(cell, n)
        return seed, self.base[cell] + (mixed(ords)[seed] + step) % self.parts[cell]


def chained(x: np.ndarray) -> np.ndarray:
    """An order of the rows in which each is followed by the nearest of those that are left."""
    s = x @ x.T
    out, left = [0], np.ones(len(x), bool)
    left[0] = False
    while len(out) < len(x):
        out.append(int(np.argmax(np.where(left, s[out[-1]], -np.inf))))
        left[out[-1]] = False
    return np.array(out)


def best_fit(rooms: list[int], sizes: np.ndarray, capacity: int) -> list[int]:
    """For each of the sizes, largest first, the number of the container where it leaves the least room. Containers 0, 1, ... have the rooms
    given; others are opened as needed, of full capacity."""
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    for box in range(len(rooms) - 1, -1, -1):
        open_[rooms[box]].append(box)
    some = np.array([bool(x) for x in open_])
    out, n = [], len(rooms)
    for size in sizes.tolist():
        room = size + int(np.argmax(some[size:]))
        if some[room]:
            box = open_[room].pop()
            some[room] = bool(open_[room])
        else:
            room, box = capacity, n
            n += 1
        out.append(box)
        open_[room - size].append(box)
        some[room - size] = True
    return out


def narrow(most: int) -> str:
    """The least unsigned type for numbers up to `most`."""
    return "<u2" if most < 1 << 16 else "<u4"


def kinds(capacity: int, tokenizer: str, folder: str) -> tuple[str, str]:
    """How the binary columns terms (and more) and counts hold their numbers."""
    return narrow(bpe.vocabulary(f"{folder}/{tokenizer}.json")), narrow(capacity)


def sized(df: DataFrame, key: str, text: str, capacity: int, tokenizer: str, folder: str) -> DataFrame:
    """id, key, n (tokens), size (of the piece to be packed: n, or what is left after full containers), ord (a hash of key and text), copy (how
    often a task saw that hash before), the piece's distinct tokens with their counts, and the text's tokens that the piece hasn't."""
    path = bpe.shipped(df.sparkSession, f"{folder}/{tokenizer}.json")
    kind = df.schema[key].dataType.simpleString()
    term, number = kinds(capacity, tokenizer, folder)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = bpe.encoder(path)
        context = TaskContext.get()
        serial = (context.partitionId() if context else 0) << 36
        seen: Counter = Counter()
        for b in parts:
            texts = b.column(1).to_pylist()
            for at, some in bpe.batches_of(texts):
                terms, counts, more, n, copies = [], [], [], [], []
                for x, o in zip(e.encode(some), b.column(2).slice(at, len(some)).to_pylist()):
                    ids = bpe.unpacked(x)
                    n.append(len(ids))
                    piece = ids[len(ids) // capacity * capacity :] if len(ids) > capacity else ids
                    t, c = np.unique(piece, return_counts=True)
                    terms.append(t.astype(term).tobytes())
                    counts.append(c.astype(number).tobytes())
                    more.append(np.setdiff1d(ids, t).astype(term).tobytes() if len(piece) < len(ids) else b"")
                    copies.append(seen[o])
                    seen[o] += 1
                n = np.array(n, np.int64)
                ids = pa.array(serial + np.arange(len(some)), pa.int64())
                serial += len(some)
                columns = [ids, b.column(0).slice(at, len(some)), pa.array(n), pa.array(np.where(n > capacity, n % capacity, n), pa.int32()), b.column(2).slice(at, len(some)), pa.array(copies, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.binary()) for x in (terms, counts, more)]], names=["id", "key", "n", "size", "ord", "copy", "terms", "counts", "more"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).withColumn("ord", F.xxhash64("key", "text"))
    return spread(rows).mapInArrow(run, f"id long, key {kind}, n long, size int, ord long, copy long, terms binary, counts binary, more binary")


def statistics(table: DataFrame, term: str) -> tuple[np.ndarray, float]:
    """Inverse document frequency by token and mean length, of all whole texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1, np.int64)
        for b in parts:
            c = np.bincount(np.frombuffer(b"".join(x for col in (0, 1) for x in b.column(col).to_pylist()), term), minlength=len(seen))
            c[: len(seen)] += seen
            seen = c
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["term", "df"])

    # One number per token of the vocabulary, however large the corpus.
    found = table.select("terms", "more").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    count, mean = table.agg(F.count("*"), F.avg("n")).first()
    terms = found["term"].to_numpy()
    df_all = np.zeros(int(terms.max()) + 1 if len(terms) else 1)
    df_all[terms] = found["df"].to_numpy()
    return np.log(1 + (count - df_all + 0.5) / (df_all + 0.5)), float(mean or 0)


def flat_terms(b: pa.RecordBatch, kinds: tuple[str, str], *, counts: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """The terms of a batch and, if asked for, their counts, flat; and how many each row has."""
    terms = b.column("terms").to_pylist()
    flat = np.frombuffer(b"".join(terms), kinds[0]).astype(np.int64)
    number = np.frombuffer(b"".join(b.column("counts").to_pylist()), kinds[1]).astype(np.float64) if counts else None
    return flat, number, np.array([len(x) for x in terms], np.int64) // int(kinds[0][-1])


def sketches(b: pa.RecordBatch, kinds: tuple[str, str], idf: np.ndarray, mean: float, seed: bool) -> np.ndarray:
    """So that the product of a seed's and an item's is their score but for the items' lengths, the root of a term's idf goes to either."""
    terms, counts, lengths = flat_terms(b, kinds, counts=not seed)
    weights = np.sqrt(idf[terms])
    if not seed:
        weights *= counts * (K1 + 1) / (counts + np.repeat(K1 * (1 - B + B * b.column("size").to_numpy() / max(mean, 1e-9)), lengths))
    return sketched(terms, weights, lengths)


def cells_of(items: DataFrame, idf: np.ndarray, mean: float, kinds: tuple[str, str], postings: int = POSTINGS) -> Cells:
    """Cells of CELL items on average, found from SAMPLE sketches a cell; the driver holds those. Which cells there are, and so which items a seed is
    scored against, doesn't depend on the number of cores or shards."""
    spark = items.sparkSession
    held, count = items.agg(F.sum(F.octet_length("terms")), F.count("*")).first()
    k = min(MOST, max(1, -(-count // CELL)))
    shards = max(-(-((held or 0) // int(kinds[0][-1])) // postings), 2 * spark.sparkContext.defaultParallelism)
    if k <= VISITS:
        return Cells(np.zeros((0, WIDTH), np.float32), k, count, shards)
    shared = spark.sparkContext.broadcast((idf, mean))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value
        for b in parts:
            x = sketches(b, kinds, idf, mean, False).astype("<i2")
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("copy"), pa.array([r.tobytes() for r in x], pa.binary())], names=["ord", "copy", "x"])

    some = items.filter(F.pmod(F.xxhash64("ord", "copy", F.lit(4)), F.lit(1 << 30)) < F.lit((SAMPLE * k << 30) // count)).select("ord", "copy", "size", "terms", "counts")
    found = some.mapInArrow(run, "ord long, copy long, x binary").toArrow()
    x = np.frombuffer(b"".join(found["x"].to_pylist()), "<i2").reshape(-1, WIDTH)
    return Cells(x[np.lexsort((found["copy"].to_numpy(), found["ord"].to_numpy()))].astype(np.float32), k, count, shards)


def nearest(seeds: DataFrame, items: DataFrame, idf: np.ndarray, mean: float, kinds: tuple[str, str], k: int = NEAREST, postings: int = POSTINGS, cells: Cells | None = None) -> DataFrame:
    """The k best items by BM25 for each seed, of those in the cells that it visits that are no larger than its room: seed, sord, room, item, iord,
    size, score.

    seeds: id, ord, room, size, terms, counts. items: id, ord, copy, size, terms, counts. A seed meets the shards of the cells nearest to it, and there
    all items of those cells, by all its terms; its work grows as the root of the corpus at most. The rows of a shard are held by one task, the seeds
    stream past it. Where shards are fewer than cores each is built in several tasks, which share the seeds."""
    spark = seeds.sparkSession
    term, number = kinds
    cells = cells or cells_of(items, idf, mean, kinds, postings)
    shared = spark.sparkContext.broadcast((idf, mean, cells))
    shards = cells.shards
    blocks = max(1, -(-spark.sparkContext.defaultParallelism // shards))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    block = F.pmod(F.xxhash64("ord", F.lit(1)), F.lit(blocks)).cast("int")

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean, cells = shared.value
        for b in parts:
            ords = b.column("ord").to_numpy() ^ mixed(b.column("copy").to_numpy())
            unit = cells.units(sketches(b, kinds, idf, mean, False), ords)
            shard = pa.array(cells.shard[unit].astype(np.int32))
            visits = pa.array([x.tobytes() for x in unit.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "ord", "size", "terms", "counts")), shard, visits], names=["id", "ord", "size", "terms", "counts", "shard", "units"])

    def asking(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean, cells = shared.value
        for b in parts:
            seed, unit = cells.visits(sketches(b, kinds, idf, mean, True), b.column("ord").to_numpy())
            shard = cells.shard[unit]
            order = np.lexsort((unit, shard, seed))
            seed, unit, shard = seed[order], unit[order].astype("<i4"), shard[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(seed) != 0) | (np.diff(shard) != 0)])) if len(seed) else np.zeros(0, np.int64)
            visits = pa.array([x.tobytes() for x in np.split(unit, first[1:])] if len(first) else [], pa.binary())
            rows = b.select(["id", "ord", "size", "terms"]).take(pa.array(seed[first]))
            none = pa.nulls(len(first), pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, none, pa.array(shard[first].astype(np.int32)), visits], names=["id", "ord", "size", "terms", "counts", "shard", "units"])

    kind = "id long, ord long, size int, terms binary, counts binary, shard int, units binary"
    rows = items.select("id", "ord", "copy", "size", "terms", "counts").mapInArrow(placed, kind).withColumns({"tag": F.lit(0), "block": numbers})
    asked = seeds.select("id", "ord", F.col("room").alias("size"), "terms").mapInArrow(asking, kind).withColumns({"tag": F.lit(1), "block": block})
    both = rows.unionByName(asked).withColumn("part", F.col("shard") * blocks + F.col("block")).drop("shard", "block")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean, _ = shared.value
        held: list[tuple] = []
        indexes: dict[int, tuple] | None = None
        for b in parts:
            tag, id_, ord_, size = (b.column(c).to_numpy() for c in ("tag", "id", "ord", "size"))
            first = int(np.searchsorted(tag, 1))
            if first:
                of = b.slice(0, first)
                held.append((id_[:first], ord_[:first], size[:first], np.frombuffer(b"".join(of.column("units").to_pylist()), "<i4"), of.column("terms").to_pylist(), of.column("counts").to_pylist()))
            if first == len(tag):
                continue
            if indexes is None:
                indexes = {}
                ids, ords, sizes, unit = (np.concatenate([h[c] for h in held]) if held else np.zeros(0, np.int64) for c in range(4))
                order = np.lexsort((ids, ords, sizes, unit))
                flat = [[x for h in held for x in h[c]] for c in (4, 5)]
                held = []
                for some in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1) if len(order) else []:
                    lengths = np.array([len(flat[0][i]) // int(term[-1]) for i in some.tolist()], np.int64)
                    terms, counts = (np.frombuffer(b"".join(x[i] for i in some.tolist()), t).astype(np.int32) for x, t in zip(flat, kinds))
                    indexes[int(unit[some[0]])] = (Index(terms, counts, lengths, sizes[some], idf, mean, ords[some]), some)
                flat = []
            of = b.slice(first)
            id_, ord_, room = id_[first:], ord_[first:], size[first:]
            terms, _, lengths = flat_terms(of, kinds, counts=False)
            starts = np.cumsum(lengths) - lengths
            visits = of.column("units").to_pylist()
            row, unit = np.repeat(np.arange(len(visits)), [len(v) // 4 for v in visits]), np.frombuffer(b"".join(visits), "<i4")
            order = np.argsort(unit, kind="stable")
            out = []
            for some in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1):
                if int(unit[some[0]]) not in indexes:
                    continue
                index, where = indexes[int(unit[some[0]])]
                some = row[some]
                n = lengths[some]
                at = np.arange(int(n.sum())) + np.repeat(starts[some] - (np.cumsum(n) - n), n)
                seed, near, rank = index.all_nearest(terms[at], n, room[some], ord_[some], k)
                out.append((some[seed], where[near], rank))
            if not out:
                continue
            seed, item, rank = (np.concatenate(x) for x in zip(*out))
            order = np.lexsort((-rank, seed))
            seed, item, rank = seed[order], item[order], rank[order]
            starts = np.searchsorted(seed, np.arange(len(id_)))
            best = np.arange(len(seed)) - starts[seed] < k
            seed, item, rank = seed[best], item[best], rank[best]
            columns = (id_[seed], ord_[seed], room[seed], ids[item], ords[item], sizes[item].astype(np.int32), (rank >> 31) / STEP, rank)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["seed", "sord", "room", "item", "iord", "size", "score", "rank"])

    found = both.repartitionById(shards * blocks, F.col("part")).sortWithinPartitions("part", "tag").select("tag", "id", "ord", "size", "terms", "counts", "units")
    found = found.mapInArrow(run, "seed long, sord long, room int, item long, iord long, size int, score double, rank long")
    if shards == 1:
        return found.drop("rank")
    return spark.sql(f"SELECT seed, sord, room, item, iord, size, score FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY rank DESC, item) AS rn FROM {{near}}) WHERE rn <= {k}", near=found)


def match(edges: DataFrame, rounds: int) -> tuple[DataFrame, list[DataFrame]]:
    """Texts given to seeds: seed, item, iord, size, score, turn; and the tables written for it. In each round every text asks the seed it fits best of
    those that still have room for it, and each seed takes what asks it, best first, while there is room."""
    taken, written = None, []
    for turn in range(rounds):
        best = edges.groupBy("item").agg(F.max(F.struct("score", F.xxhash64("sord", "iord").alias("tie"), "seed", "size", "room", "iord")).alias("x")).select("item", "x.*")
        asks = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "iord", "item", "size")))  # no more than NEAREST a seed

        def take(state, x):
            more = F.struct((state.room - x["size"]).cast("int").alias("room"), F.array_append(state.got, F.struct(x["item"].alias("item"), x["iord"].alias("iord"), x["size"].alias("size"), (-x["s"]).alias("score"))).alias("got"))
            return F.when(x["size"] <= state.room, more).otherwise(state)

        won = best.groupBy("seed").agg(asks.alias("asks"), F.first("room").alias("room"))
        start = F.struct("room", F.array().cast("array<struct<item:bigint,iord:bigint,size:int,score:double>>").alias("got"))
        won = cut(won.select("seed", F.aggregate("asks", start, take).alias("r")).select("seed", "r.room", "r.got"), "won")
        written.append(won)
        pairs = won.select("seed", F.inline("got")).withColumn("turn", F.lit(turn))
        taken = pairs if taken is None else taken.unionByName(pairs)
        if turn + 1 < rounds:
            room = won.select("seed", F.col("room").alias("_room"))
            left = edges.join(pairs.select("item"), "item", "left_anti").join(room, "seed", "left")
            left = left.withColumn("room", F.coalesce("_room", "room")).drop("_room").filter("size <= room")
            edges = cut(left.select("seed", "sord", "room", "item", "iord", "size", "score"), "edges")
            written.append(edges)
    return taken, written


def seeds_of(items: DataFrame, capacity: int) -> DataFrame:
    """As many texts as they all fill containers: those over half the capacity, no two of which fit together, and of the others a share by hash, so that
    copies are seldom both seeds."""
    large = F.col("size") > capacity // 2
    total, n, big = items.agg(F.sum("size"), F.count("*"), F.count_if(large)).first()
    wanted = -(-(total or 0) // capacity) - big
    if wanted <= 0:
        return items.filter(large)
    share = F.pmod(F.xxhash64("ord", "copy", F.lit(2)), F.lit(1 << 30)) < F.lit((wanted << 30) // (n - big))
    return items.filter(large | share)


def laid_out(content: list[list[int]], sizes: np.ndarray, rest: np.ndarray, capacity: int) -> list[list[int]]:
    """Containers (lists of texts by number) once the texts of `rest`, largest first, are laid where they leave the least room. If the containers are
    then less than FULL on the whole, those with most room are emptied, a tenth of all at a time, and their texts laid by size alone, until they are
    full enough; if they never are, in the way that takes the fewest containers."""

    def filled(boxes: list[list[int]], items: np.ndarray) -> list[list[int]]:
        out = [list(b) for b in boxes]
        for i, box in zip(items.tolist(), best_fit([capacity - int(sizes[b].sum()) for b in boxes], sizes[items], capacity)):
            if box == len(out):
                out.append([])
            out[box].append(i)
        return out

    first = best = filled(content, rest)
    wanted = int(-(-sizes.sum() // (FULL * capacity)))
    by_room = sorted(range(len(first)), key=lambda b: int(sizes[first[b]].sum()))
    for tenth in range(1, 11):
        if len(best) <= wanted:
            break
        n = -(-len(by_room) * tenth // 10)
        loose = np.array([i for b in by_room[:n] for i in first[b]], np.int64)
        again = filled([first[b] for b in by_room[n:]], loose[np.argsort(-sizes[loose], kind="stable")])
        best = again if len(again) < len(best) else best
    return best


def fill_up(seeds: DataFrame, near: DataFrame, items: DataFrame, capacity: int, containers: int) -> DataFrame:
    """Where all texts lie: id, container (the id of the first text in it), place. seeds: id, ord, copy, size; near, the texts given to them: id, ord, size,
    seed, place; items, those left: id, ord, copy, size (texts without tokens too, which come last). Seeds with their texts, and the texts left,
    are dealt into groups by hash, each filled by one task."""
    groups = max(1, -(-containers // GROUP))
    group = F.pmod(F.xxhash64("ord", "copy", F.lit(3)), F.lit(groups)).cast("int").alias("g")
    none = F.lit(None).cast("long").alias("seed")
    mine = near.join(seeds.select(group, F.col("id").alias("seed")), "seed").select("g", F.lit(1).alias("kind"), "id", "ord", "size", "seed", "place")
    both = seeds.select(group, F.lit(0).alias("kind"), "id", "ord", "size", none, F.lit(0).alias("place")).unionByName(mine)
    both = both.unionByName(items.select(group, F.lit(2).alias("kind"), "id", "ord", "size", none, F.lit(0).alias("place")))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["kind", "place", "size", "ord", "id"], ascending=[True, True, False, True, True])
        kind, ids, sizes = p["kind"].to_numpy(), p["id"].to_numpy(), p["size"].to_numpy().astype(np.int64)
        content = [[i] for i in np.flatnonzero(kind == 0).tolist()]
        box_of = {ids[b[0]]: b for b in content}
        for i, s in zip(np.flatnonzero(kind == 1).tolist(), p["seed"][kind == 1].astype("int64").tolist()):
            box_of[s].append(i)
        boxes = laid_out(content, sizes, np.flatnonzero((kind == 2) & (sizes > 0)), capacity)
        empty = np.flatnonzero(sizes == 0).tolist()
        if empty:
            boxes = boxes or [[]]
            boxes[-1] = boxes[-1] + empty
        return pd.DataFrame([(ids[i], ids[b[0]], k) for b in boxes for k, i in enumerate(b)], columns=["id", "container", "place"])

    return both.repartitionById(groups, F.col("g")).groupBy("g").applyInPandas(run, "id long, container long, place int")


def pack(df: DataFrame, key: str, text: str, capacity: int = 2048, tokenizer: str = "byte_bpe_50k", folder: str = bpe.TOKENIZERS, postings: int = POSTINGS) -> DataFrame:
    """One row per text or piece: key, piece (from 0), container long, place (from 0), first (its first token in the text), tokens.

    A container holds at most `capacity` tokens. Texts of at most that size have one piece; longer ones fill containers by themselves and their
    rest is packed as a text. Null and empty texts have no tokens, take no room and come last in a container. Repeated rows are texts of their own;
    other columns are ignored. Container numbers are unique but not consecutive and may differ between runs; which texts share one doesn't."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    table = cut(sized(df, key, text, capacity, tokenizer, folder), "sized")
    held = kinds(capacity, tokenizer, folder)
    idf, mean = statistics(table, held[0])
    texts = table.filter("size > 0")
    seeds = seeds_of(texts, capacity).select("id", "ord", "copy", "size", "terms", "counts", (F.lit(capacity) - F.col("size")).cast("int").alias("room"))
    seeds = cut(seeds, "seeds")
    count, containers = table.count(), seeds.count()
    unused = texts.join(seeds.select("id"), "id", "left_anti")
    cells = cells_of(unused, idf, mean, held, postings)
    taken, done = None, []
    for probe in range(PROBES):
        if taken is None:
            asking, free = seeds, unused
        else:
            used = taken.groupBy(F.col("seed").alias("id")).agg(F.sum("size").alias("used"))
            asking = seeds.join(used, "id", "left").withColumn("room", (F.col("room") - F.coalesce("used", F.lit(0))).cast("int")).drop("used")
            free = unused.join(taken.select(F.col("item").alias("id")), "id", "left_anti")
        edges = cut(nearest(asking.filter("room > 0"), cut(free.select("id", "ord", "copy", "size", "terms", "counts"), "free") if taken is not None else free, idf, mean, held, cells=cells), "edges")
        pairs, written = match(edges, ROUNDS)
        pairs = pairs.withColumn("turn", F.col("turn") + probe * ROUNDS)
        taken = pairs if taken is None else taken.unionByName(pairs)
        done += [edges, *written]
    taken = cut(taken, "taken")
    dropped(*done)
    rest = table.filter("size > 0 or n = 0").join(seeds.select("id").unionByName(taken.select(F.col("item").alias("id"))), "id", "left_anti").select("id", "ord", "copy", "size")
    in_order = taken.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("turn", (-F.col("score")).alias("s"), "iord", "item", "size"))).alias("all"))  # a container's texts
    near = in_order.select("seed", F.posexplode("all").alias("place", "x")).select(F.col("x.item").alias("id"), F.col("x.iord").alias("ord"), "x.size", "seed", "place")
    where = fill_up(seeds, near, rest, capacity, max(containers, count // 8))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        serial = 1 << 62 | (context.partitionId() if context else 0) << 40  # above all ids
        for b in parts:
            n, container, place = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "container", "place"))
            whole, rest = np.where(n > capacity, n // capacity, 0), np.where(n > capacity, n % capacity, n)
            full = np.repeat(np.arange(len(n)), whole)
            k = np.arange(len(full)) - np.repeat(np.cumsum(whole) - whole, whole)
            items = np.flatnonzero((rest > 0) | (n == 0))
            keys = b.column("key").take(pa.array(np.concatenate([full, items])))
            columns = [(k, whole[items]), (serial + np.arange(len(full)), container[items]), (0 * k, place[items]), (k * capacity, whole[items] * capacity), (0 * k + capacity, rest[items])]
            serial += len(full)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(np.concatenate(c), t) for c, t in zip(columns, kinds)]], names=["key", "piece", "container", "place", "first", "tokens"])

    out = table.select("id", "key", "n").join(where, "id", "left").withColumns({"container": F.coalesce("container", F.lit(-1)), "place": F.coalesce("place", F.lit(0))})
    out = out.select("key", "n", "container", "place").mapInArrow(run, f"key {kind}, piece int, container long, place int, first long, tokens long")
    return out.withColumnRenamed("key", key)
