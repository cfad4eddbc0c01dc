"""Texts that were decoded with the wrong character encoding: found, and set right again where nothing was lost.

Each stretch (a run of letters and non-ASCII characters) was written as it stands, or garbled by one of many chains of encodings,
which is hidden. Expectation-maximization estimates how often each chain befell each source and field, together with a
character model of the texts as they were meant: the E-step weighs, for each distinct stretch, what each chain would
have turned into it; the M-step counts those readings by their weight. Evidence that is weak in one record is pooled over all. A record's
stretches then share a prior that starts from its source's, and each stretch is repaired by its posterior.

What is broadcast and collected has a fixed size: hashed n-gram counts and a table of priors with a fixed number of slots."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import cut, ship, spread

LOST = "�"
#: Encodings that texts are read in by mistake (the single-byte ones), and those they may have been written in.
READ_AS = (
    "latin-1", "cp1252", "cp1250", "cp1251", "cp437", "cp850", "cp852", "mac_roman", "koi8_r", "cp866", "iso8859_2", "cp1253", "iso8859_9", "cp1254", "iso8859_15", "cp1257", "iso8859_5", "iso8859_7", "mac_cyrillic", "cp737", "cp775",
    "gbk", "shift_jis", "cp949", "big5",
)
WIDE = ("gbk", "shift_jis", "cp949", "big5")
WRITTEN_IN = ("cp1252", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_2", "iso8859_7", "mac_roman", "cp437", "cp850", "euc_jp", "shift_jis", "gbk", "cp949", "big5")
SLOTS = 256  # sources with a prior of their own, by hash
TRI, BI, UNI = 1 << 19, 1 << 17, 1 << 16  # sizes of the hashed n-gram tables
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # each n-gram has a slot by each seed, in a table of its own; the lesser count holds
LAYOUT = (TRI, TRI, BI, BI, UNI, BI, BI, UNI)  # trigrams, bigrams, characters; and pairs and characters that another follows
COUNTS = sum(LAYOUT)
BACKOFF = 6.0
WILD = 0.1  # probability of a lost character in its place
CUT_OFF = "\uffff"  # in a reading: the first half of a character whose second half is ASCII and stands outside the stretch
BOM, BOM_SHARE = "\ufeff", 0.0005  # files may begin with a byte-order mark, whether or not this corpus has one as it should be
START = 0.9  # prior that a stretch is as it was meant, before the first round
DOUBTED = 0.001  # weight in the first character model of stretches that read as UTF-8 or have lost something
POOL = 2.0  # stretches' worth of the source's prior in the record's


@dataclass(frozen=True)
class Chain:
    read_as: str
    written_in: str
    times: int = 1

    @property
    def name(self) -> str:
        return f"{self.written_in}>{self.read_as}" + (f"x{self.times}" if self.times > 1 else "")


CHAINS = (
    [Chain(r, "utf-8") for r in READ_AS]
    + [Chain(r, "utf-8", 2) for r in READ_AS if r not in WIDE]
    + [Chain(r, w) for r in READ_AS if r not in WIDE for w in WRITTEN_IN if r != w]
)
MEANT, LOSSY = 0, 1  # what stands before the chains in all tables
KINDS = ("meant", "lost", *(c.name for c in CHAINS))


def _byte_table(codec: str) -> dict[int, int]:
    """Code points to the byte that this codec reads as them; bytes it leaves undefined stand for themselves."""
    out = {c: 0xFFFF for c in range(128, 256)}
    for b in range(128, 256):
        try:
            out[ord(bytes([b]).decode(codec))] = b
        except UnicodeDecodeError:
            out[b] = b
    return out


_TABLES = {c: _byte_table(c) for c in READ_AS if c not in WIDE}
#: A byte-order mark, as it is or read as any of these, is a stretch by itself; else a stretch is a run of letters and non-ASCII characters.
_MARKS = [BOM, *sorted({"".join(chr(next(k for k, x in t.items() if x == b)) for b in b"\xef\xbb\xbf") for t in _TABLES.values()})]
STRETCH = re.compile("|".join(map(re.escape, _MARKS)) + "|[A-Za-z]*[^\x00-\x7f][A-Za-z\x80-\U0010ffff]*")
_CHARS = {c: frozenset(chr(k) for k, b in t.items() if b != 0xFFFF) | frozenset(map(chr, range(128))) for c, t in _TABLES.items()}


def as_bytes(text: str, codec: str) -> bytes | None:
    """The bytes that the codec, with its undefined bytes standing for themselves, reads as this text; None if there are none."""
    if codec not in WIDE:
        return text.translate(_TABLES[codec]).encode("latin-1") if _CHARS[codec].issuperset(text) else None
    try:
        return text.encode(codec)
    except UnicodeError:
        return None


def decoded(raw: bytes, codec: str) -> str | None:
    """The bytes read in a codec; None if they can't be. In codecs whose characters may end in an ASCII byte, a last half is CUT_OFF."""
    try:
        return raw.decode(codec)
    except UnicodeDecodeError as e:
        if codec not in WIDE or e.start != len(raw) - 1 or len(raw) < 5:
            return None
        return raw[:-1].decode(codec) + CUT_OFF


def undo(text: str, chain: Chain) -> list[str]:
    """The texts that the chain may have turned into `text`. The second time a text was garbled it may have been read in another of the
    two commonest encodings."""
    raw = as_bytes(text, chain.read_as)
    out = decoded(raw, chain.written_in) if raw else None
    if not out or chain.times == 1:
        return [out] if out else []
    return list(dict.fromkeys(x for r in (chain.read_as, "latin-1", "cp1252") for x in undo(out, Chain(r, chain.written_in))))


_BY_READER: dict[str, list[tuple[int, Chain]]] = {}
for _k, _c in enumerate(CHAINS, 2):
    _BY_READER.setdefault(_c.read_as, []).append((_k, _c))
_UTF8 = frozenset(k for k, c in enumerate(CHAINS, 2) if c.written_in == "utf-8")
_CONTROL = re.compile("[\x7f-\x9f]").search


def readings(stretch: str) -> tuple[list[int], list[str]]:
    """What a stretch may have been: kinds and texts, once per text, chains that come first in CHAINS going before.

    A replacement mark next to letters, or repeated, is never meant: something was lost there. One by itself may be."""
    if LOST in stretch:
        return ([MEANT, LOSSY], [stretch, stretch]) if stretch == LOST else ([LOSSY], [stretch])
    first: dict[str, int] = {stretch: MEANT}
    for codec, chains in _BY_READER.items():
        if as_bytes(stretch, codec) is None:
            continue
        for k, c in chains:
            for r in undo(stretch, c):
                if (r not in first or k < first[r]) and not _CONTROL(r):
                    first[r] = k
    order = sorted(first, key=first.get)
    return [first[r] for r in order], order


class Letters:
    """Hashed character n-gram counts, and the probability of a stretch under them."""

    def __init__(self, counts: np.ndarray):
        """counts: of trigrams, bigrams, characters, and of the two characters and the one that others follow (see _count)."""
        self.counts = counts
        self.tables = np.split(counts, np.cumsum(LAYOUT)[:-1])
        self.uni = self.tables[4]
        self.total = max(1.0, float(self.uni.sum()))

    @staticmethod
    def slots(c: np.ndarray) -> list[np.ndarray]:
        """Of each character from the third on: its slots in the tables of LAYOUT."""
        u = c.astype(np.uint64)
        a, b, d = u[:-2], u[1:-1], u[2:]

        def mixed(size: int, seed: int, *parts: np.ndarray) -> np.ndarray:
            h = np.full(len(d), seed, np.uint64)
            for x in parts:
                h = (h ^ x) * np.uint64(0xFF51AFD7ED558CCD)
                h ^= h >> np.uint64(32)
            return (h & np.uint64(size - 1)).astype(np.int64)

        one = lambda x: (x & np.uint64(UNI - 1)).astype(np.int64)
        return [*(mixed(TRI, s, a, b, d) for s in SEEDS), *(mixed(BI, s, b, d) for s in SEEDS), one(d), *(mixed(BI, s, a, b) for s in SEEDS), one(b)]

    def log_p(self, texts: list[str], lossy: np.ndarray) -> np.ndarray:
        """Log probabilities of texts; in those marked lossy a replacement mark stands for any character."""
        if not texts:
            return np.zeros(0)
        c = np.frombuffer("".join(f"\x02\x02{t}\x03" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 3
        starts = np.cumsum(sizes) - sizes
        t0, t1, b0, b1, n1, c0, c1, o1 = [t[i] for t, i in zip(self.tables, self.slots(c))]
        p1 = (n1 + 0.02) / (self.total + 0.02 * UNI)
        p2 = (np.minimum(b0, b1) + BACKOFF * p1) / (o1 + BACKOFF)
        p3 = (np.minimum(t0, t1) + BACKOFF * p2) / (np.minimum(c0, c1) + BACKOFF)
        lost = c == 0xFFFD
        if lost.any():
            wild = np.repeat(lossy, sizes)[2:]
            near = wild & (lost[2:] | lost[1:-1] | lost[:-2])
            p3 = np.where(wild & lost[2:], WILD, np.where(near, np.maximum(p1 * 4, p3), p3))
        p3 = np.where(c[2:] == ord(CUT_OFF), WILD / 5, p3)
        logs = np.zeros(len(c))
        logs[2:] = np.log(p3)
        logs[starts] = 0.0
        logs[starts + 1] = 0.0
        out = np.add.reduceat(logs, starts)
        return np.where(lossy & (sizes == 4), out + 4 * math.log(WILD), out)  # a mark by itself is seldom the only trace of a loss

    def known(self) -> bytes:
        """A flag for each slot of characters: whether any text has one."""
        return (self.uni > 0.5).tobytes()


def source_slot(source: str | None) -> int:
    return 0 if source is None else 1 + zlib.crc32(source.encode()) % (SLOTS - 1)


def _posteriors(lls: np.ndarray, kinds: np.ndarray, starts: np.ndarray, sizes: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Of each reading, within its stretch. prior: of each reading's kind, in its stretch's source."""
    x = lls + np.log(prior)
    x = np.exp(x - np.repeat(np.maximum.reduceat(x, starts), sizes))
    return x / np.repeat(np.add.reduceat(x, starts), sizes)


class Weighed:
    """The readings of many stretches, flat: kinds, texts and log likelihoods, with starts and sizes by stretch."""

    def __init__(self, letters: Letters, read: list[tuple[list[int], list[str]]]):
        known = letters.known()
        kinds, texts, sizes = [], [], []
        for ks, ts in read:
            n = 0
            for k, t in zip(ks, ts):
                if k < 2 or all(known[ord(x) & (UNI - 1)] or x == CUT_OFF for x in t):
                    kinds.append(k)
                    texts.append(t)
                    n += 1
            sizes.append(n)
        self.kinds, self.texts, self.sizes = np.array(kinds, np.int64), texts, np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.lls = letters.log_p(texts, self.kinds == LOSSY)


class Model:
    """Character model and priors (one row per slot of sources, one column per kind)."""

    def __init__(self, letters: Letters, priors: np.ndarray):
        self.letters, self.priors = letters, priors
        self.seen: dict[str, tuple[np.ndarray, list[str], np.ndarray, float]] = {}

    def weigh(self, stretches: set[str]) -> None:
        """Puts the stretches into `seen`: kinds, readings, log likelihoods, and the least log odds of being meant in any source."""
        if len(self.seen) > 200_000:
            self.seen.clear()
        new = [s for s in stretches if s not in self.seen]
        if not new:
            return
        w = Weighed(self.letters, [readings(s) for s in new])
        prior = np.log(self.priors)
        for s, at, n in zip(new, w.starts.tolist(), w.sizes.tolist()):
            kinds, lls = w.kinds[at : at + n], w.lls[at : at + n]
            if kinds[0] != MEANT:
                odds = -math.inf
            elif n == 1:
                odds = math.inf
            else:
                odds = float((lls[0] + prior[:, MEANT] - (lls[1:] + prior[:, kinds[1:]]).max(1)).min())
            self.seen[s] = (kinds, w.texts[at : at + n], lls, odds)


def _count(into: np.ndarray, texts: list[str], weights: np.ndarray) -> None:
    c = np.frombuffer("".join(f"\x02\x02{t}\x03" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 3
    starts = np.cumsum(sizes) - sizes
    each = np.repeat(weights, sizes)
    each[starts] = 0.0
    each[starts + 1] = 0.0
    at = 0
    for slots, size in zip(Letters.slots(c), LAYOUT):
        into[at : at + size] += np.bincount(slots, each[2:], size)
        at += size


def _tables(found: pa.Table) -> tuple[Letters, np.ndarray]:
    all_ = np.zeros(COUNTS + SLOTS * len(KINDS), np.float32)
    all_[found["slot"].to_numpy()] = found["weight"].to_numpy()  # at most one row per slot, whatever the corpus
    _count(all_[:COUNTS], [BOM], np.array([max(1.0, BOM_SHARE * all_[2 * TRI + 2 * BI : 2 * TRI + 2 * BI + UNI].sum())]))
    return Letters(all_[:COUNTS]), all_[COUNTS:].reshape(SLOTS, len(KINDS))


def start_prior() -> np.ndarray:
    """START for what is meant; of the rest, half for text in UTF-8 that was read as something else."""
    p = np.full(len(KINDS), (1 - START) / 2 / (len(KINDS) - 1 - len(_UTF8)))
    p[[*_UTF8]] = (1 - START) / 2 / len(_UTF8)
    p[MEANT] = START
    return p


def stretches(df: DataFrame, text: str, source: str | None) -> DataFrame:
    """source slot, stretch and the number of different contexts it stands in, over all rows (copies of a text count once)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            seen: set[tuple[int, str, int]] = set()
            for s, t in zip(p["source"], p["text"]):
                if t and not t.isascii():
                    slot = source_slot(s)
                    for m in STRETCH.finditer(t):
                        a, b = m.span()
                        seen.add((slot, m[0], zlib.crc32(t[max(0, a - 16) : b + 8].encode("utf-8", "replace"))))
            yield pd.DataFrame(list(seen), columns=["slot", "stretch", "context"])

    at = F.col(source).cast("string") if source else F.lit(None).cast("string")
    rows = spread(df.select(at.alias("source"), F.col(text).alias("text"))).mapInPandas(run, "slot int, stretch string, context long")
    return rows.groupBy("slot", "stretch", "context").agg(F.lit(1).alias("one")).groupBy("slot", "stretch").agg(F.count("*").alias("n"))


def fit(df: DataFrame, text: str, source: str | None, rounds: int = 4) -> Model:
    """The model of all rows. rounds: of expectation-maximization after the first character model; the model's `moved` says what share of all stretches
    went to another chain in each of them."""
    ship(df.sparkSession)
    context = df.sparkSession.sparkContext
    base, width = COUNTS, len(KINDS)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            both = [readings(x) for x in p["stretch"]]
            yield p.assign(kinds=[k for k, _ in both], texts=[t for _, t in both])

    table = cut(stretches(df, text, source).mapInPandas(read, "slot int, stretch string, n long, kinds array<int>, texts array<string>"), "stretches")
    table = table.coalesce(context.defaultParallelism)  # each task gives up to one number per slot, so what is shuffled goes with the cores, not the corpus

    def gather(shared) -> pa.Table:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = np.zeros(base + SLOTS * width)
            letters, priors = (Letters(shared.value[0]), shared.value[1]) if shared else (None, None)
            for p in parts:
                n = p["n"].to_numpy(np.float64)
                if not len(n):
                    continue
                if letters is None:  # the first character model: the stretches as they stand, with little weight if they read as UTF-8
                    clear = np.array([s == LOST or (LOSSY not in k and _UTF8.isdisjoint(k)) for k, s in zip(p["kinds"], p["stretch"])])
                    _count(rows, p["stretch"].tolist(), np.where(clear, n, n * DOUBTED))
                    continue
                w = Weighed(letters, list(zip(p["kinds"], p["texts"])))
                slots = np.repeat(p["slot"].to_numpy(np.int64), w.sizes)
                x = _posteriors(w.lls, w.kinds, w.starts, w.sizes, priors[slots, w.kinds]) * np.repeat(n, w.sizes)
                np.add.at(rows, base + slots * width + w.kinds, x)
                told = np.flatnonzero((w.kinds != LOSSY) & (x > 1e-4) & np.fromiter((CUT_OFF not in t for t in w.texts), bool, len(w.texts)))
                if len(told):
                    _count(rows, [w.texts[i] for i in told], x[told])
            at = np.flatnonzero(rows)
            yield pd.DataFrame({"slot": at, "weight": rows[at]})

        return table.mapInPandas(run, "slot long, weight double").groupBy("slot").agg(F.sum("weight").alias("weight")).toArrow()

    letters, _ = _tables(gather(None))
    priors = np.tile(start_prior(), (SLOTS, 1))
    moved, before = [], start_prior()
    for i in range(rounds):
        shared = context.broadcast((letters.counts, priors))
        next_letters, counts = _tables(gather(shared))
        letters = next_letters if i else letters  # the first round learns the chains' shares only, so that doubtful stretches don't lend themselves support
        overall = counts.sum(0)
        overall = (overall + 50 * start_prior()) / (overall.sum() + 50)
        moved.append(float(np.abs(overall - before).sum() / 2))
        before = overall
        priors = (counts + 50 * overall) / (counts.sum(1, keepdims=True) + 50)
        shared.unpersist()
    out = Model(letters, priors)
    out.moved = moved
    return out


SURE = 12.0  # log odds from which a stretch needs no look at its record


def judge(model: Model, source: int, found: list[str]) -> list[tuple[int, str]]:
    """Kind and reading of each stretch of one record, the likeliest. The stretches share a prior of the record's own."""
    seen = [model.seen[s] for s in found]
    if all(x[3] > SURE for x in seen):
        return [(MEANT, s) for s in found]
    kinds, lls = np.concatenate([x[0] for x in seen]), np.concatenate([x[2] for x in seen])
    sizes = np.array([len(x[0]) for x in seen])
    starts = np.cumsum(sizes) - sizes
    base = model.priors[source]
    post = _posteriors(lls, kinds, starts, sizes, base[kinds])
    for _ in range(6):
        counts = np.bincount(kinds, post, len(KINDS))
        post = _posteriors(lls, kinds, starts, sizes, ((POOL * base + counts) / (POOL + len(found)))[kinds])
    out = []
    for x, at, n in zip(seen, starts.tolist(), sizes.tolist()):
        p = post[at : at + n]
        i = 0 if p[0] > 0.5 else int(p.argmax())
        out.append((int(x[0][i]), x[1][i]))
    return out


def repair(df: DataFrame, key: str, text: str | list[str], source: str | None = None, rounds: int = 4, with_text: bool = True) -> DataFrame:
    """One row per record in which a stretch was garbled: key, stretches (how many were), restorable (none of them lost anything), chain
    (the commonest), and repaired (the text with what could be restored; left out if with_text is false).

    text may be several columns: there is then a row per record and field (column field), each field of a source has a prior of its own, and all
    share the character model.

    Null and empty texts, and texts of ASCII alone, are never garbled. Characters that were meant stay, however rare. A null source is a
    source of its own. Records are judged whole; repeated rows each give a row, and other columns are ignored. With no rows there is nothing
    to learn and nothing found."""
    if not isinstance(text, str):
        names = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in text]))
        at = F.col(source).cast("string") if source else F.lit(None).cast("string")
        stacked = df.select(F.col(key).alias("key"), at.alias("source"), names)
        stacked = stacked.select(F.struct("key", "field").alias("key"), F.concat(F.coalesce("source", F.lit("\x00")), F.lit("\x1f"), "field").alias("source"), "text")
        out = repair(stacked, "key", "text", "source", rounds, with_text)
        return out.select(F.col("key.key").alias(key), "key.field", *out.columns[1:])
    model = fit(df, text, source, rounds)
    shared = df.sparkSession.sparkContext.broadcast((model.letters.counts, model.priors))
    kind = df.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(Letters(shared.value[0]), shared.value[1])
        for p in parts:
            rows = []
            told = [(k, source_slot(s), t, STRETCH.findall(t)) for k, s, t in zip(p["key"], p["source"], p["text"]) if t and not t.isascii()]
            m.weigh(set().union(*[f for *_, f in told]))
            for k, s, t, found in told:
                verdicts = judge(m, s, found)
                bad = [v for v in verdicts if v[0] != MEANT]
                if not bad:
                    continue
                names = [KINDS[v[0]] for v in bad]
                fixed = None
                if with_text:
                    it = iter(verdicts)
                    fixed = STRETCH.sub(lambda at, it=it: at[0] if CUT_OFF in (r := next(it)[1]) else r, t)
                rows.append((k, len(bad), not any(v[0] == LOSSY or CUT_OFF in v[1] for v in bad), max(sorted(set(names)), key=names.count), fixed))
            yield pd.DataFrame(rows, columns=["key", "stretches", "restorable", "chain", "repaired"])

    at = F.col(source).cast("string") if source else F.lit(None).cast("string")
    rows = spread(df.select(F.col(key).alias("key"), at.alias("source"), F.col(text).alias("text")))
    out = rows.mapInPandas(run, f"key {kind}, stretches int, restorable boolean, chain string, repaired string").withColumnRenamed("key", key)
    return out if with_text else out.drop("repaired")
