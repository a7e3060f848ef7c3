"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling.

A text is its words and one end. Each token is a customer of the restaurant of the word before it (at
first, the end): every word has a restaurant of its own, however rare. The parent
of all these is the word restaurant; its parent spells words, byte by byte and with a final space,
each byte predicted from the ORDER - 1 before it. Each byte context is a restaurant; its parent is the context without its first byte, which all
contexts that end alike share; the root's base is uniform over the 256 bytes. The outcomes of a token
are those of the unigram base score: each word of the training texts, or a word that is not among
them, which the spelling gives what it leaves over from the others. So all outcomes sum to one.

Customers sit at tables: at a table of n with weight n - d, or at a new one with weight (strength + d *
tables) * P(parent). A Gibbs step takes all customers of a dish out and seats them anew as a block: how
many tables they take is drawn from its distribution given all else, for which generalised Stirling
numbers count the ways, whatever the number of customers. Each table is a customer of the parent. The
parent's predictions and the restaurants' table totals are refreshed once a sweep. A token's
probability is averaged over SAMPLES seatings of all restaurants.

Scale: what is seated are distinct words, with their counts in each context, and distinct byte sequences
with theirs, made from all training texts. Pairs of a context and a word are packed in buckets by
word and by context, and counted there, so that no frequent word gathers them. Given what all tables sum to, words are independent, in
their contexts and in the word restaurant; a pair that is seen once has one table, and only the others
meet their contexts' tables, and then their words, in joins. Byte restaurants are grouped by their last two context bytes. Such a group and all
above it are bounded by the alphabet, whatever the size of the corpus, and so are the two top levels
(65,536 dishes), which the driver seats. The spelling tables are broadcast in blocks of BLOCK_ROWS.

A chunk of the corpus (some documents of what one task reads, of about TOKENS tokens) asks once for
each of its words, of its contexts, and of its pairs. The answers go back to the chunk, to meet there
what it has kept of each pair: the documents that hold it. So every document is summed up in one place. Texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from errata.llm.common import crc_mod, forget, mapped, written

ORDER = 5
END = b"\n"
#: By level: the root first.
DISCOUNT = (0.5, 0.6, 0.65, 0.7, 0.75)
STRENGTH = 1.0
#: Of the word restaurant, and of the restaurants of words after a context.
WORD_DISCOUNT, CONTEXT_DISCOUNT = 0.7, 0.75
#: Bytes of texts that are cut into words at once.
BLOCK_BYTES = 1 << 18
SWEEPS = 2
SAMPLES = 3
#: The ways to seat up to so many customers come from a table.
SMALL = 256
#: So few tables have their ways summed exactly; so many numbers of tables are tried otherwise.
FEW, GRID = 64, 41
#: Large dishes that are drawn at once, and words that are seated at once.
TOGETHER, SEATED = 4096, 50_000
ROUNDS = 2
#: Byte sequences that a task seats together, on average; all with the same two last context bytes.
GROUP_ROWS = 40_000
#: Rows of the scoring tables in a block; about 100 bytes of a Python worker's memory for each.
BLOCK_ROWS = 1_000_000
#: Bytes whose sequences are sorted at once.
CHUNK = 1 << 21
#: The bit from which on a number names its chunk, and of a chunk's number the bits that count it within its part.
CHUNK_BITS, IN_PART = 28, 12
#: Tokens whose words a part sends together.
TOKENS = 4_000_000
#: Bytes of a task's share of a join's smaller side, up to which it is hashed.
HASHED = "64m"
#: Words of a chunk that are handed to the executor at once.
SLICE = 20_000
#: Pairs are counted, seated and looked up, and chunks sent their answers, in so many shares, one after the other; the last
#: in so many pieces each.
SHARES, DEALT = 3, 3
#: Pairs are dealt to so many buckets at most.
MOST_BUCKETS = 4096
#: A chunk has at most so many documents, so that two bytes tell which.
PLACES = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased words and the end."""
    return [*text.encode().lower().split(), END] if text else [END]


def stream(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys (ORDER bytes, big-endian) of all bytes of the words, each with a final space, and
    where each word begins. The context begins with ends."""
    lead = END * (ORDER - 1)
    data = np.frombuffer(lead + (b" " + lead).join(words) + b" ", np.uint8).astype(np.uint64)
    keys = np.zeros(len(data) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        keys |= data[i : len(data) - ORDER + 1 + i] << np.uint64(8 * (ORDER - 1 - i))
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    places = np.arange(lengths.sum()) + np.repeat(np.arange(len(words)) * (ORDER - 1), lengths)
    return keys[places], starts


# ---- seating -------------------------------------------------------------------------------------


@lru_cache(maxsize=8)
def _log_stirling(d: float) -> np.ndarray:
    """log S(n, t) for n and t up to SMALL: the weights of all ways to seat n customers at t tables."""
    out = np.full((SMALL + 1, SMALL + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, SMALL + 1)
    with np.errstate(divide="ignore"):
        for n in range(SMALL):
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], out[n, 1:] + np.log(np.maximum(n - d * t, 0)))
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers: Stirling's series, from 8 upwards."""
    x = np.asarray(x, float)
    low = np.zeros_like(x)
    for i in range(8):
        low += np.where(x < 8, np.log(np.maximum(x + i, 1e-300)), 0)
    y = np.where(x < 8, x + 8, x)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - low


@lru_cache(maxsize=8)
def _few(d: float) -> np.ndarray:
    """Factors of Gamma(n - k d) / Gamma(n), k from 1, in the weights of n customers at t tables, t from 1."""
    out = np.zeros((FEW, FEW))
    for t in range(1, FEW + 1):
        for k in range(1, t + 1):
            pole = abs(k * d - round(k * d)) < 1e-12
            out[t - 1, k - 1] = 0 if pole else (-1) ** k * math.comb(t, k) / math.gamma(-k * d)
    return out


def _picked(logs: np.ndarray, random_: np.random.Generator) -> np.ndarray:
    """For each row a column, drawn by these log weights."""
    weights = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
    return ((random_.random(len(logs)) * weights[:, -1])[:, None] > weights).sum(axis=1)


def _log_ways(n: np.ndarray, t: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """log S(n, t) for many customers at many tables, but for a term of n alone, and its slope in t but
    for -log t: by the saddle point of the generating function, ((1 - (1 - z)^d) / d)^t / t!."""
    ratio = np.maximum(n / t, 1 + 1e-9)
    # h(u) = d (1 - u) u^(d - 1) / (1 - u^d) is n / t, where u = 1 - z; it falls from infinity to 1.
    low, high = np.full(ratio.shape, -700.0), np.full(ratio.shape, -1e-12)
    u = np.log(np.clip((d / ratio) ** (1 / (1 - d)), 1e-300, 1 - 1e-9))
    for _ in range(30):
        e = np.exp(u)
        power = np.exp(d * u)
        h = np.log(d) + np.log1p(-e) + (d - 1) * u - np.log1p(-power)
        gap = h - np.log(ratio)
        low, high = np.where(gap > 0, u, low), np.where(gap > 0, high, u)
        slope = -e / (1 - e) + (d - 1) + d * power / (1 - power)
        step = u - gap / np.minimum(slope, -1e-12)
        inside = (step > low) & (step < high)
        last, u = u, np.where(inside, step, (low + high) / 2)
        if np.abs(u - last).max() < 1e-10:
            break
    e = np.exp(u)
    log_f = np.log1p(-np.exp(d * u))
    # A sixth makes Stirling's formula, which this is where nearly all sit alone, right down to none.
    spread = np.maximum(t * ratio * (1 + (1 - d) * (1 - e) / e - ratio), 1e-12)
    return t * log_f - n * np.log1p(-e) - 0.5 * np.log(spread + 1 / 6) - t * np.log(d) - _log_gamma(t + 1.0), log_f - np.log(d)


def small_tables(customers: np.ndarray, new: np.ndarray, d: float, random_: np.random.Generator) -> np.ndarray:
    """Numbers of tables of dishes, each drawn from its distribution given its customers and the weight
    `new` of a new table. Up to SMALL customers the ways to seat them come from a table. Of more, if
    few tables are likely, from the exact sum for up to FEW tables; else from the saddle point, at
    GRID numbers about the likeliest, and between them by the line through their distribution."""
    out = np.minimum(customers, 1).astype(np.int64)
    log_new = np.log(np.maximum(new, 1e-300))
    many = np.flatnonzero((customers > 1) & (customers <= SMALL))
    for n in np.unique(customers[many]):
        of = many[customers[many] == n]
        out[of] = 1 + _picked(_log_stirling(d)[n, 1 : n + 1] + np.arange(1, n + 1) * log_new[of, None], random_)
    large = np.flatnonzero(customers > SMALL)
    for at in range(0, len(large), TOGETHER):
        of = large[at : at + TOGETHER]
        out[of] = _large_tables(customers[of].astype(float), log_new[of], d, random_)
    return out


def _large_tables(n: np.ndarray, log_new: np.ndarray, d: float, random_: np.random.Generator) -> np.ndarray:
    """Where the weights' slope in the number of tables, log new - log t + its own part, is nought, they are greatest."""
    low, high = np.full(len(n), 0.5), n - 0.5
    for _ in range(50):
        middle = np.sqrt(low * high)
        rising = log_new + _log_ways(n, middle, d)[1] > np.log(middle + 0.5)
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
        if (high - low).max() < 0.25:
            break
    mode = (low + high) / 2
    out = np.zeros(len(n), np.int64)
    few = mode < FEW / 3
    if few.any():
        t = np.arange(1, FEW + 1)
        log_ratio = _log_gamma(n[few, None] - t * d) - _log_gamma(n[few])[:, None]
        ways = np.exp(log_ratio - log_ratio[:, :1]) @ _few(d).T
        logs = np.log(np.maximum(ways, 1e-300)) - t * np.log(d) - _log_gamma(t + 1.0) + t * log_new[few, None]
        out[few] = 1 + _picked(logs, random_)
    rest = np.flatnonzero(~few)
    if len(rest):
        n, mode, log_new = n[rest], mode[rest], log_new[rest]
        slopes = [log_new + _log_ways(n, t, d)[1] - np.log(t + 0.5) for t in (mode * 0.98, mode * 1.02)]
        spread = 1 / np.sqrt(np.maximum((slopes[0] - slopes[1]) / (0.04 * mode), 1e-12))
        step = np.maximum(1.0, 12 * spread / GRID)
        t = np.clip(np.rint(mode)[:, None] + np.rint(step[:, None] * (np.arange(GRID) - GRID // 2)), 1, n[:, None])
        logs = _log_ways(np.repeat(n, GRID), t.ravel(), d)[0].reshape(t.shape) + t * log_new[:, None]
        logs[:, 1:][t[:, 1:] == t[:, :-1]] = -np.inf
        weights = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        place = random_.random(len(n)) * weights[:, -1]
        column = np.minimum((place[:, None] > weights).sum(axis=1), GRID - 1)
        own = np.take_along_axis(t, column[:, None], 1)[:, 0]
        # A number of the grid stands for the step about it.
        out[rest] = np.clip(np.rint(own + np.where(step > 1, (random_.random(len(n)) - 0.5) * step, 0)), 1, n)
    return out


class Level:
    """The dishes of the restaurants of one level: keys are context and dish, dishes of a context lie together."""

    def __init__(self, keys: np.ndarray, discount: float):
        self.keys, self.discount = keys, discount
        self.contexts, self.of = np.unique(keys >> np.uint64(8), return_inverse=True)
        self.customers = np.zeros(len(keys), np.int64)
        self.n_tables = np.zeros(len(keys), np.int64)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.contexts)
        return np.bincount(self.of, self.customers, n), np.bincount(self.of, self.n_tables, n)

    def back_off(self) -> np.ndarray:
        customers, tables = self.totals()
        return (STRENGTH + self.discount * tables) / (STRENGTH + customers)

    def predict(self, parent: np.ndarray) -> np.ndarray:
        customers, tables = self.totals()
        new = (STRENGTH + self.discount * tables)[self.of] * parent
        return (self.customers - self.discount * self.n_tables + new) / (STRENGTH + customers)[self.of]

    def seat(self, customers: np.ndarray, parent: np.ndarray, random_: np.random.Generator) -> None:
        """Seat so many customers of each dish anew."""
        _, tables = self.totals()
        self.n_tables = small_tables(customers, (STRENGTH + self.discount * tables)[self.of] * parent, self.discount, random_)
        self.customers = customers.astype(np.int64)


class Chain:
    """Levels below a fixed base. keys[0] are the lowest level's; each next level drops the first byte."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, widths: list[int], discounts: list[float], base, seed: int):
        self.counts, self.base = counts, base
        self.random = np.random.default_rng(seed)
        self.levels, self.up = [Level(keys, discounts[0])], []
        for width, discount in zip(widths[1:], discounts[1:], strict=True):
            above, place = np.unique(self.levels[-1].keys & np.uint64((1 << 8 * width) - 1), return_inverse=True)
            self.up.append(place)
            self.levels.append(Level(above, discount))

    def parents(self) -> list[np.ndarray]:
        """For each level the parent's prediction of its dishes."""
        out = [self.base(self.levels[-1].keys)]
        for level, place in zip(self.levels[:0:-1], self.up[::-1], strict=True):
            out.append(level.predict(out[-1])[place])
        return out[::-1]

    def sweep(self) -> None:
        parents = self.parents()
        customers = self.counts
        for i, level in enumerate(self.levels):
            level.seat(customers, parents[i], self.random)
            if i < len(self.up):
                customers = np.bincount(self.up[i], level.n_tables, len(self.levels[i + 1].keys)).astype(np.int64)

    def predictions(self) -> list[np.ndarray]:
        return [level.predict(parent) for level, parent in zip(self.levels, self.parents(), strict=True)]


def seat_group(keys: np.ndarray, counts: np.ndarray, top: np.ndarray, samples: int) -> tuple[Chain, list[list[np.ndarray]], list[list[np.ndarray]]]:
    """The chain of a group of restaurants, and its predictions and back-off weights, by sample and level."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    chain = Chain(keys, counts, [5, 4, 3], list(DISCOUNT[:1:-1]), lambda k: top[(k >> np.uint64(8) & np.uint64(255)).astype(int), (k & np.uint64(255)).astype(int)], int(keys[0] & np.uint64(0xFFFFFF)))
    predictions, weights = [], []
    for turn in range(SWEEPS + samples):
        chain.sweep()
        if turn >= SWEEPS:
            predictions.append(chain.predictions())
            weights.append([level.back_off() for level in chain.levels])
    return chain, predictions, weights


def seat_top(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """P(dish | byte before) for all pairs of bytes, averaged over seatings of the two top levels."""
    if not len(keys):
        return np.full((256, 256), 1 / 256)
    chain = Chain(keys, counts, [2, 1], [DISCOUNT[1], DISCOUNT[0]], lambda k: np.full(len(k), 1 / 256), 1)
    out = np.zeros((256, 256))
    for turn in range(SWEEPS + SAMPLES):
        chain.sweep()
        if turn < SWEEPS:
            continue
        low, root = chain.levels
        weight = float(root.back_off()[0])
        first = np.full(256, weight / 256)
        first[root.keys.astype(int)] = root.predict(np.full(len(root.keys), 1 / 256))
        table = np.tile(first, (256, 1))
        table[low.contexts.astype(int)] *= low.back_off()[:, None]
        place = (low.keys >> np.uint64(8)).astype(int), (low.keys & np.uint64(255)).astype(int)
        table[place] = low.predict(first[place[1]])
        out += table / SAMPLES
    return out


# ---- fitting -------------------------------------------------------------------------------------


def _parts(rows: int, most: int = CHUNK) -> Iterator[slice]:
    for at in range(0, rows, most):
        yield slice(at, at + most)


def sequences(words: DataFrame) -> DataFrame:
    """key (ORDER bytes as a long) and n, over all rows (word, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            spelt, times = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for part in _parts(len(spelt)):
                keys, starts = stream(spelt[part])
                held.append((keys, np.repeat(times[part], np.diff(np.append(starts, len(keys))))))
                size += len(keys)
                if size > CHUNK:
                    held = [_added(held)]
                    size = len(held[0][0])
                    if size > CHUNK // 2:
                        yield _counted(*held.pop())
                        size = 0
        if held:
            yield _counted(*_added(held))

    return mapped(words.select("word", "n"), count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["key", "n"])


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows["key"].to_numpy().astype(np.int64).view(np.uint64), rows["n"].to_numpy().astype(np.int64)


MODEL = "block int, kind int, key long, " + ", ".join(f"p{i} float" for i in range(SAMPLES))


def fit(words: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The spelling tables of words, seated n times each, and the top prediction.

    Tables: kind is the level's order (5, 4, 3) for predictions and minus it for back-off weights;
    block is the last two context bytes. Without words there are no rows.
    """
    counted = written(sequences(words), "sequences")
    together = 1 + counted.count() // GROUP_ROWS
    group = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(together))
    top = np.full((256, 256), 1 / 256)
    for _ in range(ROUNDS - 1):
        seen = top

        def lift(rows: pa.Table, seen: np.ndarray = seen) -> pa.Table:
            chain, _, _ = seat_group(*_columns(rows), seen, 0)
            upper = chain.levels[-1]
            return pa.table({"key": (upper.keys & np.uint64(0xFFFF)).view(np.int64), "n": upper.n_tables})

        lifted = counted.groupBy(group.alias("g")).applyInArrow(lambda rows: lift(rows), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        rows = sorted((r["key"], r["n"]) for r in lifted.collect())  # 65,536 at most
        top = seat_top(np.array([k for k, _ in rows], np.uint64), np.array([n for _, n in rows], np.int64))
    last = top

    def tables(rows: pa.Table) -> pa.Table:
        chain, predictions, weights = seat_group(*_columns(rows), last, SAMPLES)
        out = []
        for i, level in enumerate(chain.levels):
            kind = ORDER - i
            for sign, keys, values in ((1, level.keys, predictions), (-1, level.contexts, weights)):
                block = (keys >> np.uint64(8 if sign > 0 else 0)) & np.uint64(0xFFFF)
                columns = {"block": block.astype(np.int32), "kind": np.full(len(keys), sign * kind, np.int32), "key": keys.view(np.int64)}
                out.append(pa.table(columns | {f"p{s}": values[s][i].astype(np.float32) for s in range(SAMPLES)}))
        return pa.concat_tables(out)

    model = written(counted.groupBy(group.alias("g")).applyInArrow(tables, MODEL), "model")
    forget(counted)
    return model, top


# ---- scoring -------------------------------------------------------------------------------------


class Lookup:
    """From sorted distinct keys to their places, by hash tables of falling size without chains."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        self.tables = []
        left = np.arange(len(keys))
        while len(left):
            bits = max(4, int(4 * len(left)).bit_length())
            slots = (keys[left] * self.MIX) >> np.uint64(64 - bits)
            _, first = np.unique(slots, return_index=True)
            place = np.full(1 << bits, -1, np.int32)
            place[slots[first]] = left[first]
            self.tables.append((np.uint64(64 - bits), place))
            left = np.delete(left, first)
        self.keys = np.append(keys, np.uint64(2**64 - 1))  # -1 finds a key that no text has

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out = np.full(len(wanted), -1, np.int32)
        left = None
        for shift, place in self.tables:
            now = wanted if left is None else wanted[left]
            at = place[(now * self.MIX) >> shift]
            hit = self.keys[at] == now
            if left is None:
                out[hit] = at[hit]
                left = np.flatnonzero(~hit & (at >= 0))
            else:
                out[left[hit]] = at[hit]
                left = left[~hit & (at >= 0)]
            if not len(left):
                break
        return out


@dataclass
class Tables:
    """A block of the scoring tables: by kind, sorted keys and their values; the two last context bytes it holds."""

    kinds: dict[int, tuple[np.ndarray, np.ndarray]]
    top: np.ndarray
    bytes_held: np.ndarray

    def prepare(self) -> None:
        if not hasattr(self, "find"):
            self.find = {k: Lookup(keys) for k, (keys, _) in self.kinds.items()}
            self.logs = np.log10(self.kinds[ORDER][1]) if ORDER in self.kinds else None

    def _values(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.kinds:
            return np.zeros(len(keys), bool), np.zeros((len(keys), SAMPLES), np.float32)
        at = self.find[kind](keys)
        return at >= 0, self.kinds[kind][1][at]

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """For each seating log10 P of each key's last byte after the bytes before it; zero for keys of other blocks."""
        self.prepare()
        out = np.zeros((len(keys), SAMPLES))
        here = self.bytes_held[(keys >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.uint16)]
        if self.logs is None:
            unseen = here
        else:
            at = self.find[ORDER](keys)
            seen = here & (at >= 0)
            out[seen] = self.logs[at[seen]]
            unseen = here & (at < 0)
        rest = np.flatnonzero(unseen)
        if len(rest):
            out[rest] = np.log10(self._backed_off(keys[rest], ORDER))
        return out

    def _backed_off(self, keys: np.ndarray, kind: int) -> np.ndarray:
        if kind == 2:
            return np.repeat(self.top[(keys >> np.uint64(8)).astype(int), (keys & np.uint64(255)).astype(int)][:, None], SAMPLES, axis=1)
        seen, value = self._values(kind, keys)
        known, weight = self._values(-kind, keys >> np.uint64(8))
        out = value.astype(float)
        rest = np.flatnonzero(~seen)
        if len(rest):
            lower = self._backed_off(keys[rest] & np.uint64((1 << 8 * (kind - 1)) - 1), kind - 1)
            out[rest] = np.where(known[rest, None], weight[rest], 1.0) * lower
        return out


def blocks_of(model: DataFrame, top: np.ndarray, block_rows: int) -> Iterator[Tables]:
    """The scoring tables in blocks of at most block_rows; the least block is that of two context
    bytes, which the alphabet bounds."""
    sizes = {r["block"]: r["n"] for r in model.groupBy("block").agg(F.count("*").alias("n")).collect()}  # 65,536 at most
    groups: list[list[int]] = [[]]
    used = 0
    for b in range(1 << 16):
        n = sizes.get(b, 0)
        if groups[-1] and used + n > block_rows:
            groups.append([])
            used = 0
        groups[-1].append(b)
        used += n
    for group in groups:
        part = model.filter(F.col("block").between(group[0], group[-1])).select("kind", "key", *[f"p{i}" for i in range(SAMPLES)]).toArrow()
        kind = part["kind"].to_numpy()
        keys = part["key"].to_numpy().astype(np.int64).view(np.uint64)
        values = np.column_stack([part[f"p{i}"].to_numpy() for i in range(SAMPLES)]).astype(np.float32) if len(kind) else np.zeros((0, SAMPLES), np.float32)
        kinds = {}
        for k in np.unique(kind):
            of = np.flatnonzero(kind == k)
            of = of[np.argsort(keys[of])]
            kinds[int(k)] = (keys[of], values[of])
        held = np.zeros(1 << 16, bool)
        held[group] = True
        yield Tables(kinds, top, held)


def spelt(words: DataFrame, model: DataFrame, top: np.ndarray, block_rows: int) -> DataFrame:
    """words with `spelling`: for each seating the log10 probability that the byte restaurants give it."""
    out, before = words.withColumn("spelling", F.array(*[F.lit(0.0)] * SAMPLES)), None
    blocks = blocks_of(model, top, block_rows)
    now = next(blocks)
    for following in blocks:
        out = written(_spell(out, now), "spelt", "zstd")
        if before is not None:
            forget(before)
        before, now = out, following
    return _spell(out, now)


def _spell(words: DataFrame, block: Tables) -> DataFrame:
    """A block's part of the spelling added."""
    shared = words.sparkSession.sparkContext.broadcast(block)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, SEATED // 5):
            if batch.num_rows:
                keys, starts = stream(batch.column("word").to_pylist())
                spelling = batch.column("spelling").flatten().to_numpy().reshape(-1, SAMPLES) + np.add.reduceat(shared.value.log10(keys), starts)
                yield batch.set_column(batch.schema.get_field_index("spelling"), "spelling", _lists(spelling))

    return mapped(words, spell, words.schema)


def _lists(values: np.ndarray) -> pa.Array:
    kind = pa.from_numpy_dtype(values.dtype)
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(kind))


def _binaries(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Rows of data, each from one edge to the next, as bytes."""
    offsets = pa.array((data.itemsize * edges).astype(np.int32)).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _edges(column: pa.Array) -> np.ndarray:
    """Where the bytes of each row of a binary column begin, and where the last ends."""
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]


def _unbound(column: pa.Array, kind) -> np.ndarray:
    """All values of a binary column without nulls, in one array."""
    if not len(column):
        return np.zeros(0, kind)
    edges, data = _edges(column), column.buffers()[2]
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].view(kind) if data is not None and edges[-1] > edges[0] else np.zeros(0, kind)


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many, but for the last."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# ---- words in their contexts -----------------------------------------------------------------------

SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ODD and of its inverse."""
    out = []
    for factor in (ODD, pow(ODD, -1, 1 << 64)):
        steps = np.full(size, factor, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return tuple(out)


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, a polynomial of its bytes, and where it starts and ends."""
    text = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], SPACE[text], [True]])
    start, end = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    powers, inverse = _powers(max(2 * BLOCK_BYTES, 1 << len(text).bit_length()))
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text + np.uint64(1)) * inverse[: len(text)], out=sums[1:])
    values = (sums[end] - sums[start]) * powers[start]
    values ^= values >> np.uint64(29)
    return values * np.uint64(ODD), start.astype(np.int32), end.astype(np.int32)


#: No word of a text has this hash but by chance, as no word has this byte.
END_HASH = np.uint64((END[0] + 1) * ODD & (1 << 64) - 1)


def _blocks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts, A-Z lower-cased, some at a time: about BLOCK_BYTES, or a single longer one."""
    held, size = [], 0
    for text in texts:
        held.append(text.encode().lower() if text else b"")
        size += len(held[-1]) + 1
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


class Chunk:
    """The tokens of some documents: their hashes, and where their bytes are. Within a chunk, words are
    told apart by their 64-bit hashes; beyond it, by their bytes."""

    def __init__(self) -> None:
        self.hashes, self.starts, self.lengths, self.data = [], [], [], []
        self.sizes, self.training = [], []
        self.tokens = self.bytes = self.places = 0
        self.found = np.zeros(0, np.uint64)  # the hashes of the distinct words

    def add(self, texts: list[bytes], training: np.ndarray) -> np.ndarray:
        """The number of tokens of each text."""
        data = b" ".join(texts)
        values, start, end = hashed_words(data)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        of = np.searchsorted(begins, start, "right") - 1
        sizes = np.bincount(of, minlength=len(texts)) + 1
        at = np.arange(len(values)) + of  # an end follows each text's words
        hashes, starts, lengths = np.full(len(values) + len(texts), END_HASH), np.full(len(values) + len(texts), -1, np.int32), np.zeros(len(values) + len(texts), np.int32)
        hashes[at], starts[at], lengths[at] = values, start + np.int32(self.bytes), end - start
        for held, new in ((self.hashes, hashes), (self.starts, starts), (self.lengths, lengths), (self.data, data), (self.sizes, sizes), (self.training, training)):
            held.append(new)
        self.tokens += len(hashes)
        self.bytes += len(data)
        self.places += len(texts)
        return sizes

    def words(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct words, and of each token the number of its word. What the chunk held of them is let go."""
        codes, found = pd.factorize(_taken(self.hashes))
        codes, n, self.found = codes.astype(np.int32), len(found), found
        first = np.empty(n, np.int32)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1, dtype=np.int32)
        start, length = _taken(self.starts)[first], _taken(self.lengths)[first]
        data = b"".join(self.data)
        self.data.clear()
        return [data[a : a + n] if a >= 0 else END for a, n in zip(start.tolist(), length.tolist(), strict=True)], codes


def _taken(held: list[np.ndarray]) -> np.ndarray:
    """All in one array; the list is emptied."""
    out = np.concatenate(held)
    held.clear()
    return out


def word_rows(documents: DataFrame, key: str, tokens: int = TOKENS) -> DataFrame:
    """A row for each document - chunk, place there, doc_id, n_tokens, held_out - and for each word of a
    chunk: word, at (its chunk and number there), n (its training tokens there), classes (the contexts
    that it has there: hashes of the words before it, in eight bytes), seen and times (how often in each,
    in training texts and in all), refs (the place of each occurrence, context by context)."""
    kind = documents.schema[key].dataType
    binary = [T.StructField(n, T.BinaryType()) for n in ("classes", "seen", "times", "refs")]
    fields = [("chunk", T.LongType()), ("place", T.IntegerType()), ("doc_id", kind), ("n_tokens", T.LongType()), ("held_out", T.BooleanType()), ("word", T.BinaryType()), ("at", T.LongType()), ("n", T.LongType())]
    schema = T.StructType([*(T.StructField(n, k) for n, k in fields), *binary])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk, kind = TaskContext.get().partitionId() << IN_PART, Chunk(), None
        for batch in batches:
            kind = batch.schema.field(key).type
            held = np.array(batch.column("held_out").to_pylist(), bool)
            at = 0
            for texts in _blocks(batch.column("text").to_pylist()):
                n = len(texts)
                if chunk.tokens >= tokens or chunk.places + n > PLACES:
                    yield from _sliced(_word_rows(chunk, number << CHUNK_BITS, kind))
                    chunk, number = Chunk(), number + 1
                place = chunk.places
                sizes = chunk.add(texts, ~held[at : at + n])
                columns = {"chunk": np.full(n, number), "place": np.arange(place, place + n, dtype=np.int32), "n_tokens": sizes, "held_out": held[at : at + n]}
                yield _rows(n, {c: pa.array(v) for c, v in columns.items()} | {"doc_id": batch.column(key).slice(at, n)}, kind)
                at += n
        if chunk.tokens:
            yield from _sliced(_word_rows(chunk, number << CHUNK_BITS, kind))

    return mapped(documents.select(key, "text", "held_out"), split, schema)


def _sliced(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows, some at a time: the executor holds what it is given at once."""
    for at in range(0, rows.num_rows, SLICE):
        yield rows.slice(at, SLICE)


def _rows(n: int, columns: dict, kind) -> pa.RecordBatch:
    kinds = {"chunk": pa.int64(), "place": pa.int32(), "doc_id": kind, "n_tokens": pa.int64(), "held_out": pa.bool_(), "word": pa.binary(), "at": pa.int64(), "n": pa.int64()} | dict.fromkeys(("classes", "seen", "times", "refs"), pa.binary())
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))


def _word_rows(chunk: Chunk, first: int, kind) -> pa.RecordBatch:
    words, ids = chunk.words()
    n, sizes = len(words), np.concatenate(chunk.sizes)
    bits = n.bit_length()
    pair = np.empty(len(ids), np.int64)  # a token's word and the one before it
    pair[1:] = ids[:-1]
    pair[np.cumsum(sizes) - sizes] = ids[sizes[0] - 1]  # a text begins after an end
    pair |= ids.astype(np.int64) << bits
    del ids
    place = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    if 2 * bits + 16 < 64:
        pair = pair << 16 | place
        pair.sort()
        place = (pair & 0xFFFF).astype(np.uint16)
        pair >>= 16
    else:
        order = np.lexsort((place, pair))
        pair, place = pair[order], place[order]
        del order
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    size, pair = len(pair), pair[start]
    word = pair >> bits
    edges = np.searchsorted(word, np.arange(n + 1))
    classes = chunk.found[pair & ((1 << bits) - 1)]
    del word, pair
    seen = np.add.reduceat(np.concatenate(chunk.training)[place], start, dtype=np.uint32)
    start = np.append(start, size)
    times = np.diff(start).astype(np.uint32)
    columns = {"at": pa.array(np.arange(first, first + n)), "word": pa.array(words, pa.binary())}
    columns["n"] = pa.array(np.add.reduceat(seen, edges[:-1], dtype=np.int64))
    columns |= {"classes": _binaries(classes, edges), "seen": _binaries(seen, edges), "times": _binaries(times, edges)}
    columns["refs"] = _binaries(place, start[edges])
    return _rows(n, columns, kind)


def _contexts(column: pa.Array, n: int) -> np.ndarray:
    """n contexts of a binary column, as long as they are: one to eight bytes each."""
    return _unbound(column, f"<u{len(_unbound(column, np.uint8)) // n if n else 8}").astype(np.uint64).view(np.int64)


#: Rows of arrays, packed by whom they are for: a chunk, or a bucket of pairs.
ANSWERS = "chunk long, kind int, at long, a binary, b binary, c binary, d binary"


def _by_chunk(chunks: np.ndarray, kind: int, *parts: np.ndarray, at: int = 0) -> pa.RecordBatch:
    """Rows of arrays, those of a chunk packed together."""
    order = np.argsort(chunks, kind="stable")
    found, start = np.unique(chunks[order], return_index=True)
    edges = np.append(start, len(chunks))
    return _packed_rows(found, kind, *[_binaries(part[order].ravel(), edges * (part.size // max(1, len(part)))) for part in parts], at=at)


def _packed_rows(found: np.ndarray, kind: int, *columns: pa.Array, at: int = 0) -> pa.RecordBatch:
    nulls = [pa.nulls(len(found), pa.binary())] * (4 - len(columns))
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(np.full(len(found), kind, np.int32)), pa.array(np.full(len(found), at, np.int64)), *columns, *nulls], ["chunk", "kind", "at", *"abcd"])


def _runs(buckets: np.ndarray, w: np.ndarray, context: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Pairs packed by bucket: words, how many pairs each has, contexts and counts. Pairs of a word lie together."""
    order = np.argsort(buckets, kind="stable")
    buckets, w = buckets[order], w[order]
    first = np.diff(buckets, prepend=-1) != 0
    start = np.flatnonzero(first)
    head = np.flatnonzero(first | (np.diff(w, prepend=0) != 0))
    edges, of_runs = np.append(start, len(w)), np.append(np.searchsorted(head, start), len(head))
    sizes = np.diff(np.append(head, len(w))).astype(np.uint32)
    return _packed_rows(buckets[start], 0, _binaries(w[head], of_runs), _binaries(sizes, of_runs), _binaries(context[order], edges), _binaries(n[order].astype(np.int64), edges))


def _pairs(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """w, context and n of all pairs of rows that _runs() has made."""
    w, sizes, context, n = (_unbound(_one(rows.column(c)), k) for c, k in zip("abcd", (np.int64, np.uint32, np.int64, np.int64), strict=True))
    return np.repeat(w, sizes), context, n


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """For each chunk (or bucket) all of its rows, which are one after the other."""
    last, held = -1, []
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        start = np.flatnonzero(np.diff(chunks, prepend=-1)).tolist()
        for lo, hi in zip(start, [*start[1:], len(chunks)], strict=True):
            if held and chunks[lo] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(chunks[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield last, pa.Table.from_batches(held)


@dataclass
class Buckets:
    """Pairs are dealt by their words to `words` buckets, and each of these by their contexts to `contexts`, so that
    no frequent word gathers its pairs."""

    words: int
    contexts: int

    @classmethod
    def of(cls, df: DataFrame) -> Buckets:
        """Some for each shuffle partition of the session."""
        n = min(MOST_BUCKETS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        contexts = 1 << n.bit_length() // 2
        return cls(max(1, n // contexts), contexts)

    def __call__(self, w: np.ndarray, context: np.ndarray) -> np.ndarray:
        of_word = (w.view(np.uint64) >> np.uint64(33)) % np.uint64(self.words)
        of_context = (context.view(np.uint64) * np.uint64(ODD) >> np.uint64(44)) % np.uint64(self.contexts)
        return (of_word * np.uint64(self.contexts) + of_context).astype(np.int16)

    def share(self) -> Column:
        """The share of a word, by its column w."""
        return F.pmod(F.pmod(F.shiftrightunsigned("w", 33), F.lit(self.words)), F.lit(SHARES))

    def own(self, share: int) -> Column:
        """The rows of _runs() that are of a share."""
        return F.pmod(F.floor(F.col("chunk") / self.contexts), F.lit(SHARES)) == share


def _keys(w: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair; no two pairs of a word, or of a context, have the same."""
    x = context.view(np.uint64) * np.uint64(ODD)
    x ^= x >> np.uint64(32)
    x += w.view(np.uint64)
    x *= np.uint64(ODD)
    return x ^ x >> np.uint64(29)


def _repeated(batch: pa.RecordBatch, counts: str, size: int, *columns: str) -> list[np.ndarray]:
    """Columns of words, for each of their pairs."""
    sizes = np.diff(_edges(batch.column(counts))) // size
    return [np.repeat(batch.column(c).to_numpy(), sizes) for c in columns]


def pairs_of(words: DataFrame, counts: str, kind: str, share: int | None = None) -> DataFrame:
    """All pairs with a count, over all rows (word, classes, counts) or those of a share, each once with
    the sum of its counts: a row for each bucket, packed by _runs()."""
    bucket = Buckets.of(words)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, SEATED):
            n = _unbound(batch.column(counts), kind).astype(np.int64)
            context, some = _contexts(batch.column("classes"), len(n)), n > 0
            (w,) = _repeated(batch, counts, np.dtype(kind).itemsize, "w")
            w, context = w[some], context[some]
            if len(w):
                yield _runs(bucket(w, context), w, context, n[some])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, rows in _groups(batches):
            w, context, n = _pairs(rows)
            keys = _keys(w, context)
            order = np.argsort(keys)
            start = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
            first, n = order[start], np.add.reduceat(n[order], start)
            by_word = np.lexsort((context[first], w[first]))
            first, n = first[by_word], n[by_word]
            yield _runs(np.full(len(n), own), w[first], context[first], n)

    rows = words.select(F.xxhash64("word").alias("w"), "classes", counts)
    dealt = mapped(rows if share is None else rows.filter(bucket.share() == share), deal, ANSWERS)
    return mapped(dealt.repartition("chunk").sortWithinPartitions("chunk"), count, ANSWERS)


def flat(pairs: DataFrame, kind: str) -> DataFrame:
    """Rows of what pairs_of() packs: `often`, context, w and n of the pairs seen more than once; `once`, w and
    how many of its pairs are seen once, and `contexts`, context, customers, singles and dishes, both by bucket."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, context, n = _pairs(batch)
            for part in _parts(len(of := np.flatnonzero(n > 1)), SEATED):
                yield pa.RecordBatch.from_arrays([pa.array(x[of[part]]) for x in (context, w, n)], ["context", "w", "n"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, _, n = _pairs(batch)
            found, times = np.unique(w[n == 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], ["w", "n"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, context, n = _pairs(batch)
            place, found = pd.factorize(context)
            sums = [np.bincount(place, x, len(found)).astype(np.int64) for x in (n, n == 1, np.ones(len(n)))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, *sums)], ["context", "customers", "singles", "dishes"])

    schemas = {"often": "context long, w long, n long", "once": "w long, n long", "contexts": "context long, customers long, singles long, dishes long"}
    return mapped(pairs, {"often": often, "once": once, "contexts": contexts}[kind], schemas[kind])


@dataclass
class Restaurants:
    """contexts: context, customers, singles (dishes of one customer) and tables (for each seating) of the
    context restaurants; rests: context, w and the customers less what their tables are discounted,
    averaged over the seatings, of pairs seen more than once; pairs: all, as pairs_of() has them; and, for each seating, the customers and tables of the word restaurant."""

    contexts: DataFrame
    rests: DataFrame | None
    pairs: DataFrame
    own: list[int]
    own_tables: list[int]

    @property
    def customers(self) -> pd.Series:
        """By context, brought to the driver: of small models."""
        return pd.Series({r["context"]: r["customers"] for r in self.contexts.select("context", "customers").collect()})


def first_seating(words: DataFrame, pairs: DataFrame) -> Restaurants:
    """Every dish at one table."""
    counted = flat(pairs, "contexts").groupBy("context").agg(F.sum("customers").alias("customers"), F.sum("singles").alias("singles"), F.array(F.sum("dishes")).alias("tables"))
    contexts = written(counted, "contexts", "zstd")
    tables = contexts.agg(F.coalesce(F.sum(F.get("tables", F.lit(0))), F.lit(0))).first()[0]
    return Restaurants(contexts, None, pairs, [tables], [words.filter("total > 0").count()])


def _whole(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many, each with all pairs of its words. A word's row (kind 0) is before its pairs."""
    held, size = [], 0
    for batch in batches:
        heads = np.flatnonzero(batch.column("kind").to_numpy() == 0)
        held.append(batch)
        size += batch.num_rows
        if size >= rows and len(heads):
            last = int(heads[-1])
            held[-1] = batch.slice(0, last)
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [batch.slice(last)], batch.num_rows - last
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def seated(words: DataFrame, pairs: DataFrame, at: Restaurants, samples: int) -> tuple[DataFrame, Restaurants]:
    """words (word, total, spelling) seated in their contexts and in the word restaurant, in so many
    seatings, given the first one of `at`: with `served` (its customers of the word restaurant) and
    `seats` (its tables there), for each seating; and what all tables sum to.

    Given what all sum to in the seating before, the words are independent. A word that is seen once
    after a context has one table there.
    """
    fields = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("served", "seats")]
    given = [T.StructField(n, words.schema[n].dataType) for n in ("word", "total", "spelling")]
    of_pair = [T.StructField("context", T.LongType()), T.StructField("w", T.LongType()), T.StructField("rest", T.FloatType()), T.StructField("held", T.ArrayType(T.LongType()))]
    schema = T.StructType([*given, *fields, *of_pair])
    kinds = [f.type for f in to_arrow_schema(schema)]
    own, own_tables, bucket = at.own[0], at.own_tables[0], Buckets.of(words)

    def seat(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
        random_ = np.random.default_rng([share, TaskContext.get().partitionId()])
        for batch in _whole(batches, SEATED):
            of_word = batch.column("kind").to_numpy() == 0
            heads, of = pa.array(np.flatnonzero(of_word)), pa.array(np.flatnonzero(~of_word))
            n, word = len(heads), (np.cumsum(of_word) - 1)[~of_word]
            singles, counts = (batch.column("n").take(x).to_numpy() for x in (heads, of))
            tables = batch.column("tables").take(of).to_numpy(zero_copy_only=False).astype(float)
            spelling = 10.0 ** batch.column("spelling").take(heads).flatten().to_numpy().reshape(-1, SAMPLES)
            served = singles + np.bincount(word, minlength=n)
            seats = np.minimum(served, 1)
            all_served, all_seats = np.zeros((n, samples), np.int64), np.zeros((n, samples), np.int64)
            all_held, rest = np.zeros((len(word), samples), np.int64), np.zeros(len(word))
            for turn in range(SWEEPS + samples - 1):
                s = max(0, turn - SWEEPS + 1)
                new = (STRENGTH + WORD_DISCOUNT * own_tables) * spelling[:, s]
                chance = (served - WORD_DISCOUNT * seats + new) / (STRENGTH + own)
                held = small_tables(counts, (STRENGTH + CONTEXT_DISCOUNT * tables) * chance[word], CONTEXT_DISCOUNT, random_)
                served = singles + np.bincount(word, held, n).astype(np.int64)
                seats = small_tables(served, new, WORD_DISCOUNT, random_)
                if turn >= SWEEPS - 1:
                    all_served[:, s], all_seats[:, s], all_held[:, s] = served, seats, held
                    rest += (counts - CONTEXT_DISCOUNT * held) / samples
            columns = [batch.column(c).take(heads) for c in ("word", "total", "spelling")]
            yield pa.RecordBatch.from_arrays([*columns, _lists(all_served), _lists(all_seats), *(pa.nulls(n, k) for k in kinds[5:])], schema.names)
            columns = [batch.column(c).take(of) for c in ("context", "w")]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(word), k) for k in kinds[:5]), *columns, pa.array(rest.astype(np.float32)), _lists(all_held)], schema.names)

    def none(name: str, kind) -> Column:
        return F.lit(None).cast(kind).alias(name)

    def of_share(share: int) -> DataFrame:
        of_pairs = pairs.filter(bucket.own(share))
        once = flat(of_pairs, "once").groupBy("w").agg(F.sum("n").alias("n"))
        heads = words.withColumn("w", F.xxhash64("word")).filter(bucket.share() == share).join(once, "w", "left")
        heads = heads.select("w", F.lit(0).alias("kind"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), none("context", "long"), none("tables", "long"), "word", "total", "spelling")
        often = flat(of_pairs, "often").join(at.contexts.select("context", F.get("tables", F.lit(0)).alias("tables")), "context")
        often = often.select("w", F.lit(1).alias("kind"), "n", "context", "tables", *[none(f.name, f.dataType) for f in given])
        rows = heads.unionByName(often).repartition("w").sortWithinPartitions("w", "kind")
        return written(mapped(rows, lambda batches: seat(batches, share), schema), "seated", "zstd")

    done = reduce(DataFrame.unionByName, [of_share(share) for share in range(SHARES)])
    turns = range(samples)
    sums = done.filter("word IS NOT NULL").agg(*[F.coalesce(F.sum(F.get(c, F.lit(s))), F.lit(0)) for c in ("served", "seats") for s in turns]).first()
    more = done.filter("word IS NULL")
    held = more.groupBy("context").agg(*[F.sum(F.get("held", F.lit(s))).alias(f"held{s}") for s in turns])
    tables = F.array(*[F.col("singles") + F.coalesce(f"held{s}", F.lit(0)) for s in turns])
    contexts = written(at.contexts.drop("tables").join(held, "context", "left").select("context", "customers", "singles", tables.alias("tables")), "contexts", "zstd")
    rests = more.select("context", "w", "rest")
    return done.filter("word IS NOT NULL").select("word", "total", "spelling", "served", "seats"), Restaurants(contexts, rests, pairs, list(sums[:samples]), list(sums[samples:]))


def _sums(words: DataFrame, known: DataFrame, at: Restaurants) -> DataFrame:
    """By document: sums over its words of count * log10(total + 1), of count * log10 P, and of the
    counts of words with a total. known: word, total, chances (P in the word restaurant, for each seating).

    A chunk is sent, in this order, its contexts (customers, and for each seating the weight of the word
    restaurant), its words' references, its words (total and chances), and its pairs that are known. A
    pair that the chunk itself has seen once (words may have `seen`) is answered only if others have seen
    it too. The tables behind at.rests and at.pairs are deleted.
    """
    if "seen" not in words.columns:
        words = words.withColumn("seen", F.lit(None).cast("binary"))
    mask, bucket = (1 << CHUNK_BITS) - 1, Buckets.of(words)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = -1, []

        def out() -> pa.RecordBatch:
            found = np.unique(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk)), pa.array(found)], ["chunk", "context"])

        for batch in _together(batches, SEATED):
            chunks = batch.column("at").to_numpy() >> CHUNK_BITS
            edges = _edges(batch.column("times")) // 4
            contexts = _contexts(batch.column("classes"), edges[-1] - edges[0])
            for own in np.unique(chunks).tolist():
                if own != chunk and held:
                    yield out()
                    held = []
                chunk = own
                held.append(np.unique(contexts[np.repeat(chunks, np.diff(edges)) == own]))
        if held:
            yield out()

    def of_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, SEATED):
            tables, customers = batch.column("tables").flatten().to_numpy().reshape(-1, SAMPLES), batch.column("customers").to_numpy().astype(float)
            weights = (STRENGTH + CONTEXT_DISCOUNT * tables) / (STRENGTH + customers)[:, None]
            yield _by_chunk(batch.column("chunk").to_numpy(), 0, batch.column("context").to_numpy(), np.column_stack([customers, weights]))

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, SEATED):
            number, chances = batch.column("at").to_numpy(), _unbound(batch.column("chances"), np.float32).reshape(-1, SAMPLES)
            yield _by_chunk(number >> CHUNK_BITS, 2, (number & mask).astype(np.uint32), batch.column("total").to_numpy(), chances)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, SEATED):
            chunks = batch.column("at").to_numpy() >> CHUNK_BITS
            start = np.flatnonzero(np.diff(chunks, prepend=-1)).tolist()
            for lo, hi in zip(start, [*start[1:], len(chunks)], strict=True):
                part = batch.slice(lo, hi - lo)
                edges = _edges(part.column("times")) // 4
                n = edges[-1] - edges[0]
                w, number = _repeated(part, "times", 4, "w", "at")
                column = np.arange(n, dtype=np.uint32) - np.repeat(edges[:-1] - edges[0], np.diff(edges)).astype(np.uint32)
                context = _contexts(part.column("classes"), n)
                once = _seen(part.column("seen"), n) == 1
                yield _by_chunk(bucket(w, context), 2, _keys(w, context), (number & mask).astype(np.uint32), column, once, at=int(chunks[lo]))

    def of_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, 4 * SEATED):
            w, context = batch.column("w").to_numpy(), batch.column("context").to_numpy()
            yield _by_chunk(bucket(w, context), 1, _keys(w, context), batch.column("rest").to_numpy())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            edges = np.searchsorted(rows["kind"].to_numpy(), range(4)).tolist()
            alone, more, asked = (rows.slice(lo, hi - lo) for lo, hi in zip(edges[:-1], edges[1:], strict=True))
            w, context, n = _pairs(alone)
            once = _keys(w, context)[n == 1]
            keys = np.concatenate([once, _unbound(_one(more["a"]), np.uint64)])
            rest = np.concatenate([np.full(len(once), 1 - CONTEXT_DISCOUNT, np.float32), _unbound(_one(more["b"]), np.float32)])
            order = np.argsort(keys)
            shared = (np.arange(len(keys)) >= len(once))[order]
            keys, rest = keys[order], rest[order]
            for batch in asked.to_batches() if len(keys) else ():
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    wanted, number, column, own = (_unbound(row.column(c), k) for c, k in zip("abcd", (np.uint64, np.uint32, np.int32, bool), strict=True))
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    some = np.flatnonzero((keys[place] == wanted) & (shared[place] | ~own))
                    if len(some):
                        yield _by_chunk(np.full(len(some), row.column("at")[0].as_py()), 3, number[some], column[some], rest[place[some]])

    def looked_up(share: int) -> DataFrame:
        # Written, so that what is dealt is gone before the next share is.
        own = bucket.share() == share
        asked = mapped(by_hash.filter(own).select("w", "at", "classes", "times", "seen"), ask, ANSWERS)
        rests = mapped(at.rests.filter(own), of_rests, ANSWERS)
        dealt = at.pairs.filter(bucket.own(share)).unionByName(rests).unionByName(asked)
        return written(mapped(dealt.repartition("chunk").sortWithinPartitions("chunk", "kind"), answer, ANSWERS), "answers", "zstd")

    # Where each task's share of a join's smaller side is seen to be small, it is hashed and nothing sorted.
    words.sparkSession.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED)
    by_hash = words.withColumn("w", F.xxhash64("word"))
    of_known = [looked_up(share) for share in range(SHARES)]
    forget(at.rests, at.pairs)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = -1, Answers()
        for batch in batches:
            chunks, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            start = np.flatnonzero((np.diff(chunks, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0)).tolist()
            for lo, hi in zip(start, [*start[1:], len(chunks)], strict=True):
                if chunks[lo] != chunk:
                    yield from _summed(chunk, held.sums())
                    chunk, held = int(chunks[lo]), Answers()
                held.add(int(kinds[lo]), batch.slice(lo, hi - lo))
        yield from _summed(chunk, held.sums())

    # The parts of the input, whose chunks have numbers that follow each other, in pieces: only a piece's files are read.
    parts, pieces = 1 + ((words.agg(F.max("at")).first()[0] or 0) >> CHUNK_BITS + IN_PART), SHARES * DEALT
    edges = [parts * i // pieces for i in range(pieces + 1)]

    def of(df: DataFrame, column: str, bits: int, lo: int, hi: int) -> DataFrame:
        return df.filter(F.col(column).between(edges[lo] << bits, (edges[hi] << bits) - 1))

    def met(share: int) -> DataFrame:
        """What the chunks of a share are sent of their contexts and words."""
        part = of(words, "at", CHUNK_BITS + IN_PART, share * DEALT, (share + 1) * DEALT)
        contexts = mapped(part.select("at", "classes", "times"), near, "chunk long, context long").join(at.contexts, "context")
        of_word = part.select("word", "at").join(known, "word").select("at", "total", "chances")
        sent = mapped(contexts.select("chunk", "context", "customers", "tables"), of_contexts, ANSWERS)
        return written(sent.unionByName(mapped(of_word, of_words, ANSWERS)), "met", "zstd")

    def summed(piece: int, *sent: DataFrame) -> DataFrame:
        part = of(words, "at", CHUNK_BITS + IN_PART, piece, piece + 1).withColumn("chunk", F.shiftright("at", CHUNK_BITS))
        own = part.select("chunk", F.lit(1).alias("kind"), "at", *[F.col(c).alias(x) for c, x in zip(("classes", "times", "refs", "seen"), "abcd", strict=True)])
        dealt = reduce(DataFrame.unionByName, [own, *(of(s, "chunk", IN_PART, piece, piece + 1) for s in sent)]).repartition("chunk")
        return written(mapped(dealt.sortWithinPartitions("chunk", "kind", "at"), add, "chunk long, place int, logs double, score double, known long"), "sums")

    out = []
    for share in range(SHARES):
        some = [i for i in range(share * DEALT, (share + 1) * DEALT) if edges[i] < edges[i + 1]]
        if some:
            sent = met(share)
            out += [summed(piece, sent, *of_known) for piece in some]
            forget(sent)
    forget(*of_known)
    return reduce(DataFrame.unionByName, out)


def _seen(column: pa.Array, n: int) -> np.ndarray:
    """How often each of n pairs is seen in a chunk's training texts; nulls: never."""
    return np.zeros(n, np.uint32) if column.null_count else _unbound(column, "<u4")


class Answers:
    """What a chunk is sent, by kind."""

    def __init__(self) -> None:
        self.held: list[list[tuple]] = [[], [], [], []]

    def add(self, kind: int, rows: pa.RecordBatch) -> None:
        a, b, c = (rows.column(n) for n in "abc")
        if kind == 0:
            parts = _unbound(a, np.int64), _unbound(b, float).reshape(-1, 1 + SAMPLES)
        elif kind == 1:
            times = _unbound(b, "<u4")
            number = rows.column("at").to_numpy() & ((1 << CHUNK_BITS) - 1)
            parts = number, np.diff(_edges(b)) // 4, _contexts(a, len(times)), times, _unbound(c, np.uint16), _seen(rows.column("d"), len(times)) == 1
        elif kind == 2:
            parts = _unbound(a, np.uint32), _unbound(b, np.int64), _unbound(c, np.float32).reshape(-1, SAMPLES)
        else:
            parts = _unbound(a, np.uint32), _unbound(b, np.int32), _unbound(c, np.float32)
        self.held[kind].append(tuple(np.array(p) for p in parts))

    def _all(self, kind: int) -> tuple:
        held, self.held[kind] = self.held[kind], []
        return tuple(np.concatenate(p) for p in zip(*held, strict=True))

    def sums(self) -> np.ndarray:
        """By place: log10(total + 1), log10 P, tokens with a total, and tokens."""
        if not self.held[1]:
            return np.zeros((4, 0))
        number, sizes, contexts, times, refs, once = self._all(1)
        edges = np.append(0, np.cumsum(sizes))
        asked, total, chances = self._all(2)
        order = np.argsort(asked)
        total, chances = total[order], chances[order]
        rest = np.where(once, np.float32(1 - CONTEXT_DISCOUNT), np.float32(0))  # but for those that are answered
        if self.held[3]:
            asked, column, known = self._all(3)
            rest[edges[np.searchsorted(number, asked)] + column] = known
        # A context that no training text has serves nobody, and asks its parent alone.
        found, values = self._all(0) if self.held[0] else (np.zeros(0, np.int64), np.zeros((0, 1 + SAMPLES)))
        order = np.argsort(found)
        found, values = found[order], np.vstack([values[order], [0.0] + [1.0] * SAMPLES])
        sums, place = np.zeros((4, 1 + int(refs.max()))), 0
        for lo in range(0, len(number), SEATED):
            hi = min(lo + SEATED, len(number))
            of = slice(edges[lo], edges[hi])
            row = np.searchsorted(found, contexts[of])
            row[found[np.minimum(row, len(found) - 1)] != contexts[of] if len(found) else slice(None)] = len(found)
            word = np.repeat(np.arange(lo, hi), sizes[lo:hi])
            # A token's probability in each seating, averaged over the seatings.
            backed = sum(chances[word, i] * values[row, 1 + i] for i in range(SAMPLES)) / SAMPLES
            log_p = np.repeat(np.log10(rest[of] / (STRENGTH + values[row, 0]) + backed), times[of])
            of_token = np.repeat(total[word], times[of])
            where = refs[place : place + len(of_token)]
            place += len(of_token)
            for i, v in enumerate((np.log10(of_token + 1.0), log_p, of_token > 0, np.ones(len(where)))):
                sums[i] += np.bincount(where, v, sums.shape[1])
        return sums


def _summed(chunk: int, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk; they have at least one token each."""
    place = np.flatnonzero(sums[3])
    if len(place):
        columns = [pa.array(np.full(len(place), chunk)), pa.array(place.astype(np.int32)), pa.array(sums[0, place]), pa.array(sums[1, place]), pa.array(np.rint(sums[2, place]).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "place", "logs", "score", "known"])


def learned(totals: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Restaurants]:
    """What learned_from() has of totals (word, total, classes and counts: a long for each)."""
    return learned_from(totals.select("word", "total"), written(pairs_of(totals, "counts", "<i8"), "pairs", "zstd"), block_rows)


def learned_from(totals: DataFrame, pairs: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Restaurants]:
    """word, total and chances of each word of totals (word, total), as _sums() takes them; and what all
    tables sum to. A word without a total stands for all unknown ones. pairs: context, w and n."""
    model, top = fit(totals.filter("total > 0").select("word", F.lit(1).cast("long").alias("n")))
    start = first_seating(totals, pairs)
    first, at = seated(spelt(totals, model, top, block_rows), pairs, start, 1)
    forget(model, start.contexts)
    model, top = fit(first.select("word", F.get("seats", F.lit(0)).alias("n")).filter("n > 0"))
    forget(first)
    before = at.contexts
    last, at = seated(spelt(totals, model, top, block_rows), pairs, at, SAMPLES)
    forget(model, before)
    spelling = [F.pow(F.lit(10.0), F.get("spelling", F.lit(i))) for i in range(SAMPLES)]
    left = last.filter("total > 0").agg(*[F.coalesce(F.sum(p), F.lit(0.0)) for p in spelling]).first()
    chances = []
    for i, p in enumerate(spelling):
        p = F.when(F.col("total") > 0, p).otherwise(max(1e-12, 1 - left[i]))
        own, tables = float(at.own[i]), float(at.own_tables[i])
        chances.append((F.get("served", F.lit(i)) - WORD_DISCOUNT * F.get("seats", F.lit(i)) + (STRENGTH + WORD_DISCOUNT * tables) * p) / (STRENGTH + own))
    return written(_packed(last.select("word", "total", F.array(*chances).alias("chances"))), "known", "zstd"), at


def _packed(known: DataFrame) -> DataFrame:
    """The chances as four bytes each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("chances").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            yield batch.set_column(2, "chances", _binaries(values, SAMPLES * np.arange(batch.num_rows + 1)))

    return mapped(known, pack, "word binary, total long, chances binary")


def score(documents: DataFrame, *, key: str = "doc_id", block_rows: int = BLOCK_ROWS, tokens: int = TOKENS) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Null text is empty: it has the end only. A null id trains (its checksum is that of no bytes).
    Without training rows all counts are zero and an unknown word is certain. Repeated rows count and
    come back each time.
    """
    marked = documents.select(key, "text", (crc_mod(key, 7) == 2).alias("held_out"))
    # Words, hashes and places hardly repeat: looking for repeats in them is in vain.
    for column in ("word", "at", "refs", "classes", "context", "w", *"abcd"):
        documents.sparkSession.conf.set(f"parquet.enable.dictionary#{column}", "false")
    rows = written(word_rows(marked, key, tokens), "words", "zstd")
    docs = rows.filter(F.col("place").isNotNull()).select("chunk", "place", "doc_id", "n_tokens", "held_out")
    words = rows.filter(F.col("word").isNotNull()).select("word", "at", "n", "classes", "seen", "times", "refs")
    totals = written(words.groupBy("word").agg(F.sum("n").alias("total")), "totals", "zstd")
    pairs = reduce(DataFrame.unionByName, [written(pairs_of(words, "seen", "<u4", share), "pairs", "zstd") for share in range(SHARES)])
    n, v = totals.filter("total > 0").agg(F.coalesce(F.sum("total"), F.lit(0)), F.count("*")).first()
    known, at = learned_from(totals, pairs, block_rows)
    joined = docs.join(_sums(words, known, at), ["chunk", "place"])
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
