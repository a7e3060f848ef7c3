"""SimHash near-duplicates with a pigeonring filter.

A fingerprint's 64 bits lie in a ring of `segments` segments. If two fingerprints differ in at
most `max_bits` bits, then by the pigeonring principle some segment starts a chain in which, for
every l, the first l segments differ in at most l * max_bits / segments bits. With 5 segments and
4 bits: the first segment is equal, the first two differ in at most 1 bit, then 2, 3 and 4.

The first two segments of a chain make the key under which fingerprints meet: each is stored once
per starting segment and looked up under itself and under each flip 1 -> 0 of a bit of the second
segment (the flip 0 -> 1 is the other fingerprint's to make). Where they meet, the rest of the
chain is tested before the full Hamming distance. This loses no pair.

Copies share a fingerprint and are one node. Fingerprints that meet under one key are linked by a
spanning forest of that key's graph and not by all pairs, and a key with very many of them is dealt
in blocks, of which each pair goes to another task.

near_copies() groups texts whose shingles are similar: SimHash links come first, and a join of
shingle prefixes, exact, finds those that fingerprints miss.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.llm.common import forget, mapped, written
from errata.llm.components import components

BITS = 64
MAX_BITS = 4
SHINGLE = 4
SEED = 42
SEGMENTS = 5
#: Fingerprints of one key that a task takes at once; more are dealt in blocks of so many.
BLOCK = 8192
#: Sizes of keys are estimated from at least one of so many fingerprints.
SAMPLED_OF = 16
#: Up to so many pairs of one key are compared at once; beyond, neighbours are searched one by one.
PAIRS_AT_ONCE = 256
#: The bit of a key from which on it says where the chain starts; the segments lie below.
START = 44
#: Shingle hashes whose bits are counted at once.
HASHES_AT_ONCE = 1 << 16


def hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle of the text, A-Z lower-cased, repeats included."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    np.cumsum([len(w) + 1 for w in words[:-1]], out=starts[1:])
    ends = np.append(starts[shingle:] - 1, len(joined))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=False)], np.uint64)


def fingerprint(values: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the values."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(values), HASHES_AT_ONCE):
        part = values[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(values), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(documents: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """All columns of documents, and `errata_fp` (the fingerprint's 64 bits as a signed long).

    Null, empty and blank texts have fingerprint zero.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(hashes(t, shingle)) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "errata_fp"])

    return mapped(documents, add, T.StructType([*documents.schema.fields, T.StructField("errata_fp", T.LongType())]))


def ring(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _segment(values: np.ndarray, place: tuple[int, int]) -> np.ndarray:
    return (values >> np.uint64(place[0])) & np.uint64((1 << place[1]) - 1)


def _keys(values: np.ndarray, prints: np.ndarray, start: int, places: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, fingerprints, and whether stored (or only looked up), for chains from `start`. A key
    names the print and the start besides the two segments."""
    first, second = places[start], places[(start + 1) % len(places)]
    head = (prints << np.uint64(START + 8)) | (np.uint64(start) << np.uint64(START)) | (_segment(values, first) << np.uint64(second[1]))
    tail = _segment(values, second)
    keys, owners, stored = [head | tail], [values], [np.ones(len(values), bool)]
    for bit in range(second[1]):
        has = (tail >> np.uint64(bit)) & np.uint64(1) == 1
        keys.append(head[has] | (tail[has] ^ np.uint64(1 << bit)))
        owners.append(values[has])
        stored.append(np.zeros(int(has.sum()), bool))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(stored)


def _near(a: np.ndarray, b: np.ndarray, start: int, places: list[tuple[int, int]], max_bits: int) -> np.ndarray:
    """Whether the pairs pass the whole chain from `start`, ending with the full distance."""
    differ = a ^ b
    ok, total = np.ones(differ.shape, bool), np.zeros(differ.shape, np.int64)
    for step in range(len(places)):
        total += np.bitwise_count(_segment(differ, places[(start + step) % len(places)]))
        ok &= total * len(places) <= (step + 1) * max_bits
    return ok


def _links(stored: np.ndarray, asking: np.ndarray, start: int, places, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph of near pairs, at least one of each being stored."""
    out = []
    nodes = np.concatenate([stored, asking])
    is_stored = np.arange(len(nodes)) < len(stored)
    waiting = np.ones(len(nodes), bool)
    for root in range(len(nodes)):
        if not waiting[root]:
            continue
        waiting[root] = False
        front = [root]
        while front:
            node = front.pop()
            left = np.flatnonzero(waiting if is_stored[node] else waiting & is_stored)
            if not len(left):
                continue
            found = left[_near(nodes[left], nodes[node], start, places, max_bits)]
            waiting[found] = False
            front += found.tolist()
            out += [(nodes[node], nodes[i]) for i in found]
    return out


def _run_links(key, values: np.ndarray, stored: np.ndarray, places, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(print, a, b): links of sorted runs of equal keys: small runs pair by pair, at once; large ones one by one."""
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1])))
    size = np.diff(np.append(new, len(key)))
    n_stored = np.add.reduceat(stored.astype(np.int64), new)
    starts = (key >> np.uint64(START) & np.uint64(255)).astype(np.int64)
    live = (n_stored > 0) & (size > 1)
    small = live & (n_stored * size <= PAIRS_AT_ONCE)
    # stored rows come first in a run: pairs (i, j) with i stored and j behind it
    at = np.repeat(new[small], n_stored[small]) + _within(n_stored[small])
    end = np.repeat((new + size)[small], n_stored[small])
    times = end - at - 1
    left = np.repeat(at, times)
    right = left + 1 + _within(times)
    for lo in range(0, len(left), 1 << 20):
        i, j = left[lo : lo + (1 << 20)], right[lo : lo + (1 << 20)]
        for start in range(len(places)):
            of = starts[i] == start
            a, b = values[i[of]], values[j[of]]
            ok = _near(a, b, start, places, max_bits)
            yield key[i[of][ok]] >> np.uint64(START + 8), a[ok], b[ok]
    for r in np.flatnonzero(live & ~small):
        a, m, n = new[r], n_stored[r], size[r]
        found = _links(values[a : a + m], values[a + m : a + n], int(starts[a]), places, max_bits)
        pairs = np.array(found, np.uint64).reshape(-1, 2)
        yield np.repeat(key[a : a + 1] >> np.uint64(START + 8), len(pairs)), pairs[:, 0], pairs[:, 1]


def _within(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def links(distinct: DataFrame, *, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges (print, a, b) between distinct fingerprints (print, errata_fp) of the same print, enough
    to connect all that are near.

    `distinct` is read more than once, so it is to be a stored table.
    """
    if max_bits >= segments:
        raise ValueError("the first segment of a chain is to be equal: more segments than bits are needed")
    spark, places = distinct.sparkSession, ring(segments)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("errata_fp").to_numpy().view(np.uint64)
            prints = batch.column("print").to_numpy().astype(np.uint64)
            for start in range(segments):
                key, owner, stored = _keys(values, prints, start, places)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), owner.view(np.int64), ~stored)], ["key", "fp", "asks"])

    distinct = distinct.select("print", "errata_fp")
    # A sample tells which keys are large, those that ask included; every fingerprint is then compared.
    every = max(1, min(SAMPLED_OF, distinct.count() // block))
    sample = distinct.filter(F.pmod(F.xxhash64("errata_fp"), F.lit(every)) == 0)
    sizes = mapped(sample, meet, "key long, fp long, asks boolean").groupBy("key").agg((F.count("*") * every).alias("n"))
    large = written(sizes.filter(F.col("n") > block), "large_keys")
    rows = mapped(distinct, meet, "key long, fp long, asks boolean").withColumn("turn", F.lit(0))
    if not large.isEmpty():
        # Every pair of blocks of a large key is a group of its own.
        blocks = F.ceil(F.col("n") / block).cast("int")
        rows = rows.join(large, "key", "left").withColumn("blocks", F.coalesce(blocks, F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        rows = rows.withColumn("turn", F.explode(_turns(own, F.col("blocks")))).select("key", "fp", "asks", "turn")
    dealt = rows.repartition("key", "turn").sortWithinPartitions("key", "turn", "asks")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_end(batches):
            if batch is not None:
                now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "turn", "fp", "asks")]
                rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
                same = (rest[0] == rest[0][-1]) & (rest[1] == rest[1][-1])
                cut = int(np.argmax(same))  # the last run may go on in the next batch
            else:
                cut = 0 if rest is None else len(rest[0])
            if cut:
                key, turn, fp, asks = (x[:cut] for x in rest)
                rest = [x[cut:] for x in rest]
                for part in _by_turn(key, turn):
                    for number, a, b in _run_links(key[part].view(np.uint64), fp[part].view(np.uint64), ~asks[part], places, max_bits):
                        yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["print", "a", "b"])

    return mapped(dealt.select("key", "turn", "fp", "asks"), connect, "print int, a long, b long").filter("a != b")


def _and_end(batches):
    yield from (b for b in batches if b.num_rows)
    yield None


def _by_turn(key: np.ndarray, turn: np.ndarray) -> Iterator[slice]:
    """Slices in which a key has one turn only."""
    cuts = [0, *(np.flatnonzero((key[1:] == key[:-1]) & (turn[1:] != turn[:-1])) + 1).tolist(), len(key)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield slice(a, b)


def classes(documents: DataFrame, *, key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Per document row: doc_id, errata_fp, component_id (the least doc_id that links lead to).

    Null ids count as larger than any other: a component of null ids only has component_id null.
    Repeated rows give repeated results; no documents give none.
    """
    slim = documents.select(F.col(key).alias("doc_id"), "text")
    return _classes(fingerprints(slim, shingle=shingle).drop("text"), max_bits, segments, block)


def _classes(marked: DataFrame, max_bits: int, segments: int, block: int) -> DataFrame:
    marked = written(marked, "fingerprints")
    distinct = written(marked.groupBy(F.lit(0).alias("print"), "errata_fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, max_bits=max_bits, segments=segments, block=block))
    named = distinct.join(roots, F.col("errata_fp") == F.col("node"), "left").select("errata_fp", "least", F.coalesce("root", "errata_fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "root").select("errata_fp", "component_id")
    return marked.join(by_fp, "errata_fp").select(*marked.columns, "component_id")


def as_hex(column: str = "errata_fp"):
    return F.lower(F.lpad(F.hex(column), BITS // 4, "0")).alias("fingerprint")


# ---- near copies by shingle similarity -------------------------------------------------------------

WORDS = 5
SIMILARITY = 0.8
#: The least bits of a text's parity map, and those that rows of shared shingles carry.
PARITY = 512
#: Of so many texts one is read for the frequent shingles, once there are SAMPLED times as many.
SAMPLE, SAMPLED = 4, 10_000
#: Up to so many frequent shingles are ordered by frequency, of those seen so often in the sample.
FREQUENT, SEEN = 1_000_000, 2


def _contents(documents: DataFrame) -> DataFrame:
    """doc_id, row_text (a hash of the text), content (a hash of its words)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = [xxhash.xxh3_64_intdigest(b" ".join(text.encode().lower().split() if text else [])) for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("row_text"), pa.array(np.array(content, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_text", "content"])

    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("row_text"))
    key = documents.schema["doc_id"].dataType
    fields = [("doc_id", key), ("row_text", T.LongType()), ("content", T.LongType())]
    return mapped(slim, add, T.StructType([T.StructField(n, k) for n, k in fields]))


def _frequent(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their rank by frequency. They only order the shingles: which
    of them are known changes the work and not the result."""
    n = texts.count()
    sample = texts.filter(F.pmod("content", F.lit(max(1, min(SAMPLE, n // SAMPLED)))) == 0)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes(text, size)).view(np.int64))], ["key"])

    counted = mapped(sample.select("text"), spell, "key long").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= SEEN)
    rows = counted.orderBy(F.desc("n"), "key").limit(FREQUENT).select("key").toArrow()
    keys = rows["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], len(keys) - order


def parity(values: np.ndarray) -> bytes:
    """How often each place is hit by distinct hashes, modulo 2: maps of two sets differ in at most as
    many bits as the sets in members. There are at least as many bits as hashes."""
    size = max(PARITY, 1 << max(0, len(values) - 1).bit_length())
    hit = np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(hit.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The map of `size` bytes of the same hashes."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, "<u8").reshape(-1, size // 8), axis=0)


def _shapes(texts: DataFrame, size: int) -> DataFrame:
    """content, its fingerprint, its number of distinct shingles, their parity map, and the map folded to PARITY bits."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_hashes = [hashes(t, size) for t in batch.column("text").to_pylist()]
            prints = np.array([fingerprint(v) for v in all_hashes], np.uint64)
            sets = [np.unique(v) for v in all_hashes]
            maps = [parity(v) for v in sets]
            least = [folded(m, PARITY // 8).tobytes() for m in maps]
            columns = [batch.column("content"), pa.array(prints.view(np.int64)), pa.array([len(v) for v in sets], pa.int32()), pa.array(maps, pa.binary()), pa.array(least, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["content", "errata_fp", "n", "bits", "least"])

    return mapped(texts.select("content", "text"), add, "content long, errata_fp long, n int, bits binary, least binary")


def _prefixes(texts: DataFrame, size: int, least: float, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, content, n, at): of each text's n shingles, in an order that all texts share and that puts
    frequent ones last, so many that two similar texts have one of them in common; `at` is its place in that order."""
    known, rank = frequent

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, text in zip(batch.column("content").to_pylist(), batch.column("text").to_pylist(), strict=True):
                values = np.unique(hashes(text, size))
                if not len(values):
                    continue
                take = len(values) - math.ceil(least * len(values) - 1e-9) + 1
                place = np.searchsorted(known, values)
                place[place == len(known)] = 0
                late = np.where(known[place] == values, rank[place], 0) if len(known) else np.zeros(len(values), np.int64)
                keys = values[np.lexsort((values, late))[:take]]
                rows = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(rows, content, np.int64)), pa.array(np.full(rows, len(values), np.int32)), pa.array(np.arange(rows, dtype=np.int32))], ["key", "content", "n", "at"])

    return mapped(texts.select("content", "text"), add, "key long, content long, n int, at int")


def _most(a, b, least: float):
    """The most members in which sets of a and b members can differ that are so similar."""
    return (a + b) * (1 - least) / (1 + least) + 1e-9


def _possible(pairs: DataFrame, shapes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that their parity maps do not rule out."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                size = min(len(x), len(y))
                good.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= _most(n, m, least))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = pairs.join(shapes.select(F.col("content").alias("a"), "n", F.col("bits").alias("x")), "a")
    both = left.join(shapes.select(F.col("content").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y")), "b")
    return mapped(both.select("a", "b", "n", "m", "x", "y"), keep, "a long, b long")


def _turns(own, blocks):
    """The numbers of the pairs of blocks that a row of block `own` meets in."""
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.least(own, other) * blocks + F.greatest(own, other))


def _across(rows: DataFrame, least: float, block: int, *, nearest: bool) -> DataFrame:
    """Pairs (a, b) of rows (key, size, content, n, at, root, least) of one key and different roots
    that their sizes, the key's places and folded maps do not rule out: of the keys that a similar
    pair shares, the first leaves enough behind it in both. `nearest`: of each row only the one whose
    map is the nearest. A key of more than `block` texts is dealt in blocks, of which each pair goes to
    another task."""

    def pairs(key, turn, own, content, n, at, root, bits) -> Iterator[pa.RecordBatch]:
        cuts = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (turn[1:] != turn[:-1]))), len(key))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            # a turn of two blocks compares rows of one with rows of the other only
            both = own[lo:hi].min() != own[lo:hi].max()
            for i in range(lo, hi - 1):
                end = lo + int(np.searchsorted(n[lo:hi], n[i] / least + 1e-6, "right"))
                j = i + 1 + np.flatnonzero(root[i + 1 : end] != root[i])
                if both:
                    j = j[own[j] != own[i]]
                j = j[np.minimum(n[i] - at[i], n[j] - at[j]) >= (n[i] + n[j]) * least / (1 + least) - 1e-6]
                if len(j):
                    differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1)
                    near = differ <= _most(n[i], n[j], least)
                    if near.any():
                        j = j[near]
                        if nearest:
                            j = j[[np.argmin(differ[near])]]
                        a, b = np.minimum(content[i], content[j]), np.maximum(content[i], content[j])
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_end(batches):
            if batch is not None:
                now = [batch.column(c).to_numpy() for c in ("key", "turn", "own", "content", "n", "at", "root")]
                now.append(np.frombuffer(b"".join(batch.column("least").to_pylist()), "<u8").reshape(-1, PARITY // 64))
                rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
                cut = int(np.argmax((rest[0] == rest[0][-1]) & (rest[1] == rest[1][-1])))  # the last run may go on in the next batch
            else:
                cut = 0 if rest is None else len(rest[0])
            if cut:
                yield from pairs(*(x[:cut] for x in rest))
                rest = [x[cut:] for x in rest]

    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / block)).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("turn", F.explode(_turns(F.col("own"), F.col("blocks"))))
    dealt = dealt.select("key", "turn", "own", "content", "n", "at", "root", "least").repartition("key", "turn").sortWithinPartitions("key", "turn", "n")
    return mapped(dealt, meet, "a long, b long")


def _shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """content and its distinct word shingles, as sorted 32-bit hashes; a shorter text is one shingle."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(hashes(t, size) >> np.uint64(32)).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(found, pa.binary())], ["content", "shingles"])

    return mapped(texts.select("content", "text"), add, "content long, shingles binary")


def _similar(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b, x, y) whose shingles x and y have that Jaccard similarity."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(a, b, assume_unique=True)) if min(len(a), len(b)) >= least * max(len(a), len(b)) else 0
                good.append(both >= least * (len(a) + len(b) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return mapped(pairs, keep, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, shapes: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (a, b) of contents that are in fact so similar."""
    pairs = written(_possible(pairs.distinct(), shapes, least), "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("content")).distinct()
    sets = written(_shingle_sets(texts.join(involved, "content"), size), "shingles")
    left = pairs.join(sets.select(F.col("content").alias("a"), F.col("shingles").alias("x")), "a")
    full = left.join(sets.select(F.col("content").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    edges = written(_similar(full, least), "similar")
    forget(sets, pairs)
    return edges


def _seeds(shapes: DataFrame, max_bits: int, segments: int, block: int) -> DataFrame:
    """Pairs (a, b) of contents that SimHash finds: each text with the first of its fingerprint, and
    the first texts of linked fingerprints."""
    prints = written(shapes.filter("n > 0").groupBy(F.lit(0).alias("print"), "errata_fp").agg(F.min("content").alias("first")), "prints")
    one, other = (prints.select(F.col("errata_fp").alias(x), F.col("first").alias(f"text_{x}")) for x in ("a", "b"))
    near = links(prints, max_bits=max_bits, segments=segments, block=block).join(one, "a").join(other, "b")
    same = shapes.join(prints.select("errata_fp", "first"), "errata_fp").filter("content != first")
    return near.select(F.col("text_a").alias("a"), F.col("text_b").alias("b")).unionByName(same.select(F.col("first").alias("a"), F.col("content").alias("b")))


def _named(rows: DataFrame, roots: DataFrame, column: str, root: str) -> DataFrame:
    """rows with the root of the content in `column`: itself, where it is linked with no other."""
    return rows.join(roots.select(F.col("content").alias(column), F.col("root").alias(root)), column, "left").withColumn(root, F.coalesce(root, column))


def _joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The roots (content, root) once edges (a, b) are added: what they link are roots, and few, as most
    contents are linked already."""
    ends = _named(_named(edges, roots, "a", "low"), roots, "b", "high")
    above = components(ends.select(F.col("low").alias("a"), F.col("high").alias("b")))
    if above.isEmpty():
        return roots
    # A root is no content of `roots`, so no content comes twice.
    moved = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
    return written(moved.select("content", F.coalesce("above", "root").alias("root")).unionByName(above.withColumnRenamed("node", "content")), "roots")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows, stored, of keys that have more than one root."""
    keys = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("key")
    return written(rows.join(written(keys, "mixed"), "key"), "apart")


def near_copies(documents: DataFrame, *, words: int = WORDS, similarity: float = SIMILARITY, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """doc_id, row_text and component_id of every row: texts of equal words are one group, and groups
    are linked if their word shingles are as similar. No such pair is lost.

    SimHash links come first and join most copies; each is confirmed by the shingles. What
    fingerprints miss is found by the shingles themselves: similar texts have a shingle of their
    prefixes in common. Each text is tested with one text that shares one; then with the first text
    of each of its shingles that it is not linked with yet; then, for each shingle, with the nearest
    of those that it is not linked with yet, and at last all pairs that share one and are not linked
    yet. A pair left out is one that links already join, so the groups are the same whatever the
    fingerprints and blocks are.
    """
    marked = written(_contents(documents), "contents")
    named = marked.groupBy("content").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "row_text")).alias("row"))
    wanted = named.select("content", F.col("row.doc_id").alias("errata_id"), F.col("row.row_text").alias("errata_row"))
    found = documents.select("doc_id", "text").join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("errata_id")) & (F.xxhash64("text") == F.col("errata_row")))
    texts = written(found.dropDuplicates(["content"]).select("content", "text"), "texts", "zstd")
    shapes = written(_shapes(texts, words), "shapes")

    prefixes = written(_prefixes(texts, words, similarity, _frequent(texts, words)), "prefixes")
    # Both are stored: a join of what is read from files can split the rows of one key.
    groups = written(prefixes.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("content", "n", "at")).alias("first")).filter("size > 1"), "groups")
    shared = prefixes.join(groups, "key").filter("content != first.content")
    shared = written(shared.select("key", "content", "n", "at", F.col("first.content").alias("first"), F.col("first.n").alias("m"), F.col("first.at").alias("place"), "size"), "shared")
    forget(prefixes, groups)
    alike = shared.filter(F.least(F.col("n") - F.col("at"), F.col("m") - F.col("place")) >= (F.col("n") + F.col("m")) * similarity / (1 + similarity) - 1e-6)
    leaders = alike.groupBy("content").agg(F.min("first").alias("first")).select(F.col("first").alias("a"), F.col("content").alias("b"))
    one = _confirmed(_seeds(shapes, max_bits, segments, block).unionByName(leaders), texts, shapes, words, similarity)

    roots = written(components(one).withColumnRenamed("node", "content"), "roots")
    apart = _named(_named(alike, roots, "content", "root"), roots, "first", "other").filter("root != other")
    roots = _joined(roots, _confirmed(apart.select(F.col("first").alias("a"), F.col("content").alias("b")), texts, shapes, words, similarity))

    rest = shared.filter("size > 2").select("key", "content", "n", "at", "size")
    for nearest in (True, False):
        mixed = _mixed(_named(rest, roots, "content", "root"))
        pairs = _across(mixed.join(shapes.select("content", "least"), "content"), similarity, block, nearest=nearest)
        roots = _joined(roots, _confirmed(pairs, texts, shapes, words, similarity))
        rest = mixed.drop("root")

    named = _named(named, roots, "content", "root").select("content", "least", "root")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("content", "component_id"), "content").select("doc_id", "row_text", "component_id")


def deduplicate(documents: DataFrame, **options) -> DataFrame:
    """Documents, all columns, one of each group of near_copies(): a row of its least doc_id.

    Of several rows with that id one stays; a row with a null id stays only if all ids of its group
    are null.
    """
    least = near_copies(documents, **options).filter("doc_id <=> component_id")
    rows = least.groupBy("component_id", "doc_id", "row_text").agg(F.count("*").alias("n"))
    kept = written(rows.groupBy("component_id", "doc_id").agg(F.min(F.struct("row_text", "n")).alias("t")).select(F.col("doc_id").alias("errata_id"), F.col("t.row_text").alias("errata_kept"), "t.n"), "kept")
    joined = documents.withColumn("errata_text", F.xxhash64("text")).join(
        kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("errata_id")) & (F.col("errata_text") == F.col("errata_kept")), "left_semi"
    )
    if not kept.filter("n > 1").isEmpty():
        joined = joined.dropDuplicates(["doc_id", "errata_text"])
    return joined.drop("errata_text")
