"""Repeated passages by sparse suffix arrays.

Of each text only the suffixes at minimiser positions are kept: the position of the least shingle
hash of each window of shingles. What they are is given by the words alone, so every passage of
`least` words that occurs twice has a kept suffix at the same place in both. A kept suffix stands for
the windows of `least` words whose minimiser it is, which together are its context: so many words to
its left, and so many to its right. Suffixes of equal contexts are one class.

Where a minimiser has several classes, their suffixes are sorted by the words to the right, and
neighbours are compared: words they share to the right, and to the left. If these are `least` words or
more, both have the match, extended left and right. They are sorted again by the words to the left,
nearest first. The two sorts tell how far a suffix shares words with any other on each side, and so
which windows could still be shared, in part with one neighbour and in part with another; those few
that no match has yet are compared window by window. So nothing is missed, and the windows of a
document together are its longest repeated passages.

Scale: the first pass keeps hashes and places alone. Contexts are read of one document of each class
of a mixed minimiser. The sorts are by range, so that a passage that a third of all documents share,
with other words about it, lies over many tasks; what lies at the edges of tasks is compared
afterwards. No list of the documents of a passage is ever made. Words are compared by 32-bit hashes,
of suffixes whose minimisers have equal 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.llm.common import mapped, scratch, written

#: Words of the shortest passage that counts.
LEAST = 50
#: Words of a shingle; a window holds the shingles of one passage.
SHINGLE = 12
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` values: a polynomial in an odd number, mixed at the end."""
    n = len(values) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    power, out, block, size = ODD, None, values, 1
    # by doubling: the hash of 2s values is that of the first s, shifted, plus that of the next s
    done, left = 0, length
    while left:
        if left & 1:
            part = block[done : done + n]
            out = part if out is None else out * _power(size) + part
            done += size
        left >>= 1
        if left:
            block = block[:-size] * _power(size) + block[size:]
            size *= 2
    out = out[:n].copy()
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out * power


def _power(size: int) -> np.uint64:
    return np.uint64(pow(int(ODD), size, 1 << 64))


def minimisers(shingles: np.ndarray, window: int) -> np.ndarray:
    """For each window of shingles the place of its least hash, the first of equals."""
    if len(shingles) < window:
        return np.zeros(0, np.int64)
    value, place, size = shingles, np.arange(len(shingles)), 1
    while size < window:  # by doubling, the last step overlapping
        step = min(size, window - size)
        right = value[step:] < value[: len(value) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        value = np.where(right, value[step:], value[: len(value) - step])
        size += step
    return place


def _kept(values: np.ndarray, least: int, shingle: int) -> tuple[np.ndarray, ...]:
    """For each kept suffix: the minimiser's hash, the first window it stands for, how many, the
    suffix's place behind the first window's start, and a hash of its context."""
    if len(values) < least:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64, np.uint64))
    shingles = rolling(values, shingle)
    place = minimisers(shingles, least - shingle + 1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    size = np.diff(np.append(first, len(place)))
    runs = rolling(values, least)
    # The first and the last window cover the context.
    alike = (runs[first] * ODD + runs[first + size - 1]) * ODD + size.astype(np.uint64)
    return shingles[place[first]], first, size, place[first] - first, alike


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def kept_suffixes(texts: DataFrame, least: int, shingle: int) -> DataFrame:
    """Of texts (doc, doc_id, text) a row for each document (doc, doc_id, n_words) and one for each kept
    suffix (doc, minimiser, first, size, off, alike)."""
    fields = [texts.schema["doc"], texts.schema["doc_id"], *(T.StructField(n, k) for n, k in (("n_words", T.LongType()), ("minimiser", T.LongType()), ("first", T.IntegerType()), ("size", T.IntegerType()), ("off", T.IntegerType()), ("alike", T.LongType())))]
    names = [f.name for f in fields]

    def table(n: int, columns: dict, kind) -> pa.RecordBatch:
        kinds = [pa.int64(), kind, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, docs = batch.schema.field("doc_id").type, batch.column("doc").to_numpy()
            words = [_words(t) for t in batch.column("text").to_pylist()]
            yield table(len(words), {"doc": batch.column("doc"), "doc_id": batch.column("doc_id"), "n_words": pa.array([len(w) for w in words], pa.int64())}, kind)
            found = [_kept(word_hashes(w), least, shingle) for w in words]
            own = np.repeat(docs, [len(f[0]) for f in found])
            minimiser, first, size, off, alike = (np.concatenate(c) for c in zip(*found, strict=True))
            columns = {"doc": own, "minimiser": minimiser.view(np.int64), "first": first.astype(np.int32), "size": size.astype(np.int32), "off": off.astype(np.int32), "alike": alike.view(np.int64)}
            yield table(len(own), {c: pa.array(v) for c, v in columns.items()}, kind)

    return mapped(texts, keep, T.StructType(fields))


CLASS = "minimiser long, alike long, low long, high long, size int, off int"
CONTEXT = f"{CLASS}, right binary, left binary"


def contexts(texts: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Of classes (CLASS, first in document low) the words of their contexts, as big-endian hashes:
    those from the suffix on, and those before it, the nearest first."""
    asked = classes.groupBy(F.col("low").alias("doc")).agg(F.collect_list(F.struct("minimiser", "alike", "low", "high", "size", "off", "first")).alias("asked"))  # a document's suffixes
    joined = texts.select("doc", "text").join(asked, "doc").select("text", "asked")
    names = [f.split()[0] for f in CLASS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked in zip(batch.column("text"), batch.column("asked"), strict=True):
                words = (word_hashes(_words(text.as_py())) >> np.uint64(32)).astype(">u4")
                back = words[::-1].tobytes()
                data, rows = words.tobytes(), asked.values
                first, size, off = (rows.field(c).to_numpy() for c in ("first", "size", "off"))
                at, end = first + off, first + size - 1 + least
                right = [data[4 * a : 4 * b] for a, b in zip(at.tolist(), end.tolist(), strict=True)]
                left = [back[4 * (len(words) - a) : 4 * (len(words) - b)] for a, b in zip(at.tolist(), first.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(rows.field(c) for c in names), pa.array(right, pa.binary()), pa.array(left, pa.binary())], [*names, "right", "left"])

    return mapped(joined, read, CONTEXT)


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of each row, and how many."""
    parts = column.to_pylist()
    size = np.array([len(p) // 4 for p in parts], np.int64)
    out = np.zeros((len(parts), max(1, width)), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(parts), ">u4")
    return out, size


def _shared(column: pa.Array) -> np.ndarray:
    """How many words each row shares with the next, from the start."""
    width = max((len(p) // 4 for p in column.to_pylist()), default=0)
    words, size = _matrix(column, width)
    inside = np.arange(words.shape[1]) < np.minimum(size[1:], size[:-1])[:, None]
    return ((words[1:] == words[:-1]) & inside).cumprod(axis=1).sum(axis=1)


COMPARED = ["minimiser", "alike", "a", "b", "mask"]
COMPARED_DDL = "minimiser long, alike long, a int, b int, mask long"


def _compared(rows: pa.Table, least: int) -> list[np.ndarray]:
    """For each row: words shared with a neighbour to the right, to the left, and the windows (bits) of
    matches with neighbours that another document has."""
    n = rows.num_rows
    minimiser, low, high, off, size = (rows[c].to_numpy() for c in ("minimiser", "low", "high", "off", "size"))
    r, left = _shared(rows["right"].combine_chunks()), _shared(rows["left"].combine_chunks())
    same = minimiser[1:] == minimiser[:-1]
    r, left = np.where(same, r, 0), np.where(same, left, 0)
    match = same & (r + left >= least) & (np.minimum(low[1:], low[:-1]) < np.maximum(high[1:], high[:-1]))
    a, b, mask = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int64)
    for here in (slice(None, -1), slice(1, None)):
        a[here], b[here] = np.maximum(a[here], r), np.maximum(b[here], left)
        first, last = np.maximum(0, off[here] - left), np.minimum(size[here] - 1, off[here] + r - least)
        own = np.where(match & (last >= first), _bits(first, last), 0)
        mask[here] |= own
    return [minimiser, rows["alike"].to_numpy(), a, b, mask]


def _bits(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Bits first to last, both at least 0 and below 63; none where last is less."""
    one = np.int64(1)
    return (one << np.clip(last + 1, 0, 62).astype(np.int64)) - (one << np.clip(first, 0, 62).astype(np.int64))


def neighbours(rows: DataFrame, least: int, *order: str) -> DataFrame:
    """COMPARED of contexts sorted by these columns: each with the one before and after it."""
    names = [f.split()[0] for f in CONTEXT.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch], edges: bool = True) -> Iterator[pa.RecordBatch]:
        part, before, first = TaskContext.get().partitionId(), None, None
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

        def out(columns: list, edge) -> pa.RecordBatch:
            n = len(columns[0]) if columns else edge[1].num_rows
            own = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] if columns else [edge[1]["minimiser"].combine_chunks(), edge[1]["alike"].combine_chunks(), *(pa.array(np.zeros(n, k)) for k in (np.int32, np.int32, np.int64))]
            more = [pa.array([edge[0]] * n, pa.int32()), *(edge[1][c].combine_chunks() for c in names[2:])] if edge else [pa.nulls(n, pa.int32()), *(pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays([*own, *more], [*COMPARED, "edge", *names[2:]])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            if not now.num_rows:
                continue
            first = now.slice(0, 1) if first is None else first
            rows = now if before is None else pa.concat_tables([before, now])
            yield out(_compared(rows, least), None)  # the last row meets the next batch as well
            before = now.slice(now.num_rows - 1)
        if edges and first is not None:
            yield out([], (2 * part, first))
            yield out([], (2 * part + 1, before))

    kind = f"{COMPARED_DDL}, edge int, low long, high long, size int, off int, right binary, left binary"
    found = written(mapped(rows.select(names).orderBy(*order), compare, kind), "compared")
    # Two rows of each task, in the order of tasks: each is compared with those beside it.
    edges = found.filter("edge IS NOT NULL").select(*names, "edge").repartition(1).sortWithinPartitions("edge").select(names)
    between = mapped(edges, lambda batches: compare(batches, edges=False), kind)
    return found.filter("edge IS NULL").select(COMPARED).unionByName(between.select(COMPARED))


def _bit(number):
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def _window(offset, least: int):
    """The words of the window that starts so many words before the suffix, in the order of left and right."""
    return F.concat(F.substring(F.col("left"), F.lit(1), (4 * offset).cast("int")), F.lit(b"|"), F.substring(F.col("right"), F.lit(1), (4 * (least - offset)).cast("int")))


def _windows(rows: DataFrame, mask, least: int) -> DataFrame:
    """minimiser, alike, low, high, w, words: a row for each window of the mask."""
    # A window lies in a suffix's words to the left, nearest first, and to the right: both are given by it.
    each = rows.withColumn("w", F.explode(F.filter(F.sequence(F.lit(0), F.col("size") - 1), lambda w: F.getbit(mask, w) == 1)))
    return each.select("minimiser", "alike", "low", "high", "w", _window(F.col("off") - F.col("w"), least).alias("words"))


def repeated(suffixes: DataFrame, texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """minimiser, alike, low, mask: of classes the windows that another document has; and the contexts
    of the classes whose minimisers have several. Both are stored; what they were made from is deleted."""
    with scratch(texts.sparkSession):
        return _repeated(suffixes, texts, least)


def _repeated(suffixes: DataFrame, texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    classes = suffixes.groupBy("minimiser", "alike").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.min(F.struct("doc", "first", "size", "off")).alias("one"))
    classes = written(classes.select("minimiser", "alike", "low", "high", "one.first", "one.size", "one.off"), "classes")
    mixed = classes.groupBy("minimiser").agg(F.count("*").alias("n"), F.min("low").alias("a"), F.max("high").alias("b")).filter("n > 1 AND a < b").select("minimiser")
    rows = written(contexts(texts, classes.join(written(mixed, "mixed"), "minimiser"), least), "contexts", "zstd")
    sides = neighbours(rows, least, "right", "left", "alike").unionByName(neighbours(rows, least, "minimiser", "left", "right", "alike"))
    known = sides.groupBy("minimiser", "alike").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.bit_or("mask").alias("mask"))
    every = _bit(F.col("size")) - 1
    # Windows from so far left as the left is shared to so far right as the right is.
    first, last = F.greatest(F.lit(0), F.col("off") - F.col("b")), F.least(F.col("size") - 1, F.col("off") + F.col("a") - least)
    possible = F.when(last >= first, _bit(last + 1) - _bit(first)).otherwise(0)
    own = rows.join(known, ["minimiser", "alike"])
    own = own.withColumn("mask", F.when(F.col("low") < F.col("high"), every).otherwise(F.col("mask"))).withColumn("left_over", possible.bitwiseAND(F.bitwise_not("mask")))
    own = written(own.select(*rows.columns, "mask", "left_over"), "masks", "zstd", keep=True)
    # A window left over may be shared with any class of its minimiser in which it is possible, found or not.
    asked = own.filter("left_over != 0").select("minimiser").distinct()
    among = own.join(asked, "minimiser", "left_semi")
    windows = written(_windows(among, F.when(F.col("low") < F.col("high"), every).otherwise(F.col("mask").bitwiseOR(F.col("left_over"))), least), "windows")
    shared = windows.groupBy("minimiser", "words").agg(F.min("low").alias("a"), F.max("high").alias("b")).filter("a < b").select("minimiser", "words")
    more = windows.join(written(shared, "shared"), ["minimiser", "words"]).groupBy("minimiser", "alike").agg(F.bit_or(_bit(F.col("w"))).alias("more"))
    alone = classes.join(mixed, "minimiser", "left_anti").filter("low < high").select("minimiser", "alike", "low", every.alias("mask"))
    found = own.select("minimiser", "alike", "low", "mask").join(more, ["minimiser", "alike"], "left").select("minimiser", "alike", "low", F.col("mask").bitwiseOR(F.coalesce("more", F.lit(0))).alias("mask"))
    return written(alone.unionByName(found).filter("mask != 0"), "repeated", keep=True), own.drop("mask", "left_over")


def _earliest(found: DataFrame, rows: DataFrame, least: int) -> DataFrame:
    """minimiser, alike, w, first_doc: of the repeated windows of mixed minimisers the least document."""
    each = _windows(rows.join(found.select("minimiser", "alike", "mask"), ["minimiser", "alike"]), F.col("mask"), least)
    each = written(each.withColumn("words", F.xxhash64("words")), "each")
    return each.join(written(each.groupBy("minimiser", "words").agg(F.min("low").alias("first_doc")), "firsts"), ["minimiser", "words"]).select("minimiser", "alike", "w", "first_doc")


def _spans(rows: DataFrame, least: int, name: str) -> DataFrame:
    """doc and its spans, joined where they meet, of rows (doc, first, mask)."""
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    held = rows.groupBy("doc").agg(F.collect_list(F.struct("first", "mask")).alias("held"))  # a document's own suffixes

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(63)
        for batch in batches:
            out = []
            for held in batch.column("held"):
                first, mask = (held.values.field(c).to_numpy() for c in ("first", "mask"))
                at, bit = np.nonzero(mask[:, None] >> bits & 1)
                start = np.unique(first[at] + bit)
                new = np.flatnonzero(np.diff(start, prepend=-least - 1) > least)
                end = start[np.append(new[1:], len(start)) - 1] + least
                out.append([{"start": a, "end": b} for a, b in zip(start[new].tolist(), end.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["doc", name])

    return mapped(held, join, T.StructType([rows.schema["doc"], T.StructField(name, kind)]))


def passages(documents: DataFrame, *, least: int = LEAST, shingle: int = SHINGLE, later: bool = False) -> DataFrame:
    """Per document row: doc (a number), doc_id, text, n_words and spans (word ranges that other
    documents share, end exclusive); with `later` also those of them that a document before it has.

    Words are A-Z lower-cased and split at ASCII white space. Null, empty and short texts share
    nothing; repeated rows, of any id, share all. What only one document repeats does not count.
    """
    if least - shingle + 1 > 62:
        raise ValueError("a suffix stands for at most 62 windows: the shingle is to be longer")
    texts = written(documents.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"), "texts", "zstd")
    rows = written(kept_suffixes(texts, least, shingle), "suffixes")
    suffixes = rows.filter(F.col("minimiser").isNotNull()).drop("doc_id", "n_words")
    found, own = repeated(suffixes, texts, least)
    places = suffixes.join(found, ["minimiser", "alike"])
    out = texts.join(rows.filter(F.col("n_words").isNotNull()).select("doc", "n_words"), "doc")
    empty = F.array().cast("array<struct<start:int,end:int>>")
    out = out.join(_spans(places.select("doc", "first", "mask"), least, "spans"), "doc", "left").withColumn("spans", F.coalesce("spans", empty))
    if later:
        firsts = _earliest(found, own, least)
        bit = _bit(F.col("w"))
        mixed = suffixes.join(firsts, ["minimiser", "alike"]).filter("first_doc < doc").groupBy("doc", "first").agg(F.bit_or(bit).alias("mask"))
        whole = places.join(own.select("minimiser", "alike"), ["minimiser", "alike"], "left_anti").filter("low < doc").select("doc", "first", "mask")
        out = out.join(_spans(whole.unionByName(mixed), least, "later"), "doc", "left").withColumn("later", F.coalesce("later", empty))
    return out


def report(documents: DataFrame, *, least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """Per document row that shares a passage: doc_id, n_words, n_repeated (words covered), spans start:end."""
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    covered = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    found = passages(documents, least=least, shingle=shingle).filter("size(spans) > 0")
    return found.select("doc_id", "n_words", covered.alias("n_repeated"), shown.alias("spans"))


def deduplicated(documents: DataFrame, **options) -> DataFrame:
    """doc_id and text of every row, without the passages that a row before it has. Rows are in the
    order in which Spark numbers them."""
    found = passages(documents, later=True, **options).select("doc_id", "text", "later")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in x] for x in batch.column("later").to_pylist()]
            texts = [without(t, s) for t, s in zip(batch.column("text").to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return mapped(found, cut, T.StructType([found.schema["doc_id"], found.schema["text"]]))


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans (and what lies between them)."""
    if not text or not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return "".join([*out, text[at:]])
