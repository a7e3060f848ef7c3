"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most one sequence. All that matters for packing is how many
pieces there are of each length, a table of at most `capacity` rows, so the plan is made on that
histogram: a bitset subset-sum over the lengths still there finds the fullest feasible combination,
which is removed as often as the counts allow before the next is looked for. The plan is therefore
global and optimal per bin at any corpus size, while the driver sees only the histogram.

Pieces find their place in the plan by their rank among the pieces of their length. Ranks need no
sort and no task that holds all pieces of a length: a piece is counted within its file part, and
the parts' totals give the offsets.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from errata.llm.common import mapped, written

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers; beyond it, it forgets all and starts again.
CACHE_WORDS = 250_000
#: Longer ones, such as texts without spaces, are not remembered; so the memory is bounded in bytes too.
CACHE_LENGTH = 64
PIECE = "doc_id {key}, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Characters whose treatment below surely equals the tokenizer's: printable ASCII, ASCII white space
#: and the letters and signs of Latin Extended-A, but for the capital dotted I, which lower-cases to two.
UNSURE = re.compile(r"[^\t-\r\x20-\x7e\xa1\xab\xbb\xbf-\u012f\u0131-\u017f]")
#: The tokenizer's own split, for such characters.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: The printable stand-ins of bytes in byte-level vocabularies: a byte that is no visible Latin-1 character gets one past 255.
VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
STAND_IN = {b: chr(b) for b in VISIBLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(VISIBLE))}


class Words(dict):
    """Lower-case words of sure characters to their ids; what is not yet there is worked out."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        tokens = SPLIT.findall(word)
        if len(tokens) > 1:
            data = b"".join([self[t] for t in tokens])
        else:
            shown = word if word.isascii() else "".join([STAND_IN[b] for b in word.encode()])
            data = array("I", [t.id for t in self.merge(shown)]).tobytes()
        if len(word) <= CACHE_LENGTH:
            self[word] = data
        return data


class Encoder:
    """Texts to their ids as little-endian unsigned 32-bit bytes, each distinct word encoded once.

    Nothing in the tokenizer joins what ASCII white space separates. A text of sure characters is
    split here and its words go to the tokenizer's merges; a piece with any other character, or with
    what may be a special token, goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Words(self.tokenizer.model.tokenize)
        self.odd: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        if len(self.odd) > CACHE_WORDS:
            self.odd.clear()
        if not UNSURE.search(text) and "<|" not in text:
            return self._sure(text)
        out = []
        for sure, pieces in groupby(BLANK.split(text), lambda p: not UNSURE.search(p) and "<|" not in p):
            if sure:
                out.append(self._sure(" ".join(pieces)))
            else:
                out += [self.odd.get(p) or self._odd(p) for p in pieces]
        return b"".join(out)

    def _sure(self, text: str) -> bytes:
        known = self.known
        return b"".join([known[w] for w in text.lower().split()])

    def _odd(self, piece: str) -> bytes:
        data = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= CACHE_LENGTH:
            self.odd[piece] = data
        return data


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


BLANK = re.compile(r"[\t-\r ]+")


def pieces(documents: DataFrame, *, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids_crc32, part, rank_in_part (and ids).

    Each document ends with id 0; only those longer than capacity are cut. Null text is empty, so
    it is one piece with the single id 0. Repeated rows give repeated pieces.
    """
    path = tokenizer or tokenizer_path()
    key = documents.schema["doc_id"].dataType.simpleString()
    schema = PIECE.format(key=key) + (", ids array<int>" if with_ids else "")
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, which, ids = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = encode(text or "") + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((piece, at // 4, n, zlib.crc32(own), part, seen[n]))
                    seen[n] += 1
                    which.append(i)
                    if with_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int32))
            table = np.array(rows, np.int64).reshape(-1, 6).T
            arrays = [batch.column("doc_id").take(pa.array(which, pa.int32())), pa.array(table[0], pa.int32()), *(pa.array(x) for x in table[1:4]), pa.array(table[4], pa.int32()), pa.array(table[5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank_in_part"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return mapped(documents.select("doc_id", "text"), cut, schema)


def fullest(counts: dict[int, int], capacity: int, ceiling: int) -> list[int]:
    """The lengths of the fullest feasible combination, of those that hold a longest piece left.

    Bit s of a layer says that some choice among the lengths so far sums to s. The walk back through
    the layers reads off the choice. `ceiling` is the longest length left.
    """
    room = capacity - ceiling
    layers, reach, mask = [], 1, (1 << (room + 1)) - 1
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left = counts[length] - (length == ceiling)
        before, step = reach, 1
        most = min(left, room // length)
        while most > 0:  # counts in powers of two: any number up to `most` can be formed
            take = min(step, most)
            reach |= (reach << (take * length)) & mask
            layers.append((length, take, before))
            before, most, step = reach, most - take, step * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = [ceiling]
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            chosen += [length] * take
            total -= take * length
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how often, lengths in a bin) for all pieces of the histogram."""
    counts = {n: c for n, c in histogram.items() if c}
    out = []
    while counts:
        bin_lengths = fullest(counts, capacity, max(counts))
        used: dict[int, int] = {}
        for n in bin_lengths:
            used[n] = used.get(n, 0) + 1
        times = min(counts[n] // k for n, k in used.items())
        out.append((times, sorted(bin_lengths, reverse=True)))
        for n, k in used.items():
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
    return out


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, list[int]]]:
    """(length, first rank, first bin, pieces of the length in a bin, their offsets in the bin)."""
    out, ranks, bins = [], {}, 0
    for times, lengths in patterns:
        places: dict[int, list[int]] = {}
        at = 0
        for n in lengths:
            places.setdefault(n, []).append(at)
            at += n
        for n, offsets in places.items():
            out.append((n, ranks.get(n, 0), bins, len(offsets), offsets))
            ranks[n] = ranks.get(n, 0) + times * len(offsets)
        bins += times
    return out


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset. `cut` is read twice, so it is to be a stored table."""
    per_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    by_length: dict[int, list] = {}
    for n, rank, first_bin, k, places in slots(plan(histogram, capacity)):
        by_length.setdefault(n, []).append((rank, first_bin, k, places))
    table = {n: (np.array([x[0] for x in rows], np.int64), rows) for n, rows in by_length.items()}
    shared = cut.sparkSession.sparkContext.broadcast(table)  # the plan's size follows capacity, not the corpus
    ranked = cut.join(offsets, ["length", "part"]).withColumn("rank_in_length", F.col("earlier") + F.col("rank_in_part")).drop("earlier", "part", "rank_in_part")
    names = [c for c in cut.columns if c not in ("part", "rank_in_part")]
    ranked = ranked.select(*names, "rank_in_length")
    schema = T.StructType([*ranked.select(*names).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank_in_length").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                starts, rows = shared.value[int(n)]
                of = np.flatnonzero(lengths == n)
                which = np.searchsorted(starts, ranks[of], side="right") - 1
                for w in np.unique(which):
                    rank, first_bin, k, places = rows[w]
                    here = of[which == w]
                    turn, slot = np.divmod(ranks[here] - rank, k)
                    sequence[here] = first_bin + turn
                    offset[here] = np.array(places)[slot]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return mapped(ranked, locate, schema)


def pack(documents: DataFrame, *, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    No sequence exceeds capacity, offsets are gapless from 0. No documents give no rows.
    """
    return place(written(pieces(documents, capacity=capacity, tokenizer=tokenizer, with_ids=with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its whole ids, from pack(with_ids=True). A group holds one sequence at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
