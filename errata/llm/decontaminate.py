"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are put, one after the other, into one suffix automaton over
words. Documents stream through it: for every word the automaton gives the length of the longest
suffix read so far that occurs in some item. Where that length reaches the window, the words of
the window are hit. An item shorter than the window counts as a window of its own.

Scale: documents are never shuffled and are read once. Automata are broadcast, and their size is
checked: items are dealt, as the driver reads them one by one, into blocks of at most `block_words`
words. A worker takes the blocks one after the other for each CHUNK of texts, holds one at a time, and
merges their hits where the texts are. An item longer than a block is cut into overlapping parts, so
that no window is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.llm.common import mapped

#: A word before lower-casing.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: A-Z become a-z; bytes that are no part of a word become spaces.
BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WINDOW = 10
#: About 400 bytes of a Python worker's memory for each word.
BLOCK_WORDS = 150_000
#: Bytes of texts for which a worker takes all blocks in turn, if there are several.
CHUNK = 16 << 20


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of ASCII digits, ASCII letters and anything above ASCII."""
    return text.encode().translate(BYTES).split() if text else []


class SuffixAutomaton:
    """A generalised suffix automaton over word sequences, frozen for scanning.

    `target[v]` is the state of the last `window` words when at state v the match is at least that
    long (else -1); `items_at` maps such states to the items that hold these words; `short_at`
    maps a state to the (length, item) pairs of the items below the window that end there.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.moves: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        owners: list[set[int]] = [set()]
        ends: list[tuple[int, int, int]] = []
        for number, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word, owners)
                owners[last].add(number)
            if 0 < len(words) < window:
                ends.append((last, len(words), number))
        self.least = min([window, *(size for _, size, _ in ends)])
        self._freeze(owners, ends)

    def _new(self, moves, link, length, owners):
        self.moves.append(moves)
        self.link.append(link)
        self.length.append(length)
        owners.append(set())
        return len(self.moves) - 1

    def _split(self, state, word, owners):
        """The state that holds exactly the words of `state` followed by `word`, as the longest."""
        after = self.moves[state][word]
        if self.length[after] == self.length[state] + 1:
            return after
        copy = self._new(dict(self.moves[after]), self.link[after], self.length[state] + 1, owners)
        self.link[after] = copy
        while state >= 0 and self.moves[state].get(word) == after:
            self.moves[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last, word, owners):
        if word in self.moves[last]:
            return self._split(last, word, owners)
        state = self._new({}, 0, self.length[last] + 1, owners)
        at = last
        while at >= 0 and word not in self.moves[at]:
            self.moves[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word, owners)
        return state

    def _freeze(self, owners, ends):
        window, link, length = self.window, self.link, self.length
        order = sorted(range(1, len(link)), key=length.__getitem__)
        self.target = [-1] * len(link)
        for v in order:
            if length[v] >= window:
                self.target[v] = v if length[link[v]] < window else self.target[link[v]]
        for v in reversed(order):
            if length[link[v]] >= window:
                owners[link[v]] |= owners[v]
        self.items_at = {v: tuple(owners[v]) for v in order if self.target[v] == v}
        own: dict[int, list[tuple[int, int]]] = {}
        for v, size, number in ends:
            own.setdefault(v, []).append((size, number))
        self.short_at: dict[int, tuple[tuple[int, int], ...]] = {}
        if own:
            for v in order:
                if found := (*self.short_at.get(link[v], ()), *own.get(v, ())):
                    self.short_at[v] = found

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int], int]:
        """Hit spans (merged word ranges, end exclusive), items found, longest match.

        A word that is in no item takes the automaton back to its root, so only runs of at least
        `least` words that are in items are walked through.
        """
        spans: list[list[int]] = []
        states: set[int] = set()
        items: set[int] = set()
        longest = 0
        if len(words) >= self.least:
            known = bytes(map(self.moves[0].__contains__, words))
            run = b"\x01" * self.least
            start = known.find(run)
            while start >= 0:
                end = known.find(b"\x00", start)
                end = len(words) if end < 0 else end
                longest = max(longest, self._walk(words, start, end, spans, states, items))
                start = known.find(run, end)
        for v in states:
            items.update(self.items_at[v])
        return spans, items, longest

    def _walk(self, words, start, end, spans, states, items) -> int:
        moves, link, length, short_at, window = self.moves, self.link, self.length, self.short_at, self.window
        state = size = longest = 0
        for at in range(start, end):
            word = words[at]
            while word not in moves[state]:
                state = link[state]
                size = length[state]
            state = moves[state][word]
            size += 1
            first = at + 1
            if size >= window:
                longest = max(longest, size)
                states.add(self.target[state])
                first = at + 1 - window
            for short, number in short_at.get(state, ()):
                if short <= size:
                    items.add(number)
                    first = min(first, at + 1 - short)
                    longest = max(longest, short)
            if first <= at:
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = at + 1
                else:
                    spans.append([first, at + 1])
        return longest


def blocks_of(items: DataFrame, id_column: str, window: int, block_words: int) -> Iterator[tuple[list, list]]:
    """Item ids as text and (number, words) pairs, in blocks of at most block_words words."""
    ids: list[str] = []
    parts: list[tuple[int, list[bytes]]] = []
    used = 0
    rows = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), "text").toLocalIterator()
    for row in rows:
        words = words_of(row["text"])
        step = block_words - window + 1
        cuts = [words] if len(words) <= block_words else [words[i : i + block_words] for i in range(0, len(words) - window + 1, step)]
        for part in cuts:
            if not part:
                continue
            if parts and used + len(part) > block_words:
                yield ids, parts
                ids, parts, used = [], [], 0
            ids.append(row["id"])
            parts.append((len(ids) - 1, part))
            used += len(part)
    if parts:
        yield ids, parts


FOUND = T.StructType(
    [
        T.StructField("errata_n_words", T.LongType()),
        T.StructField("errata_spans", T.ArrayType(T.IntegerType())),
        T.StructField("errata_items", T.ArrayType(T.StringType())),
        T.StructField("errata_longest", T.LongType()),
    ]
)
FOUND_ARROW = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64())


def _merge_spans(pairs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _machine(shared):
    """A broadcast block of a pass; what a worker held of the block before is let go."""
    for other in list(_HELD):
        if other is not shared:
            vars(other).pop("_value", None)
            _HELD.remove(other)
    _HELD.append(shared)
    return shared.value


#: The broadcast that a worker holds the automaton of, while there are several.
_HELD: list = []


def _found(texts: list[list[str | None]], blocks: list) -> Iterator[list[tuple]]:
    """For each list of texts (n_words, flat spans, items, longest) over all blocks, one after the other."""
    words = [[words_of(t) for t in part] for part in texts]
    spans, items, longest = ([[first() for _ in part] for part in words] for first in (list, set, int))
    for shared in blocks:
        machine, names = _machine(shared)
        for p, part in enumerate(words):
            for i, own in enumerate(part):
                hit, found, most = machine.scan(own)
                spans[p][i] += hit
                items[p][i].update(names[n] for n in found)
                longest[p][i] = max(longest[p][i], most)
    for p, part in enumerate(words):
        merged = (s if len(blocks) < 2 else _merge_spans(s) for s in spans[p])
        yield [(len(w), list(chain.from_iterable(s)), sorted(x), n) for w, s, x, n in zip(part, merged, items[p], longest[p], strict=True)]


def _scan(documents: DataFrame, benchmark: DataFrame, item_key: str, window: int, block_words: int, then=None, schema: T.StructType | None = None) -> DataFrame:
    """documents, all columns, with those of FOUND over all blocks; or what `then` makes of such a batch,
    with its schema. Documents are read once, whatever the number of blocks."""
    context = documents.sparkSession.sparkContext
    blocks = [context.broadcast((SuffixAutomaton(parts, window), ids)) for ids, parts in blocks_of(benchmark, item_key, window, block_words)]
    together = CHUNK if len(blocks) > 1 else 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for batch, rows in zip(held, _found([b.column("text").to_pylist() for b in held], blocks), strict=True):
                added = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(FOUND_ARROW)]
                found = pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *FOUND.names])
                yield then(found) if then else found

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > together:
                yield from out()
                held, size = [], 0
        yield from out()

    return mapped(documents, scan, schema or T.StructType([*documents.schema.fields, *FOUND.fields]))


def scan_documents(documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", item_key: str = "item_id", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: doc_id, n_words, spans (flat word ranges, end exclusive), items, longest.

    Null or empty texts have no words and no hits. Items without words are no windows. Items that
    repeat count once by id. An empty benchmark gives rows without hits, an empty corpus no rows.
    Repeated document rows give repeated result rows. Columns besides the two used are ignored.
    """
    found = _scan(documents.select(F.col(key).alias("doc_id"), "text"), benchmark, item_key, window, block_words)
    return found.select("doc_id", *[F.col(c).alias(c.removeprefix("errata_")) for c in FOUND.names])


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of scan_documents(): doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan_documents(documents, benchmark, **options)
    spans = F.col("spans")
    hits = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0), lambda total, x: total + x)
    return found.select(
        "doc_id",
        "n_words",
        hits.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"),
    )


def remove_spans(text: str | None, spans: list[int]) -> str | None:
    """The text without the characters of the hit word ranges (and the gaps inside a range)."""
    if not text or not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for first, last in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, item_key: str = "item_id", window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without the spans that repeat a benchmark item.

    A document whose hit words exceed max_coverage of its words is dropped whole; the others lose
    the hit spans and keep all their columns, with n_chars (if there is one) counted anew. Clean
    documents, null and empty texts pass unchanged.
    """
    names = documents.columns

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {n: batch.column(n) for n in names}
        texts, keep, counts = [], [], columns["n_chars"].to_pylist() if "n_chars" in columns else None
        for i, (text, n, spans) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "errata_n_words", "errata_spans")), strict=True)):
            hit = sum(spans[1::2]) - sum(spans[::2])
            keep.append(hit <= max_coverage * n)
            texts.append(remove_spans(text, spans) if keep[-1] else text)
            if hit and counts is not None:
                counts[i] = len(texts[-1])
        columns["text"] = pa.array(texts, columns["text"].type)
        if counts is not None:
            columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array(keep, pa.bool_()))

    return _scan(documents, benchmark, item_key, window, block_words, clean, documents.schema)
