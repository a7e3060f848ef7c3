"""License scans by conditional compression.

A candidate block is the text around a word that licence texts use. It is compressed alone and with
each template as raw zstandard dictionary; what a template saves, relative to the template's own
compressed size, ranks the templates. They are confirmed by their exact wording: the differences
between the template's words and the block's, which are reported, may not exceed a share.

Scale: a map over documents. A block is bounded by the longest template, so a very long document is
many small blocks, and its whole text is searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.llm.common import mapped
from errata.llm.license_texts import TEMPLATES

CUE = re.compile(r"licen[cs]e|permission|copyright|redistribut|rights\s+reserved|public\s+domain", re.I)
WORD = re.compile(r"\w+(?:[.\-/]\w+)*")
#: The share of a template's words that may be missing, changed or interrupted.
DIFFERENCES = 0.1
#: The least saving, relative to the template's own size, of a template that is looked at.
SAVING = 0.08


def _words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), *m.span()) for m in WORD.finditer(text)]


class Hit(NamedTuple):
    """A template's place in characters, its number of differing words, its saving, and these words."""

    name: str
    start: int
    end: int
    differences: int
    saving: float
    wording: str


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.words = {k: [w for w, _, _ in _words(v)] for k, v in templates.items()}
        #: Templates of like length share blocks of that length, in which they stand out.
        self.tiers: dict[int, list[str]] = {}
        for name, text in templates.items():
            self.tiers.setdefault(max(64, 1 << (len(text) - 1).bit_length()), []).append(name)
        self.plain = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self.given, self.own = {}, {}
        for name, text in templates.items():
            data = text.lower().encode()
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=19, dict_data=raw, write_content_size=False, write_dict_id=False)
            self.own[name] = len(self.plain.compress(data))

    def blocks(self, text: str, reach: int) -> Iterator[tuple[int, int]]:
        """Ranges around the cues, joined where they overlap. Empty lines don't end them: licences have paragraphs."""
        last = None
        for cue in CUE.finditer(text):
            start, end = max(0, cue.start() - reach), min(len(text), cue.end() + reach)
            if last and start <= last[1] and end - last[0] <= 4 * reach:
                last = (last[0], max(end, last[1]))
            else:
                if last:
                    yield last
                last = (start, end)
        if last:
            yield last

    def ranked(self, block: str, names: list[str]) -> list[tuple[float, str]]:
        """Templates by saving, the greatest first."""
        data = block.lower().encode()
        alone = len(self.plain.compress(data))
        savings = ((alone - len(self.given[n].compress(data))) / self.own[n] for n in names)
        return sorted(((s, n) for s, n in zip(savings, names, strict=True) if s >= SAVING), key=lambda x: (-x[0], x[1]))

    def wording(self, name: str, words: list[tuple[str, int, int]]) -> tuple[int, int, int] | None:
        """(first word, last word, differences) of a place of the template in the block, if it has one.

        A place is sought in line with the longest common run. A run that leads to none, such as a
        quotation's, is left out, and the next one is tried, down to the longest that a place can lack.
        """
        wanted = self.words[name]
        most = int(DIFFERENCES * len(wanted))
        own = [w for w, _, _ in words]
        while True:
            longest = SequenceMatcher(None, own, wanted, autojunk=False).find_longest_match()
            # `most` differences cut what is left of the template into at most one run more.
            if longest.size * (most + 1) < len(wanted) - most or not longest.size:
                return None
            run = own[longest.a : longest.a + longest.size]
            for b in range(len(wanted) - longest.size + 1):
                if wanted[b : b + longest.size] == run and (hit := self._place(wanted, words, longest.a, b, most)):
                    return hit
            own[longest.a : longest.a + longest.size] = ["\0"] * longest.size

    def _place(self, wanted: list[str], words: list[tuple[str, int, int]], a: int, b: int, most: int) -> tuple[int, int, int] | None:
        # Only the neighbourhood in which the template can lie, if its word b is the block's word a.
        slack = 2 + most
        first = max(0, a - b - slack)
        part = [w for w, _, _ in words[first : a + len(wanted) - b + slack]]
        runs = [m for m in SequenceMatcher(None, part, wanted, autojunk=False).get_matching_blocks() if m.size]
        if not runs:
            return None
        inside = sum(m.size for m in runs)
        span = runs[-1].a + runs[-1].size - runs[0].a
        differences = (len(wanted) - inside) + (span - inside)
        return (first + runs[0].a, first + runs[-1].a + runs[-1].size - 1, differences) if differences <= most else None

    def scan(self, text: str | None) -> list[Hit]:
        """The confirmed templates, in the order of their places.

        All places of a template in a block are found, the best first; of templates that overlap
        that stays which has the most words but for its differences.
        """
        found: list[Hit] = []
        for names, start, end in ((n, *b) for r, n in self.tiers.items() for b in self.blocks(text or "", r)):
            block = text[start:end]
            words = _words(block)
            for saving, name in self.ranked(block, names):
                rest = words
                while hit := self.wording(name, rest):
                    first, last, differences = hit
                    found.append(Hit(name, start + rest[first][1], start + rest[last][2], differences, saving, self.wanting(name, rest[first : last + 1])))
                    rest = rest[:first] + [("\0", 0, 0)] + rest[last + 1 :]
        found.sort(key=lambda x: (x.differences - len(self.words[x.name]), x.start, x.name))
        out: list[Hit] = []
        for hit in found:
            if not any(hit.start < o.end and o.start < hit.end for o in out):
                out.append(hit)
        return sorted(out, key=lambda x: x.start)

    def wanting(self, name: str, words: list[tuple[str, int, int]]) -> str:
        """The differences in wording: -words that the template has and the place has not, +words the other way."""
        wanted, own = self.words[name], [w for w, _, _ in words]
        out = []
        for tag, a, b, c, d in SequenceMatcher(None, wanted, own, autojunk=False).get_opcodes():
            if tag != "equal":
                out += [f"-{w}" for w in wanted[a:b]] + [f"+{w}" for w in own[c:d]]
        return " ".join(out)


@lru_cache(maxsize=4)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(templates))


def scan(documents: DataFrame, *, templates: dict[str, str] | None = None) -> DataFrame:
    """Per document row: doc_id and its licenses (name, start, end in characters, differences, saving, wording).

    Null, empty and unlicensed texts have none. Repeated rows give repeated results.
    """
    chosen = tuple(sorted((TEMPLATES if templates is None else templates).items()))
    kind = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("differences", T.IntegerType()), T.StructField("saving", T.DoubleType()), T.StructField("wording", T.StringType())]))
    arrow = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("differences", pa.int32()), ("saving", pa.float64()), ("wording", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scanner = _scanner(chosen)
            rows = [[hit._asdict() for hit in scanner.scan(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, arrow)], ["doc_id", "licenses"])

    slim = documents.select("doc_id", "text")
    return mapped(slim, find, T.StructType([slim.schema["doc_id"], T.StructField("licenses", kind)]))


def report(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_licenses, names (sorted, each once), spans name:start:end, the number
    of differing words in all, and for each licence that has any its name and these words."""
    found = F.col("licenses")
    return scan(documents).select(
        "doc_id",
        F.size(found).cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(found["name"])), ",").alias("names"),
        F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])), ",").alias("spans"),
        F.aggregate(found, F.lit(0), lambda n, x: n + x["differences"]).cast("long").alias("n_differences"),
        F.array_join(F.transform(F.filter(found, lambda x: x["differences"] > 0), lambda x: F.concat_ws(" ", x["name"], x["wording"])), "; ").alias("differences"),
    )
