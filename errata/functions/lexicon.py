"""Lexicons: what marks a correction, what is navigation, which sections count."""

from __future__ import annotations

import re
from dataclasses import dataclass

# The Norwegian phrases, prefixes and sections that results depend on.
PHRASES = (
    "i en tidligere versjon", "i en eldre versjon", "i en tidligere publisert versjon",
    "nrk retter", "nrk har rettet", "nrk korrigerer", "nrk beklager",
    "rettelse:", "retting:", "korrigering:", "presisering:",
    "endringen er gjort", "endringane er gjort", "endringane vart gjort",
    "det er gjort endringar", "vi har rettet",
    "artikkelen er oppdatert", "artikkelen er endra",
    "tidligere skrev vi", "etter publisering",
)
BARE_WORDS = ("rettelse", "retting")
GOOD_STARTS = ("rettels", "retting", "presisering", "korrigering")
NOISE = ("hopp til innhold", "nrk tv", "nrk radio", "nrk super", "nrk p3", "siste meldinger")
SECTIONS = (
    "/nyheter/", "/sport/", "/kultur/", "/urix/", "/norge/",
    "/nordland/", "/vestland/", "/rogaland/", "/innlandet/",
    "/trondelag/", "/troms/", "/finnmark/", "/ostfold/",
    "/buskerud/", "/telemark/", "/agder/", "/mr/", "/sognogfjordane/",
    "/hordaland/", "/stfold/", "/akershus/", "/stor-oslo/",
    "/ytring/", "/nyttig/", "/livsstil/", "/sapmi/",
    "/vestfoldogtelemark/", "/tromsogfinnmark/", "/vestfold/",
    "/sorlandet/", "/osloogviken/", "/ostlandssendingen/",
    "/viten/", "/dokumentar/", "/klima/",
)
TITLE_SUFFIXES = (" – NRK", " - NRK", " | NRK")
NEXT_PAGE = "Neste side"
PLACEHOLDER = "ikke tilgjengelig"


def any_of(values: tuple[str, ...]) -> str:
    """A pattern that matches any of the values literally."""
    return "(" + "|".join(re.escape(v) for v in values) + ")"


@dataclass(frozen=True)
class Lexicon:
    """phrases count wherever they stand, bare words only as whole words; all are lower case."""

    phrases: tuple[str, ...] = PHRASES
    bare: tuple[str, ...] = BARE_WORDS
    good_starts: tuple[str, ...] = GOOD_STARTS
    noise: tuple[str, ...] = NOISE

    @property
    def bare_pattern(self) -> str:
        """Word boundaries spelt out, so that every regular expression engine agrees on them."""
        return rf"(^|[^\p{{L}}\p{{N}}_]){any_of(self.bare)}($|[^\p{{L}}\p{{N}}_])" if self.bare else "a^"

    @property
    def alone_pattern(self) -> str:
        """The bare words alone, without what stands around them; for Spark's regular expressions."""
        return rf"(?<![\p{{L}}\p{{N}}_]){any_of(self.bare)}(?![\p{{L}}\p{{N}}_])" if self.bare else "a^"

    @property
    def pattern(self) -> str:
        return f"{any_of(self.phrases)}|{self.bare_pattern}" if self.phrases else self.bare_pattern


NORWEGIAN = Lexicon()
