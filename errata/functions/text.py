"""Scalar functions as Column expressions. None of them runs Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from errata.functions.labels import MONTHS
from errata.functions.lexicon import NORWEGIAN, SECTIONS, TITLE_SUFFIXES, Lexicon, any_of

MAX_BLOCK = 2000
#: Longer than any start of a block that is looked for, in characters before lower-casing.
MAX_START = 100
MAX_HOURS = 24 * 365 * 5


def either(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def blank(column: Column) -> Column:
    """Whether the value is null or the empty string."""
    return column.isNull() | (column == "")


def blank_coalesce(*columns: Column) -> Column:
    """The first value that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def strip(text: Column) -> Column:
    """Without any Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+$", "")


# ---- triggers --------------------------------------------------------------------------------------


def has_trigger(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    return F.lower(text).rlike(lexicon.pattern)


def is_noise(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    return F.lower(F.substring(text, 1, MAX_START)).rlike("^" + any_of(lexicon.noise))


def usable_block(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    return F.length(text).between(1, MAX_BLOCK) & ~is_noise(text, lexicon)


def bound(value: Column, use) -> Column:
    """use(value), in which value is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _place(text: Column, pattern: str) -> Column:
    """1-based place of the first match, else 0: what lies before it is the first of two parts."""
    return bound(F.split(text, pattern, 2), lambda parts: F.when(F.size(parts) > 1, F.length(F.get(parts, F.lit(0))) + 1).otherwise(0))


def _bare_position(lowered: Column, lexicon: Lexicon) -> Column:
    """1-based place of the first bare word that stands alone, else 0."""
    return _place(lowered, lexicon.alone_pattern)


def phrase_position(lowered: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """1-based place of the earliest phrase, else 0."""
    return _place(lowered, any_of(lexicon.phrases)) if lexicon.phrases else F.lit(0)


def trigger_position(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """1-based place of the earliest phrase or, only if there is none, of the first bare word; else 0."""

    def of(lowered: Column) -> Column:
        return bound(phrase_position(lowered, lexicon), lambda phrase: F.when(phrase > 0, phrase).otherwise(_bare_position(lowered, lexicon)))

    return bound(F.lower(text), of)


def _cut(text: Column, chunk: Column, tail: Column) -> Column:
    """The tail and, of the chunk before it, what belongs to the tail's sentence."""
    after_stop, after_dot, after_line = (F.substring_index(chunk, mark, -1) for mark in (". ", ".", "\n"))
    return (
        F.when(F.contains(chunk, F.lit(". ")), F.concat(after_stop, tail))
        .when(F.endswith(chunk, F.lit(".")), tail)
        .when(F.contains(chunk, F.lit(".")) & after_dot.rlike("^[A-ZÆØÅ]"), F.concat(after_dot, tail))
        .when(F.contains(chunk, F.lit("\n")), F.concat(after_line, tail))
        .otherwise(text)
    )


def trim_to_correction(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """The text from the start of the sentence that holds the trigger; a single pass, not idempotent."""

    def of(place: Column) -> Column:
        chunk, tail = F.substring(text, F.lit(1), place - 1), F.substring(text, place, F.length(text))
        cut = bound(chunk, lambda c: strip(_cut(text, c, tail)))
        return F.when(place == 0, text).otherwise(bound(cut, lambda c: F.when(c == "", text).otherwise(c)))

    started = F.lower(F.substring(text, 1, MAX_START)).rlike("^" + any_of(lexicon.good_starts))
    return F.when(started, text).otherwise(bound(trigger_position(text, lexicon), of))


def starts_with_trigger(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """A trigger that begins within the first 50 characters and ends within the first 80."""
    head = F.lower(F.substring(text, 1, 80))
    phrases = either(F.locate(p, head).between(1, 50) for p in lexicon.phrases)
    return phrases | _bare_position(head, lexicon).between(1, 50)


def looks_complete(text: Column) -> Column:
    # What is looked for at the end has five characters at most.
    return F.substring(rstrip(text), -8, 8).rlike(r"""([.!?)»"]|\d{2}\.\d{2}|\d{4})$""")


def needs_refetch(text: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    return F.coalesce(blank(text) | ~starts_with_trigger(text, lexicon) | ~looks_complete(text), F.lit(True))


def is_better(new: Column, old: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """New text that gains a trigger at its start, or completeness."""
    was = F.coalesce(old, F.lit(""))
    gains = starts_with_trigger(new, lexicon) & ~starts_with_trigger(was, lexicon)
    completes = looks_complete(new) & ~looks_complete(was)
    return ~blank(new) & (gains | completes)


# ---- URLs ------------------------------------------------------------------------------------------


def in_sections(url: Column, sections: tuple[str, ...] = SECTIONS) -> Column:
    return url.rlike(any_of(sections))


def url_section(url: Column, site: str = "www.nrk.no", unknown: str = "ukjent") -> Column:
    """The first path segment below the site; a foreign address gives its own first part."""
    path = F.replace(F.replace(url, F.lit(f"https://{site}/"), F.lit("")), F.lit(f"http://{site}/"), F.lit(""))
    first = F.when(F.contains(path, F.lit("/")), F.split_part(path, F.lit("/"), F.lit(1))).otherwise(F.split_part(path, F.lit("?"), F.lit(1)))
    return F.coalesce(F.nullif(first, F.lit("")), F.lit(unknown))


def quoted_query(phrase: Column) -> Column:
    """The phrase in double quotes, percent-encoded."""
    encoded = F.url_encode(F.concat(F.lit('"'), phrase, F.lit('"')))
    return F.replace(F.replace(F.replace(encoded, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%2F"), F.lit("/"))


# ---- dates and durations ---------------------------------------------------------------------------


def iso_timestamp(text: Column) -> Column:
    """An ISO date or date and time; without an offset it is UTC (the session's zone is to be UTC).
    Null if it is none."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def hours_between(published: Column, corrected: Column) -> Column:
    """Hours from publication to correction, both ISO texts; a date only counts as noon UTC. Null if
    blank, unparsable, negative or more than five years."""
    noon = F.when(F.length(corrected) == 10, F.concat(corrected, F.lit("T12:00:00+00:00"))).otherwise(corrected)
    return valid_hours(iso_timestamp(published), iso_timestamp(noon))


def valid_hours(start: Column, end: Column) -> Column:
    hours = F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)
    return F.when(hours.between(0, MAX_HOURS), F.round(hours, 2))


def rounded(value: Column, digits: int = 0) -> Column:
    """Halves upwards, as a double."""
    return F.floor(value * 10**digits + 0.5) / 10**digits


def month_of(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM")


def year_of(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy")


def duration_label(hours: Column) -> Column:
    whole, days = F.floor(hours + 0.5), F.floor(hours / 24 + 0.5)
    return (
        F.when(hours.isNull(), None)
        .when(hours < 1, "Under 1 time")
        .when(hours < 24, F.when(whole == 1, "1 time").otherwise(F.concat(whole.cast("string"), F.lit(" timer"))))
        .otherwise(F.when(days == 1, "1 dag").otherwise(F.concat(days.cast("string"), F.lit(" dager"))))
    )


def long_date(text: Column) -> Column:
    """Day, month name and year; a text that is no date stays as it is, null is empty."""
    stamp = iso_timestamp(text)
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(stamp))
    shown = F.concat_ws(" ", F.concat(F.dayofmonth(stamp).cast("string"), F.lit(".")), name, F.year(stamp).cast("string"))
    return F.when(stamp.isNotNull(), shown).otherwise(F.coalesce(text, F.lit("")))


# ---- markup and JSON -------------------------------------------------------------------------------


def html_escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def without_suffixes(title: Column, suffixes: tuple[str, ...] = TITLE_SUFFIXES) -> Column:
    """Each suffix taken off once, in order."""
    for suffix in suffixes:
        title = F.when(F.endswith(title, F.lit(suffix)), F.substring(title, F.lit(1), F.length(title) - len(suffix))).otherwise(title)
    return title


def without_fence(text: Column) -> Column:
    """A Markdown code fence around the text taken off."""
    bare = strip(text)
    opened = F.regexp_replace(bare, r"^```[^\n]*\n?", "")
    closed = F.regexp_replace(opened, r"\n?[ \t]*```[ \t]*$", "")
    return F.when(bare.startswith("```"), strip(closed)).otherwise(bare)


def json_object(text: Column) -> Column:
    """The text as a variant if it is a JSON object, else null."""
    parsed = F.try_parse_json(text)
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
