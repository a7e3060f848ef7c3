"""What is taken from a parsed page, in Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errata.functions.lexicon import NEXT_PAGE, NORWEGIAN, SECTIONS, Lexicon
from errata.functions.text import blank_coalesce, bound, has_trigger, in_sections, is_noise, strip, trim_to_correction, url_section, usable_block, without_suffixes


def distinct_blocks(blocks: Column) -> Column:
    """Longest first (in order, if as long); without those that a kept one contains."""
    longest_first = F.array_sort(blocks, lambda a, b: F.length(b) - F.length(a))

    def keep(kept: Column, block: Column) -> Column:
        return F.when(F.exists(kept, lambda k: F.contains(k, block)), kept).otherwise(F.concat(kept, F.array(block)))

    return F.aggregate(longest_first, F.array().cast("array<string>"), keep)


def correction_blocks(page: Column, lexicon: Lexicon = NORWEGIAN, *, trim: bool = True) -> Column:
    """The usable blocks with a trigger, in the order of the passes; <div>s only if the others have none."""

    def good(which) -> Column:
        return F.filter(page["blocks"], lambda b: which(b["pass"]) & usable_block(b["text"], lexicon) & has_trigger(b["text"], lexicon))

    def in_order(blocks: Column) -> Column:
        return F.concat(F.filter(blocks, lambda b: b["pass"] == 1), F.filter(blocks, lambda b: b["pass"] == 2))

    first = good(lambda number: number < 3)
    found = bound(first, lambda blocks: F.when(F.size(blocks) > 0, in_order(blocks)).otherwise(good(lambda number: number == 3)))
    return F.transform(found, lambda b: trim_to_correction(b["text"], lexicon) if trim else b["text"])


def correction_text(page: Column, lexicon: Lexicon = NORWEGIAN, *, trim: bool = True) -> Column:
    """The blocks joined by ' | ', or null if there are none."""
    return bound(correction_blocks(page, lexicon, trim=trim), lambda blocks: F.when(F.size(blocks) > 0, F.array_join(distinct_blocks(blocks), " | ")))


def standalone_text(page: Column, lexicon: Lexicon = NORWEGIAN) -> Column:
    """For a page that is a correction as a whole: its first paragraphs of over 20 characters."""
    good = F.filter(page["paragraphs"], lambda t: (F.length(t) > 20) & ~is_noise(t, lexicon))
    return F.nullif(F.substring(F.array_join(F.slice(good, 1, 6), " "), 1, 800), F.lit(""))


def page_title(page: Column) -> Column:
    """The first heading, else the title without the site's name."""
    title = F.substring(strip(without_suffixes(page["title"])), 1, 200)
    return F.coalesce(F.substring(page["h1"], 1, 200), title, F.lit(""))


def published(page: Column) -> Column:
    return F.coalesce(page["time"], F.try_element_at(page["metas"], F.lit("article:published_time")), F.lit(""))


def responsible_editor(page: Column) -> Column:
    capital = "[A-ZÆØÅ][a-zæøå]+"
    return F.regexp_extract(page["spaced_text"], rf"(?U)Ansvarlig\s+redakt[øo]r[:\s]+({capital}(?: {capital}){{1,4}})", 1)


def metadata(page: Column, url: Column) -> Column:
    """headline, nrk_section, publication_date, modified_date, intro_text, journalist,
    responsible_editor and article_body; what is missing is empty."""

    def meta(name: str) -> Column:
        return strip(F.nullif(F.try_element_at(page["metas"], F.lit(name)), F.lit("")))

    none = F.lit("")
    return F.struct(
        F.coalesce(F.substring(meta("og:title"), 1, 300), F.substring(page["h1"], 1, 300), none).alias("headline"),
        url_section(url).alias("nrk_section"),
        F.coalesce(meta("article:published_time"), none).alias("publication_date"),
        F.coalesce(meta("article:modified_time"), none).alias("modified_date"),
        F.coalesce(F.substring(meta("og:description"), 1, 500), none).alias("intro_text"),
        F.coalesce(blank_coalesce(page["author"], F.substring(page["byline"], 1, 100)), none).alias("journalist"),
        responsible_editor(page).alias("responsible_editor"),
        F.substring(page["article_body"], 1, 20000).alias("article_body"),
    )


def candidate_links(pages: DataFrame, *, site: str = "https://www.nrk.no/", sections: tuple[str, ...] = SECTIONS, search: str = "/sok/") -> DataFrame:
    """(all columns but page, pos, href) of links to articles on parsed search pages."""
    others = [c for c in pages.columns if c != "page"]
    links = pages.select(*others, F.posexplode("page.links").alias("pos", "link")).select(*others, "pos", F.col("link.href").alias("href"))
    href = F.col("href")
    return links.filter(href.startswith(site) & (href != site) & ~F.contains(href, F.lit(search)) & in_sections(href, sections))


def has_next(page: Column, label: str = NEXT_PAGE) -> Column:
    return F.exists(page["links"], lambda link: link["text"] == label)


def detect(pages: DataFrame, lexicon: Lexicon = NORWEGIAN, *, trim: bool = True, standalone: Column | None = None) -> DataFrame:
    """Parsed pages (url, page) whose text has a trigger and in which a correction is found:
    url, title, published, correction."""
    page = F.col("page")
    found = correction_text(page, lexicon, trim=trim)
    if standalone is not None:
        found = F.when(standalone, standalone_text(page, lexicon)).otherwise(found)
    # Exploding an array of one or none keeps the text from being worked out again for a filter.
    one = F.explode(F.array_compact(F.array(found)))
    return pages.filter(has_trigger(page["page_text"], lexicon)).select("url", page_title(page).alias("title"), published(page).alias("published"), one.alias("correction"))
