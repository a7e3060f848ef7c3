"""Schemas of the stored tables."""

from __future__ import annotations

RAW_DDL = (
    "id bigint, date string, title string, what string, correction_text_raw string, correction string, url string, "
    "auto boolean, source string, qa_status string, headline string, nrk_section string, publication_date string, "
    "modified_date string, intro_text string, journalist string, responsible_editor string, article_body string, "
    "correction_description string, correction_text_extract string, correction_date string, news_category string, "
    "correction_type string, time_to_correct_hours double, extra map<string,string>"
)
#: The published view, in order.
PUBLISHED = (
    "id", "url", "date", "title", "headline", "correction", "correction_text_raw", "correction_description",
    "correction_text_extract", "correction_date", "qa_status", "nrk_section", "publication_date", "modified_date",
    "news_category", "correction_type", "journalist", "responsible_editor", "time_to_correct_hours", "auto", "source",
)
DEAD_LETTER_DDL = "url string, error string, timestamp string, retry_count int, last_error string, last_retry string"
CHECKPOINT_DDL = "completed_sitemaps array<string>"
SITEMAP_DDL = "loc string, lastmod string"
RESPONSE_FIELDS = (
    "qa_status", "correction_description", "correction_text_extract", "correction_date",
    "news_category", "correction_type", "journalist", "responsible_editor",
)
