"""Label dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes and their Norwegian labels.
CATEGORY_LABELS = {
    "sports": "Sport", "culture": "Kultur", "politics": "Politikk", "economy": "Økonomi",
    "science": "Vitenskap", "health": "Helse", "technology": "Teknologi", "local": "Distrikt",
    "world": "Utenriks", "crime": "Krim", "weather": "Vær", "entertainment": "Underholdning",
    "other": "Annet",
}
TYPE_LABELS = {
    "factual_error": "Faktafeil", "wrong_name": "Feil navn", "wrong_number": "Feil tall",
    "wrong_image": "Feil bilde", "wrong_date": "Feil dato", "wrong_location": "Feil sted",
    "mistranslation": "Feil oversettelse", "misleading_title": "Villedende tittel",
    "missing_context": "Manglende kontekst", "source_error": "Kildefeil",
    "retracted_claim": "Tilbaketrukket påstand", "spelling_grammar": "Skrivefeil/språk",
    "attribution_error": "Attribusjonsfeil", "other": "Annet",
}
MONTHS = ("januar", "februar", "mars", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "desember")


def dimension(spark: SparkSession, labels: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(labels.items()), "code string, label string")


def label_of(code: Column, labels: dict[str, str], *, fallback: bool) -> Column:
    """The label of a code; without one, the code itself (fallback) or null."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), code)
    return F.coalesce(found, code) if fallback else found
