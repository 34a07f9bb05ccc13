"""Coercion of model answers about countries, and the prompts that ask for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import strip_space

COUNTRY_ANSWER = "country string, countries_active array<string>, confidence string"
#: The confidences that count, the first being assumed.
CONFIDENCES = ("low", "medium", "high")
#: What is said of the text of each tier, and what is asked where the caller gives no instructions.
SOURCES_SAY = {
    "own_source": "What follows is an article on the organization itself.",
    "mentioned_in": "What follows are passages of other articles in which the organization is named.",
    "name_only": "There is no article; a short note is all that is known.",
}
INSTRUCTIONS = (
    "Say in which country the organization arose and in which countries it acts. Use names of countries, not of cities, regions or peoples; "
    'write Unknown where the text does not tell, and no guesses. Answer with one JSON object: {"country": text, "countries_active": list of texts, "confidence": low, medium or high}.'
)


def coerce_country(answer: Column) -> Column:
    """struct(country, countries_active, confidence) from a struct of COUNTRY_ANSWER, null for an answer that is none.

    A missing country is Unknown, a known one leads the active list, an odd confidence is low.
    """
    country = F.coalesce(F.nullif(strip_space(answer["country"]), F.lit("")), F.lit("Unknown"))
    active = F.filter(F.transform(F.coalesce(answer["countries_active"], F.array().cast("array<string>")), strip_space), lambda c: c != "")
    active = F.when((country != "Unknown") & ~F.array_contains(active, country), F.array_prepend(active, country)).otherwise(active)
    confidence = F.lower(strip_space(answer["confidence"]))
    confidence = F.when(confidence.isin(*CONFIDENCES), confidence).otherwise(CONFIDENCES[0])
    return F.struct(country.alias("country"), active.alias("countries_active"), confidence.alias("confidence"))


def country_prompt(name: Column, kind: Column, method: Column, text: Column, instructions: str = INSTRUCTIONS) -> Column:
    """The instructions, what is known of an entity, and its text."""
    says = F.create_map(*[F.lit(x) for pair in SOURCES_SAY.items() for x in pair])
    about = F.concat_ws("\n", F.concat(F.lit("Name: "), name), F.concat(F.lit("Kind: "), F.coalesce(F.nullif(kind, F.lit("")), F.lit("not known"))), F.coalesce(says[method], F.lit("")))
    return F.concat_ws("\n\n", F.lit(instructions), about, F.concat(F.lit("<text>\n"), F.coalesce(text, F.lit("")), F.lit("\n</text>")))
