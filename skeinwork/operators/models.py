"""Steps that ask a model or a web service. The client is injected; its retries and waiting are here."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import COUNTRY_ANSWER, coerce_country
from ..functions.text import lead, strip_fence
from .joins import shuffled

NODE = "struct<standard_name:string,original_text_name:string,aliases:array<string>,type:string,context:string,time_period:string>"
EDGE = "struct<source:string,target:string,relationship:string,detail:string,context:string,time_period:string>"
EXTRACTION = f"nodes array<{NODE}>, edges array<{EDGE}>"
#: Tokens a call may use at first, and after an answer that was cut off.
TOKENS = (8192, 16384)
#: What is asked of a text where the caller gives no instructions.
INSTRUCTIONS = (
    "List the criminal organizations that the text names as nodes, and as edges what it says of two of them. A node has standard_name, original_text_name, aliases, type, "
    "context and time_period; an edge has source, target, relationship (alliance, rivalry or other), detail, context and time_period. State nothing that the text does not. "
    'Answer with one JSON object: {"nodes": [...], "edges": [...]}.'
)


class Client(Protocol):
    """A call with a prompt and a token budget; gives the answer and whether it was cut off."""

    def __call__(self, prompt: str, max_tokens: int) -> tuple[str, bool]: ...


def rate_limited(error: Exception) -> bool:
    return bool(re.search(r"\b429\b|too many requests|ratelimit|rate.*limit", str(error), re.I))


def ask(client: Client, prompt: str, tries: int = 3, wait: float = 10.0, sleep: Callable[[float], None] = time.sleep, terse: str = "\n\nBe terse: shorter contexts, JSON only.") -> str | None:
    """An answer that is JSON, or None after the last try. A cut-off answer raises the budget and asks for less; a rate limit waits longer each time."""
    budget = 0
    for attempt in range(1, tries + 1):
        try:
            answer, cut = client(prompt if attempt == 1 else prompt + terse, TOKENS[budget])
        except Exception as e:  # any failure of a service is tried again
            if attempt < tries:
                sleep(wait * attempt if rate_limited(e) else 3.0 * attempt)
            continue
        if cut:
            budget = min(budget + 1, len(TOKENS) - 1)
            continue
        answer = re.sub(r"^```(?:json)?\s*|\s*```$", "", answer.strip()).strip()
        try:
            json.loads(answer)
        except ValueError:
            continue
        return answer
    return None


def again(call: Callable[[], object], tries: int = 5, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep):
    """What a service call gives. A rate limit waits wait, then twice as long each time; any other failure, and the last, is raised."""
    for attempt in range(tries):
        try:
            return call()
        except Exception as e:
            if attempt == tries - 1 or not rate_limited(e):
                raise
            sleep(wait * 2**attempt)


def call_model(rows: DataFrame, prompt: str, make_client: Callable[[], Client], parallel: int | None = None, **options) -> DataFrame:
    """Adds `answer`, null where no try succeeded. One client a task; `parallel` tasks bound the calls at a time."""
    if parallel:
        rows = rows.repartition(parallel)
    schema = T.StructType([*rows.schema.fields, T.StructField("answer", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            yield batch.assign(answer=[ask(client, p, **options) for p in batch[prompt]])

    return rows.mapInPandas(run, schema)


def extraction_prompts(chunked: DataFrame, articles: DataFrame, instructions: str = INSTRUCTIONS) -> DataFrame:
    """Prompts for chunks (folder_name, chunk_no, text); articles of several chunks give each the beginning of the article.

    articles: (folder_name, title, url, content).
    """
    n = chunked.groupBy("folder_name").agg(F.count(F.lit(1)).alias("n_chunks"))
    rows = chunked.join(shuffled(n), "folder_name").join(shuffled(articles.select("folder_name", "title", "url", lead(F.col("content")).alias("lead"))), "folder_name")
    context = F.when(F.col("n_chunks") > 1, F.concat(F.lit("The article begins:\n"), "lead"))
    place = F.concat_ws("\n", F.concat(F.lit("Title: "), "title"), F.concat(F.lit("Address: "), "url"), F.concat(F.lit("Part "), F.col("chunk_no").cast("string"), F.lit(" of "), F.col("n_chunks").cast("string")))
    text = F.concat_ws("\n\n", F.lit(instructions), place, context, F.concat(F.lit("<text>\n"), "text", F.lit("\n</text>")))
    return rows.select("folder_name", "chunk_no", "n_chunks", text.alias("prompt"))


def extractions(answered: DataFrame) -> DataFrame:
    """(folder_name, nodes, edges, incomplete, failed_chunks, total_chunks) of answered chunks, in the order of the chunks."""
    parsed = answered.withColumn("p", F.from_json(strip_fence(F.col("answer")), EXTRACTION))
    kept = F.array_sort(F.collect_list(F.struct("chunk_no", "p")))  # the chunks of one article
    rows = parsed.groupBy("folder_name").agg(kept.alias("c"), F.count_if(F.col("p").isNull()).alias("failed_chunks"), F.count(F.lit(1)).alias("total_chunks"))
    none_nodes, none_edges = F.array().cast(f"array<{NODE}>"), F.array().cast(f"array<{EDGE}>")
    return rows.select(
        "folder_name", F.flatten(F.transform("c", lambda x: F.coalesce(x["p"]["nodes"], none_nodes))).alias("nodes"), F.flatten(F.transform("c", lambda x: F.coalesce(x["p"]["edges"], none_edges))).alias("edges"),
        (F.col("failed_chunks") > 0).alias("incomplete"), F.col("failed_chunks").cast("int").alias("failed_chunks"), F.col("total_chunks").cast("int").alias("total_chunks"),
    )


def with_countries(entities: DataFrame, found: DataFrame, name: str = "name") -> DataFrame:
    """Entities with the country columns of their results, Unknown and low where there is none. found: as of countries(), one row a name."""
    columns = {"country": F.lit("Unknown"), "countries_active": F.array().cast("array<string>"), "country_confidence": F.lit("low"), "country_method": F.lit(None).cast("string")}
    rows = entities.drop(*columns).join(shuffled(found.select(name, *columns)), name, "left")
    return rows.select(*[c for c in rows.columns if c not in columns], *[F.coalesce(c, default).alias(c) for c, default in columns.items()])


def countries(answered: DataFrame, name: str = "name", method: str = "method") -> DataFrame:
    """(name, country, countries_active, country_confidence, country_method); a failed answer is Unknown."""
    record = coerce_country(F.from_json(strip_fence(F.col("answer")), COUNTRY_ANSWER))
    return answered.withColumn("_r", record).select(name, F.col("_r.country").alias("country"), F.col("_r.countries_active").alias("countries_active"), F.col("_r.confidence").alias("country_confidence"), F.col(method).alias("country_method"))


def model_chooser(make_client: Callable[[], Client]) -> Callable[[DataFrame], DataFrame]:
    """A chooser for one_per_pair that asks a model; an answer that fails or is out of range is the first candidate."""

    def choose(groups: DataFrame) -> DataFrame:
        text = F.array_join(F.transform("candidates", lambda c, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), F.to_json(c["r"]))), "\n")
        prompt = F.concat(F.lit("Which of these records of one pair says best how the two stand to each other now? "), "a", F.lit(" and "), "b", F.lit("\n"), text, F.lit('\nAnswer with one JSON object: {"choice": number}'))
        answered = call_model(groups.select("a", "b", F.size("candidates").alias("n"), prompt.alias("prompt")), "prompt", make_client)
        choice = F.from_json("answer", "choice int")["choice"]
        return answered.select("a", "b", F.when(choice.between(0, F.col("n") - 1), choice).otherwise(0).alias("choice"))

    return choose
