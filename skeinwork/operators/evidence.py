"""Text that a classifier is given for each entity: its own article, else passages that mention it, else its description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import strip_space, word_count
from ..functions.text import cap_words, mentioning
from ..scratch import Scratch
from .joins import hot_values, shuffled, spread_join


def url_index(articles: DataFrame) -> DataFrame:
    """(url, folder_name): the last folder in order of name where an address occurs twice."""
    return articles.filter("url <> ''").groupBy("url").agg(F.max("folder_name").alias("folder_name"))


def pick_text(entities: DataFrame, articles: DataFrame, contents: DataFrame, least_words: int = 30, most_words: int = 8000, most_articles: int = 8) -> DataFrame:
    """(name, type, method, text) of entities (name, type, descriptions, own_source, mentioned_in).

    The tiers are staged: only entities left over by one go to the next, so the costlier work is done for those that need it.
    Mentions are looked up in the first most_articles addresses of an entity, in their order; passages are
    taken until most_words are together. contents: (folder_name, content), one row each.
    """
    scratch = Scratch(entities.sparkSession, "evidence")
    entities = scratch.save(entities)
    texts = scratch.save(url_index(articles).join(shuffled(contents), "folder_name").select("url", "content"))
    owned = entities.select("name", "type", F.col("own_source.url").alias("url"))
    # an article that many entities have as their own is spread over tasks
    own = spread_join(owned, texts, "url", hot_values(owned, "url", owned.count())).filter(word_count(F.col("content")) >= least_words)
    first = scratch.save(own.select("name", "type", F.lit("own_source").alias("method"), cap_words(F.col("content"), most_words).alias("text")))
    rest = scratch.save(entities.join(shuffled(first.select("name")), "name", "left_anti"))
    refs = rest.select("name", F.posexplode(F.slice("mentioned_in", 1, most_articles)).alias("at", "ref")).select("name", "at", "ref.url", "ref.title")
    said = spread_join(refs, texts, "url", hot_values(refs, "url", refs.count())).withColumn("passages", mentioning(F.col("content"), F.col("name"))).filter("passages <> ''")
    listed = said.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("at", "title", "passages", word_count(F.col("passages")).alias("n")))).alias("found"))  # most_articles at most
    # a passage is taken while those before it have not reached the limit
    taken = F.filter("found", lambda x, i: F.aggregate(F.slice("found", 1, i), F.lit(0), lambda a, y: a + y["n"]) < most_words)
    chunk = F.transform(taken, lambda x: F.concat(F.lit("[from article: "), F.coalesce(F.nullif(x["title"], F.lit("")), F.lit("Wikipedia")), F.lit("]\n"), x["passages"]))
    joined = listed.select("name", F.array_join(chunk, "\n\n").alias("combined")).filter(word_count(F.col("combined")) >= least_words)
    second = scratch.save(rest.join(shuffled(joined), "name").select("name", "type", F.lit("mentioned_in").alias("method"), cap_words(F.col("combined"), most_words).alias("text")))
    third = rest.join(shuffled(second.select("name")), "name", "left_anti").select("name", "type", F.lit("name_only").alias("method"), F.coalesce(strip_space(F.get("descriptions", F.lit(0))), F.lit("")).alias("text"))
    return first.unionByName(second).unionByName(third)
