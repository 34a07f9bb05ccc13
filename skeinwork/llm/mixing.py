"""Problem 7: mix sources to target weights by systematic sampling.

Sizes are tokens of a public tokenizer. Each source has an expected number of copies per document, its target over its
size, at most max_repeats. The expected copies are summed along the documents of the source, one random offset is added,
and a document comes out once for each integer its part of the line crosses, so never more than the rounded-up
expectation. The line is cut into buckets by a hash of the id: the sums of buckets are few, and inside a bucket a running
sum is local, so a source that holds a third of all rows is still handled by many tasks. Inside a bucket documents are in
the order of their size, which spreads every size evenly over the sample and keeps the shares close to their targets.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Pattern of the tokenizer: the fixed value that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Expected copies are whole multiples of 1/_UNIT, so sums are exact.
_UNIT = 1 << 20
#: Buckets of the line of a source, at least, and records that one may hold on average.
_BUCKETS, _BUCKET_ROWS = 1024, 100_000


def token_counts(docs: DataFrame, id_col: str, source_col: str, text_col: str, vocabulary: str) -> DataFrame:
    """(doc_id, source, n_tokens). The rank file is read here and sent to the tasks, a megabyte; null text has 0 tokens."""
    raw = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.value.splitlines())}
        encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "source", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


class Mixture:
    """A mixture of `docs` by `targets` (source, target_share, max_repeats), as large as all of docs in tokens.

    Rows of docs with a null id, and sources without a target, are part of the total and never come out. A source named
    twice in targets has the sum of its shares and the larger limit; a null share counts as 0, a null limit as 1. Repeated
    ids are separate records. A source without documents, or of empty texts only, gives nothing and cannot reach a positive share.
    Empty tables give an empty mixture. The same seed gives the same mixture. vocabulary is the path of the tokenizer's rank file.
    """

    def __init__(self, docs: DataFrame, targets: DataFrame, vocabulary: str, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 42, buckets: int | None = None):
        scratch = Scratch(docs.sparkSession, "mixture")
        self.counts = scratch.save(token_counts(docs, id_col, source_col, text_col, vocabulary))
        self.seed, self.buckets = seed, buckets or max(_BUCKETS, self.counts.count() // _BUCKET_ROWS)
        goal = (
            targets.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
            .filter("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        )
        sizes = self.counts.groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("n_docs"))
        total = self.counts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))  # one row
        wanted = F.col("target_share") * F.col("total")
        copies = F.when(F.col("size") > 0, F.least(wanted / F.col("size"), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
        plan = (
            goal.join(sizes, "source", "left").crossJoin(F.broadcast(total))
            .withColumns({"size": F.coalesce("size", F.lit(0)), "n_docs": F.coalesce("n_docs", F.lit(0))})
            .withColumns({"wanted": wanted, "expected": F.floor(copies * _UNIT).cast("bigint"), "reachable": wanted <= F.col("max_repeats") * F.col("size")})
        )
        self.plan = scratch.save(plan)  # a row per source of targets

    def _offset(self) -> Column:
        return F.pmod(F.xxhash64("source", F.lit(self.seed)), F.lit(_UNIT))

    def sample(self) -> DataFrame:
        """(doc_id, source, n_tokens, copies) of every document that comes out at least once."""
        rows = (
            self.counts.filter("doc_id is not null").join(self.plan.select("source", "expected"), "source").filter("expected > 0")
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.lit(self.buckets)))
        )
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        line = rows.groupBy("source", "bucket").agg(F.sum("expected").alias("part")).select("source", "bucket", (F.coalesce(F.sum("part").over(before), F.lit(0)) + self._offset()).alias("base"))
        within = Window.partitionBy("source", "bucket").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        end = F.col("base") + F.sum("expected").over(within)
        placed = rows.join(line, ["source", "bucket"]).withColumn("end", end)
        copies = F.expr(f"end div {_UNIT} - (end - expected) div {_UNIT}")  # whole numbers: no rounding
        return placed.select("doc_id", "source", "n_tokens", copies.alias("copies")).filter("copies > 0")

    def records(self) -> DataFrame:
        """The mixture itself: (doc_id, source, n_tokens, copy_no), one row per copy."""
        return self.sample().select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no"))

    def _given(self) -> DataFrame:
        """The plan with what the sample gave of each source."""
        given = self.sample().groupBy("source").agg(F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"))
        return self.plan.join(given, "source", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("copies", "most_copies", "tokens")})

    def unreachable(self) -> DataFrame:
        """The sources whose sample falls short of their share, and not by its rounding: max_repeats copies of each record would not do."""
        return self._given().filter(~F.col("reachable") & (F.col("tokens") < F.col("wanted"))).select("source")

    def report(self) -> DataFrame:
        """One row per source of targets: what it has, what it was to give, whether it can, what it gave, its share of the mixture."""
        return self._given().select(
            "source", "target_share", "max_repeats", "n_docs", F.col("size").alias("size_tokens"), "reachable", "copies", "most_copies", "tokens",
            F.round(F.try_divide(F.col("tokens"), F.sum("tokens").over(Window.partitionBy())), 6).alias("actual_share"),  # as many rows as sources in targets
            F.round(F.try_divide(F.col("tokens"), F.col("total")), 6).alias("share_of_total"),
        )
