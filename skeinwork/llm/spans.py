"""Problem 8: long exact spans shared between records, by recompression.

Every text becomes grammar symbols in rounds that name runs and pairs (see `recompression`), so equal stretches have the same
symbols inside wherever they stand. The last round names, from sampling points on, the run of symbols that fills as many
characters as lie whole inside every stretch of min_chars: these highest symbols are joined, and one that stands in more than one text
reveals a long repeat. Each pair of texts is then compared character by character along the shifts that shared symbols show.
Symbols with very many occurrences never become pairs: their texts are named again by every min_chars-window near the
point, which is the exact condition itself. Texts that are equal as a whole are reduced to one before and expanded after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import shuffled
from ..scratch import Scratch
from . import recompression as R

#: Texts are handled together up to so many characters, to bound the arrays of a task.
_CHUNK = 500_000
#: A longer text is handled in parts of this size, which see as much around them as their sampling points depend on.
_PART = 2_000_000
#: Symbols with more occurrences than this are named again instead of paired.
_HOT = 64


def _chunks(batch: pa.RecordBatch, chunk: int, part: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
    at = size = 0
    for i, t in enumerate(texts):
        if len(t) > part and i > at:  # a long text is alone
            yield ids[at:i], texts[at:i]
            at, size = i, 0
        size += len(t)
        if size >= chunk or len(t) > part or i == len(texts) - 1:
            yield ids[at : i + 1], texts[at : i + 1]
            at, size = i + 1, 0


def _parts(length: int, size: int, part: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, seen from, seen to) of the parts of a long text; runs of `size` characters start inside a part."""
    around = 2 * R.lost_at_an_end() + R.WINDOW + R.CAP
    for at in range(0, length, part):
        end = min(at + part, length)
        yield at, end, max(0, at - around), min(length, end + around + size)


def symbol_names(docs: DataFrame, size: int, chunk: int = _CHUNK, part: int = _PART) -> DataFrame:
    """(h, doc_id, pos): the name of the run of symbols that fills `size` characters from each sampling point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _chunks(batch, chunk, part):
                if len(texts) == 1 and len(texts[0]) > part:
                    for at, end, left, right in _parts(len(texts[0]), size, part):
                        codes = R.code_points(texts[0][left:right])
                        points, names = R.run_names(codes, np.array([0]), size)
                        inside = (points + left >= at) & (points + left < end)
                        points, names = points[inside], names[inside]
                        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(points), ids[0], dtype=np.int64)), pa.array((points + left).astype(np.int32))], names=["h", "doc_id", "pos"])
                    continue
                codes = R.code_points("".join(texts))
                ends = np.cumsum([len(t) for t in texts])
                starts = np.concatenate(([0], ends[:-1]))
                at, names = R.run_names(codes, starts, size)
                doc = np.searchsorted(ends, at, side="right")
                inside = at + size <= ends[doc]
                at, doc, names = at[inside], doc[inside], names[inside]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ids[doc].astype(np.int64)), pa.array((at - starts[doc]).astype(np.int32))], names=["h", "doc_id", "pos"])

    return docs.mapInArrow(run, "h bigint, doc_id bigint, pos int")


def _compare(min_chars: int):
    """Along the shifts of a pair: all maximal equal stretches of at least min_chars characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, shifts, ta, tb = (batch.column(i) for i in range(5))
            out: list[tuple[int, int, int, int, int]] = []
            for k in range(batch.num_rows):
                x, y = a[k].as_py(), b[k].as_py()
                u, v = R.code_points(ta[k].as_py()), R.code_points(tb[k].as_py())
                for s in shifts[k].as_py():
                    x0, y0 = max(0, s), max(0, -s)
                    n = min(len(u) - x0, len(v) - y0)
                    if n < min_chars:
                        continue
                    breaks = np.flatnonzero(u[x0 : x0 + n] != v[y0 : y0 + n])
                    edges = np.concatenate(([-1], breaks, [n]))
                    length = np.diff(edges) - 1
                    for j in np.flatnonzero(length >= min_chars):
                        p = int(edges[j]) + 1
                        out.append((x, y, x0 + p, y0 + p, int(length[j])))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_a", "doc_b", "start_a", "start_b", "length"])

    return run


def _near_windows(min_chars: int, reach: int):
    """(h1, h2, doc_id, start) for every min_chars-window that starts at most `reach` characters before a hot point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, points in zip(*(batch.column(i).to_pylist() for i in range(3))):
                codes = R.code_points(text)
                open_at = np.zeros(len(codes) + 1, dtype=np.int32)
                p = np.asarray(points)
                np.add.at(open_at, np.maximum(p - reach, 0), 1)
                np.add.at(open_at, np.minimum(p + 1, len(codes)), -1)
                at = np.flatnonzero(np.cumsum(open_at)[: max(0, len(codes) - min_chars + 1)] > 0)
                one, two = R.WindowHash(codes, 1)(at, min_chars), R.WindowHash(codes, 2)(at, min_chars)
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(np.full(len(at), doc, dtype=np.int64)), pa.array(at.astype(np.int32))], names=["h1", "h2", "doc_id", "start"])

    return run


class SharedSpans:
    """Shared spans of a table of texts. Parts are computed once and written to the shared folder.

    stretches: (doc_a, doc_b, start_a, start_b, length), doc_a < doc_b, every maximal equal stretch that holds a window
    with few occurrences, between different texts. classes: (h1, h2, doc_id, start) for windows in very many texts.
    copies: (doc_id, of): texts equal as a whole, where `of` is the smallest id; itself included.

    Null texts, and texts shorter than min_chars, share nothing. A repeated id counts as one record, with any one of its
    texts. Spans within one record do not count. Other columns are ignored. An empty table gives empty results.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 400, hot: int = _HOT):
        if min_chars < R.shortest_stretch():
            raise ValueError(f"min_chars must be at least {R.shortest_stretch()}")
        self.docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        self.min_chars = min_chars
        self.scratch = s = Scratch(docs.sparkSession, "spans")
        texts = self.docs.filter(F.length("text") >= min_chars)
        marks = s.save(texts.select("doc_id", F.unhex(F.md5("text")).alias("m")).dropDuplicates(["doc_id"]))
        several = marks.groupBy("m").agg(F.min("doc_id").alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        self.copies = s.save(marks.join(shuffled(several), "m").select("doc_id", "of"))
        s.drop(marks)
        names = s.save(symbol_names(texts, R.run_size(min_chars)))
        shared = names.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("h")
        hits = s.save(names.join(shuffled(shared), "h", "left_semi").join(shuffled(self.copies.filter("doc_id <> of")), "doc_id", "left_anti").distinct())
        s.drop(names)
        counts = hits.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("h", "n")
        # one row per text: repeated rows of one id would otherwise multiply
        used = s.save(texts.join(shuffled(hits.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
        few = hits.join(shuffled(counts.filter(F.col("n") <= hot)), "h", "left_semi").select("h", "doc_id", "pos")
        pairs = (
            few.toDF("h", "doc_a", "pa").join(shuffled(few.toDF("h", "doc_b", "pb")), "h").filter("doc_a < doc_b")
            .groupBy("doc_a", "doc_b").agg(F.collect_set(F.col("pa") - F.col("pb")).alias("shifts"))  # of two texts: no more than their symbols
        )
        both = pairs.join(shuffled(used.toDF("doc_a", "ta")), "doc_a").join(shuffled(used.toDF("doc_b", "tb")), "doc_b").select("doc_a", "doc_b", "shifts", "ta", "tb")
        self.stretches = s.save(both.mapInArrow(_compare(min_chars), "doc_a bigint, doc_b bigint, start_a bigint, start_b bigint, length bigint"))
        many = hits.join(shuffled(counts.filter(F.col("n") > hot)), "h", "left_semi").groupBy("doc_id").agg(F.collect_set("pos").alias("points"))  # at most one a character of one text
        near = used.join(shuffled(many), "doc_id").select("doc_id", "text", "points").mapInArrow(_near_windows(min_chars, R.reach()), "h1 bigint, h2 bigint, doc_id bigint, start int")
        near = s.save(near)
        groups = near.groupBy("h1", "h2").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("h1", "h2")
        self.classes = s.save(near.join(shuffled(groups), ["h1", "h2"], "left_semi"))
        s.drop(near)
        s.drop(hits)

    def pairs(self) -> DataFrame:
        """(doc_a, doc_b) of every two records that share a span: as many rows as there are such pairs."""
        c = self.classes.select("h1", "h2", "doc_id").distinct()
        # windows held by the same set of texts give the same pairs: one of them is enough
        sets = c.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("s"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
        one = sets.groupBy("n", "s", "x", "y").agg(F.min(F.struct("h1", "h2")).alias("h")).select("h.h1", "h.h2")
        members = c.join(shuffled(one), ["h1", "h2"], "left_semi")
        hot = members.withColumnRenamed("doc_id", "doc_a").join(shuffled(members.withColumnRenamed("doc_id", "doc_b")), ["h1", "h2"]).filter("doc_a < doc_b").select("doc_a", "doc_b")
        found = self.stretches.select("doc_a", "doc_b").union(hot).distinct()
        a, b = self.copies.toDF("a", "doc_a"), self.copies.toDF("b", "doc_b")
        spread = found.join(shuffled(a), "doc_a", "left").join(shuffled(b), "doc_b", "left").select(F.coalesce("a", "doc_a").alias("a"), F.coalesce("b", "doc_b").alias("b"))
        equal = self.copies.toDF("a", "of").join(shuffled(self.copies.toDF("b", "of")), "of").filter("a < b").select("a", "b")
        return spread.union(equal).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()

    def shares(self) -> DataFrame:
        """One row per record with a text: doc_id, n_chars, n_stretches (disjoint shared stretches), shared_chars, share."""
        parts = (
            self.stretches.select(F.col("doc_a").alias("doc_id"), F.col("start_a").alias("s"), (F.col("start_a") + F.col("length")).alias("e"))
            .unionByName(self.stretches.select(F.col("doc_b").alias("doc_id"), F.col("start_b").alias("s"), (F.col("start_b") + F.col("length")).alias("e")))
            .unionByName(self.classes.select("doc_id", F.col("start").cast("bigint").alias("s"), (F.col("start").cast("bigint") + self.min_chars).alias("e")))
        )
        w = Window.partitionBy("doc_id").orderBy("s", "e")
        merged = parts.withColumn("before", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("new", F.coalesce(F.col("s") > F.col("before"), F.lit(True)))
        own = merged.groupBy("doc_id").agg(
            F.count_if("new").alias("n_stretches"),
            F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce("before", "s")))).alias("shared_chars"),
        )
        sizes = self.docs.filter("text is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.length("text")).cast("bigint").alias("n_chars"))
        whole = self.copies.select("doc_id", F.lit(True).alias("whole"))
        got = sizes.join(shuffled(whole), "doc_id", "left").join(shuffled(own), "doc_id", "left")
        chars = F.when(F.col("whole"), F.col("n_chars")).otherwise(F.coalesce("shared_chars", F.lit(0)))
        return got.select(
            "doc_id", "n_chars", F.when(F.col("whole"), F.lit(1)).otherwise(F.coalesce("n_stretches", F.lit(0))).cast("bigint").alias("n_stretches"),
            chars.alias("shared_chars"), F.when(F.col("n_chars") > 0, F.round(chars / F.col("n_chars"), 6)).otherwise(F.lit(0.0)).alias("share"),
        )
