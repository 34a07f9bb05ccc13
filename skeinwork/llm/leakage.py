"""Problem 6: evaluation texts that leak into training texts, by latent semantic retrieval.

The words of the items are the vocabulary; every document becomes one array of word numbers, -1 for other words, written
once to the shared folder, however many items there are. TF-IDF weights come from counts over all passages of all documents. A
randomised SVD gives the latent space: one pass multiplies the passage matrix, and its transpose, with a random test matrix,
task by task, and the sums are solved on the driver (the Nystroem form of the method), so no factor of the size
of the corpus ever exists.

Candidates come from cosines in that space. For exact leaks the passages are windows of run - stride + 1 words at
every stride-th word: any run of `run` shared words covers one of them in full, and equal windows have cosine 1 in any
latent space, so nothing is missed whatever the rank. A passage with a word that no item has can't reach cosine 1, as its
norm is larger, and is passed over. The item windows are kept in the cells of a grid over some directions of the space, in all cells
that a vector of the least cosine could fall into, so a look-up gives every candidate without a product of all with all. Candidates must have
a common subsequence with the item around their place of as many words as the run, and are then followed word by word; the share of the
item's telling words (its answers: names and numbers, the rarer half) is told with them. For paraphrases
longer passages are compared with whole items at a lower cosine, and kept by the longest common subsequence and the telling words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

_WORD = re.compile(r"[^\W_]+")
#: Items are searched for in blocks of about so many words, which bounds what a task holds of them.
BLOCK_WORDS = 500_000
#: Least cosine of a candidate window, directions of the grid and the width of its cells.
NEAR, DIRECTIONS, CELL = 0.9999, 6, 0.1
#: Words of the latent matrix that are summed together.
_ROWS = 1_024
#: Rank of the latent space and columns added to the test matrix.
RANK, OVERSAMPLE = 40, 8
#: Words in a passage of the matrix that is decomposed.
MATRIX_PASSAGE = 32
#: Sizes of passages for paraphrases in an octave.
SIZE_STEPS = 4
#: Words whose passages are compared at a time.
_PART = 16_384


def words(text: str | None) -> list[str]:
    """Runs of letters or digits of the composed, lower-cased text."""
    return _WORD.findall(unicodedata.normalize("NFC", text).lower()) if text else []


class Items:
    """A block of items as arrays of word numbers, small enough to send to every task."""

    def __init__(self, rows: list[tuple[int, str | None]], vocabulary: dict[str, int]):
        texts = [(i, words(t)) for i, t in rows]
        texts = [(i, w) for i, w in texts if w]
        self.ids = np.array([i for i, _ in texts], dtype=np.int64)
        self.words = [np.array([vocabulary[w] for w in t], dtype=np.int32) for _, t in texts]

    def windows(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(item index, first word) of every window of `size` words of the items of at least `least` words."""
        counts = np.array([len(w) - size + 1 if len(w) >= least else 0 for w in self.words], dtype=np.int64)
        item = np.repeat(np.arange(len(counts)), counts)
        return item, np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)


def encode(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, ids): every word of every text as its number, -1 where no item has it."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            flat: list[int] = []
            ends = [0]
            for text in batch.column(1).to_pylist():
                flat.extend([get(w, -1) for w in words(text)])
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id bigint, ids array<int>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, word numbers of all texts in a row, and where each text ends."""
    column = batch.column(1)
    offsets = column.offsets.to_numpy()
    return batch.column(0).to_numpy(), column.values.to_numpy()[offsets[0] : offsets[-1]], (offsets - offsets[0])[1:]


def _passages(ids: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Passage number and word number of the words that items have; passages are `size` words of one text, in a row."""
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    pieces = -(-lengths // size)
    first = np.cumsum(pieces) - pieces
    doc = np.repeat(np.arange(len(ends)), lengths)
    passage = first[doc] + (np.arange(len(ids)) - starts[doc]) // size
    known = ids >= 0
    return passage[known], ids[known]


def _gathered(encoded: DataFrame) -> DataFrame:
    """The same rows in no more tasks than run together, so that what every task sums up stays few, however many files there are."""
    return encoded.coalesce(max(1, 2 * encoded.sparkSession.sparkContext.defaultParallelism))


def passage_counts(encoded: DataFrame, n_words: int, size: int) -> tuple[np.ndarray, int]:
    """In how many passages of all texts each word of the vocabulary stands, and how many passages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(n_words, dtype=np.int64), 0
        for batch in batches:
            _, ids, ends = _flat(batch)
            passage, word = _passages(ids, ends, size)
            df += np.bincount(np.unique(passage * n_words + word) % n_words, minlength=n_words)
            n += int((-(-np.diff(ends, prepend=0) // size)).sum())
        at = np.append(np.flatnonzero(df), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(df[at[:-1]], n))], names=["word", "n"])

    counts = np.zeros(n_words + 1, dtype=np.int64)
    for r in _gathered(encoded).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect():  # one row a word
        counts[r.word] = r.n  # -1 is the last
    return counts[:-1], int(counts[-1])


def right_factor(encoded: DataFrame, idf: np.ndarray, size: int, rank: int, oversample: int, seed: int = 7) -> np.ndarray:
    """The right singular vectors, words by rank, of the TF-IDF matrix of all passages, in one pass over them."""
    n_words, width = len(idf), min(rank + oversample, len(idf))
    test = np.random.default_rng(seed).standard_normal((n_words, width)).astype(np.float32)
    sent = encoded.sparkSession.sparkContext.broadcast((test, idf.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, weight = sent.value
        total = np.zeros((n_words, width), dtype=np.float64)
        weighted = omega * weight[:, None]
        for batch in batches:
            _, ids, ends = _flat(batch)
            passage, word = _passages(ids, ends, size)
            begins = np.flatnonzero(np.diff(passage, prepend=-1))
            # parts of about 200,000 words, cut between passages, bound the memory
            cuts = np.unique(np.append(begins[np.minimum(np.searchsorted(begins, np.arange(0, len(word), 200_000)), len(begins) - 1)], len(word))) if len(word) else []
            for at, end in zip(cuts[:-1], cuts[1:]):
                p, w = passage[at:end], word[at:end]
                head = np.flatnonzero(np.diff(p, prepend=-1))
                y = np.add.reduceat(weighted[w], head, axis=0)  # passages by width
                row = np.cumsum(np.diff(p, prepend=p[0]) != 0)
                order = np.argsort(w, kind="stable")
                words_here, first = np.unique(w[order], return_index=True)
                total[words_here] += np.add.reduceat(y[row[order]], first, axis=0)
        total *= weight[:, None]
        for at in range(0, n_words, _ROWS):
            if total[at : at + _ROWS].any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total[at : at + _ROWS].tobytes()], pa.binary())], names=["at", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(part)
                sums[at] = sums[at] + x if at in sums else x
        for at, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["at", "part"])

    # every task sends its sums in blocks of words; a block is added up in one task, and the whole is one matrix of n_words x width
    parts = _gathered(encoded).mapInArrow(run, "at bigint, part binary").repartition(-(-n_words // _ROWS), "at").mapInArrow(add, "at bigint, part binary")
    product = np.zeros((n_words, width))
    for r in parts.toLocalIterator():
        rows = np.frombuffer(r.part).reshape(-1, width)
        product[r.at : r.at + len(rows)] = rows
    core = test.T.astype(np.float64) @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-10
    if not good.any():
        return np.zeros((n_words, 1), dtype=np.float32)
    root = product @ (vectors[:, good] / np.sqrt(values[good]))
    u, _, _ = np.linalg.svd(root, full_matrices=False)
    return np.ascontiguousarray(u[:, :rank], dtype=np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Grid:
    """The unit vectors of bags of words in cells: `near` gives, for other vectors, all bags of at least a cosine, and few besides."""

    def __init__(self, vectors: np.ndarray, cosine: float = NEAR, directions: int = DIRECTIONS, cell: float = CELL):
        lines = np.random.default_rng(11).standard_normal((vectors.shape[1], directions))
        self.lines = (lines / np.linalg.norm(lines, axis=0)).astype(np.float32)
        self.cell, self.odd = cell, np.random.default_rng(12).integers(1, 2**62, directions, dtype=np.int64) * 2 + 1
        # two unit vectors of that cosine are so far apart, on any line at most
        far = math.sqrt(2 - 2 * cosine) + 1e-5
        at = vectors @ self.lines
        low, high = np.floor((at - far) / cell).astype(np.int64), np.floor((at + far) / cell).astype(np.int64)
        bag, cells = np.arange(len(vectors)), low
        for d in range(directions):
            two = np.flatnonzero(high[bag, d] > low[bag, d])
            more = cells[two].copy()
            more[:, d] += 1
            bag, cells = np.concatenate((bag, bag[two])), np.concatenate((cells, more))
        keys = self._keys(cells)
        order = np.argsort(keys, kind="stable")
        self.keys, self.bags = keys[order], bag[order].astype(np.int32)

    def _keys(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.odd).sum(axis=1)

    def near(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which vector, which bag) of all that share a cell."""
        keys = self._keys(np.floor((vectors @ self.lines) / self.cell).astype(np.int64))
        first, last = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        return _expand(first, last - first, self.bags)


def _expand(first: np.ndarray, n: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for the n[row] values from first[row] on."""
    rows = np.repeat(np.arange(len(n)), n)
    return rows, values[np.repeat(first, n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)]


def _exact_search(items: Items, space: np.ndarray, idf: np.ndarray, run_words: int, stride: int):
    """(doc_id, item_id, run, lcs, answer_share) of passages with a run of equal words of at least run_words."""
    size = run_words - stride + 1
    item, at = items.windows(size, run_words)
    pad = run_words
    flat = np.concatenate([np.full(pad, -2, dtype=np.int32), *(np.concatenate((w, np.full(pad, -2, dtype=np.int32))) for w in items.words)])
    begin = pad + np.cumsum([0] + [len(w) + pad for w in items.words])[:-1]
    where = begin[item] + at if len(item) else item
    # equal windows of different items have one vector: the distinct ones are looked up
    bags, inverse = np.unique(flat[where[:, None] + np.arange(size)], axis=0, return_inverse=True) if len(where) else (np.empty((0, size), np.int32), where)
    by_bag = np.argsort(inverse, kind="stable")
    bag_end = np.cumsum(np.bincount(inverse, minlength=len(bags)))
    bag_begin = bag_end - np.bincount(inverse, minlength=len(bags))
    grid = Grid(_unit(space[bags].sum(axis=1))) if len(bags) else None
    lengths = np.array([len(w) for w in items.words])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[int, tuple[dict[int, int], set[int]]] = {}
        for batch in batches:
            doc, ids, ends = _flat(batch)
            starts = np.concatenate(([0], ends[:-1]))
            out: list[tuple[int, int, int, int, float]] = []
            if grid is not None and len(ids) >= size:
                known = np.concatenate(([0], np.cumsum(ids >= 0)))
                owner = np.repeat(np.arange(len(doc)), ends - starts)
                p = np.arange(len(ids) - size + 1)
                p = p[((p - starts[owner[p]]) % stride == 0) & (p + size <= ends[owner[p]])]
                p = p[known[p + size] - known[p] == size]  # else the norm keeps the cosine below 1
                for k in range(0, len(p), 8192):
                    here = p[k : k + 8192]
                    latent = _unit(space[ids[here[:, None] + np.arange(size)]].sum(axis=1))
                    a, bag = grid.near(latent)
                    close = (latent[a] * _unit(space[bags[bag]].sum(axis=1))).sum(axis=1) > NEAR
                    # a bag stands for all the places of items where it is
                    row, q = _expand(bag_begin[bag[close]], (bag_end - bag_begin)[bag[close]], by_bag)
                    a = here[a[close][row]]
                    # the windows of one document and item on one line are one candidate
                    lines = np.unique(np.stack((owner[a], item[q], a - at[q]), axis=1), axis=0) if len(a) else np.empty((0, 3), np.int64)
                    for d, i, line in lines.tolist():
                        own = items.words[i]
                        if i not in places:
                            places[i] = _places(own), _telling(own, idf)
                        bits, tells = places[i]
                        left, right = max(line, int(starts[d])), min(line + int(lengths[i]), int(ends[d]))
                        passage = ids[left:right]
                        lcs = _subsequence(bits, int(lengths[i]), passage.tolist())
                        if lcs < run_words:
                            continue
                        # the exact check: the longest run of equal words along the line
                        equal = np.flatnonzero(np.concatenate(([True], passage != own[left - line : right - line], [True])))
                        longest = int(np.diff(equal).max()) - 1
                        if longest >= run_words:
                            share = len(tells & set(passage.tolist())) / max(1, len(tells))
                            out.append((int(doc[d]), int(items.ids[i]), longest, lcs, round(share, 4)))
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "run", "lcs", "answer_share"])

    return run


def _telling(item: np.ndarray, idf: np.ndarray) -> set[int]:
    """The rarer half of the distinct words of an item."""
    own = np.unique(item)
    return set(own[idf[own] >= np.median(idf[own])].tolist())


def _subsequence(places: dict[int, int], length: int, passage: list[int]) -> int:
    """Length of the longest common subsequence of an item and a passage, the places of the item's words given as bits."""
    full = (1 << length) - 1
    row = full
    for word in passage:
        if at := places.get(word):
            up = row & at
            row = ((row + up) | (row - up)) & full
    return length - row.bit_count()


def _places(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


def _passage_sizes(length: int) -> set[int]:
    """Words of the passages that an item of so many words is compared with: powers of 2 ** (1 / SIZE_STEPS) from 0.7 to 1.4 of its length."""
    step = round(math.log2(length) * SIZE_STEPS)
    return {max(1, round(2 ** (k / SIZE_STEPS))) for k in range(step - SIZE_STEPS // 2, step + SIZE_STEPS // 2 + 1)}


def _paraphrase_search(items: Items, space: np.ndarray, idf: np.ndarray, cosine: float, common: float, answers: float):
    """(doc_id, item_id, cosine, lcs_share, answer_share) of passages close to a whole item in the latent space.

    A passage starts at every word, in each of the sizes of the items. Those with fewer words of items than the least common
    subsequence, or in a stretch without enough telling words of any item, can't reach the bounds and are passed over before the product.
    """
    lengths = np.array([len(w) for w in items.words])
    sizes = [_passage_sizes(len(w)) for w in items.words]
    widest = max(map(max, sizes), default=0)
    queries = _unit(np.stack([space[w].sum(axis=0) for w in items.words])).T if len(lengths) else None
    telling = np.zeros((len(idf) + 1, len(lengths)), dtype=bool)
    for k, w in enumerate(items.words):
        own = np.unique(w)
        telling[own[idf[own] >= np.median(idf[own])], k] = True
    n_telling = np.maximum(telling.sum(axis=0), 1)
    enough = answers * n_telling - 1e-9
    # of each span of words, a power of 2, 32 or more, and at least the size: (size, items, their vectors, fewest known words of a passage)
    spans: dict[int, list] = {}
    for size in sorted(set().union(*sizes)):
        own = np.array([k for k, s in enumerate(sizes) if size in s])
        spans.setdefault(max(32, 1 << (size - 1).bit_length()), []).append((size, own, np.ascontiguousarray(queries[:, own]), common * lengths[own].min() - 1e-9))
    tells = telling.astype(np.float32)
    padded = np.concatenate((space, np.zeros((1, space.shape[1]), dtype=space.dtype)))
    places = [_places(w) for w in items.words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, ids, ends = _flat(batch)
            owner = np.repeat(np.arange(len(doc)), np.diff(ends, prepend=0))
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            # parts of the words in a row bound the memory, however long a text is
            for at in range(0, len(ids) if spans else 0, _PART):
                d = owner[at : at + _PART]
                near = ids[at : at + _PART + widest]
                sums = np.concatenate((np.zeros((1, padded.shape[1])), np.cumsum(padded[near], axis=0, dtype=np.float64)))
                known = np.concatenate(([0], np.cumsum(near >= 0)))
                p = np.arange(len(d))
                for span, size, own, wanted, least in ((s, *c) for s, cs in spans.items() for c in cs):
                    if size == spans[span][0][0]:  # the first of the span: which items' words tell enough in a span and the next
                        held = np.zeros((len(near) // span + 2, len(tells)), dtype=np.float32)
                        held[np.arange(len(near)) // span, near] = 1
                        told = np.maximum(held[:-1], held[1:]) @ tells >= enough
                    e = np.minimum(p + size, ends[d] - at)
                    able = np.flatnonzero(told[:, own].any(axis=1)[p // span] & (known[e] - known[p] >= least))
                    for k in range(0, len(able), 4096):
                        pk, ek = p[able[k : k + 4096]], e[able[k : k + 4096]]
                        close = _unit((sums[ek] - sums[pk]).astype(np.float32)) @ wanted
                        hits = np.flatnonzero(close >= cosine)
                        for h in range(0, len(hits), 8192):
                            a, c = np.divmod(hits[h : h + 8192], len(own))
                            q = own[c]
                            words_at = pk[a][:, None] + np.arange(size)
                            inside = np.where(words_at < ek[a][:, None], near[np.minimum(words_at, len(near) - 1)], -1)
                            inside = np.sort(inside, axis=1)
                            fresh = np.concatenate((np.ones((len(a), 1), dtype=bool), inside[:, 1:] != inside[:, :-1]), axis=1)
                            share = (telling[inside, q[:, None]] & fresh).sum(axis=1) / n_telling[q]
                            for j in np.flatnonzero(share >= answers):
                                i, x = q[j], pk[a[j]]
                                lcs = _subsequence(places[i], int(lengths[i]), near[x : ek[a[j]]].tolist()) / lengths[i]
                                if lcs >= common:
                                    pair = int(doc[d[x]]), int(items.ids[i])
                                    row = round(float(lcs), 4), round(float(close[a[j], c[j]]), 4), round(float(share[j]), 4)
                                    best[pair] = max(row, best.get(pair, row))
            cols = list(zip(*((*pair, c, lcs, share) for pair, (lcs, c, share) in best.items()))) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

    return run


class _Latent:
    """Documents encoded once for all items, the word weights and the latent space, and the items in blocks."""

    def __init__(self, docs: DataFrame, items: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str):
        scratch = Scratch(docs.sparkSession, "leaks")
        texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(doc_text).alias("text")).filter("doc_id is not null")
        self.items = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).filter("i is not null and t is not null")

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: dict[str, int] = {}
                for t in batch.column(1).to_pylist():
                    for w in words(t):
                        seen[w] = seen.get(w, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        # the words of the items, not of the corpus: one row a word of the languages they are in
        found = self.items.mapInArrow(tell, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
        self.vocabulary = {w: k for k, w in enumerate(sorted(r.word for r in found))}
        self.n_blocks = max(1, -(-sum(r.n for r in found) // BLOCK_WORDS))
        self.encoded = scratch.save(encode(texts, self.vocabulary))
        counts, passages = passage_counts(self.encoded, len(self.vocabulary), MATRIX_PASSAGE)
        self.idf = np.log((1.0 + passages) / (1.0 + counts)) + 1.0
        space = right_factor(self.encoded, self.idf, MATRIX_PASSAGE, RANK, OVERSAMPLE) * self.idf[:, None] if len(self.idf) else np.zeros((0, 1))
        self.space = space.astype(np.float32)

    def search(self, found: Callable[[Items], Callable], kind: str) -> DataFrame:
        """What a search finds of each block of items, in one frame."""
        parts = []
        for k in range(self.n_blocks):
            block = self.items if self.n_blocks == 1 else self.items.filter(F.pmod(F.xxhash64("i"), F.lit(self.n_blocks)) == k)
            parts.append(self.encoded.mapInArrow(found(Items(sorted(map(tuple, block.collect())), self.vocabulary)), kind))  # about BLOCK_WORDS words
        return reduce(DataFrame.unionByName, parts)


def exact_leaks(docs: DataFrame, items: DataFrame, run_words: int = 12, stride: int = 6, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared_words, common_words, answer_share): documents that hold at least run_words consecutive words of an item.

    shared_words is the longest such run, common_words the longest common subsequence of the item and the passage where it would
    stand, answer_share how many of its telling words are there. Null and empty texts and null ids give no row, nor do items of fewer words;
    repeated rows count once, and rows with one id but other texts are looked at each. An empty table gives no row.
    """
    if not 0 < stride < run_words:
        raise ValueError("stride must be above 0 and below run_words")
    t = _Latent(docs, items, doc_id, doc_text, item_id, item_text)
    found = t.search(lambda i: _exact_search(i, t.space, t.idf, run_words, stride), "doc_id bigint, item_id bigint, run bigint, lcs bigint, answer_share double")
    best = F.max(F.struct(F.col("run").alias("shared_words"), F.col("lcs").alias("common_words"), "answer_share")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def paraphrases(docs: DataFrame, items: DataFrame, cosine: float = 0.8, common: float = 0.5, answers: float = 0.5, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_share): documents with a passage that tells what an item does.

    Passages have 0.7 to 1.4 times as many words as the item and start at every word; each must reach all three bounds. The best passage of a
    document and item is kept. Nulls, empty texts, repeated rows and empty tables as in exact_leaks.
    """
    kind = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_share double"
    t = _Latent(docs, items, doc_id, doc_text, item_id, item_text)
    found = t.search(lambda i: _paraphrase_search(i, t.space, t.idf, cosine, common, answers), kind)
    best = F.max(F.struct("lcs_share", "cosine", "answer_share")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.lcs_share", "b.answer_share")
