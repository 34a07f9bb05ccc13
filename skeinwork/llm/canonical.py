"""Problem 3: map freely entered values to a canonical list, and report what is not on it.

Values are looked at once each, however many rows hold them. The dictionary holds every wording of the list, in every
order of its words, single and plural, and keys that a wording shares with all within two edits of it (symmetric deletes); a
value is looked up by its own keys, so one equality join finds every wording within two edits of it. The dictionary is made and counted by
Spark: a small one is broadcast, a larger one is joined by a shuffle. Candidates rank by a
weighted Damerau-Levenshtein distance, then by how often the canonical value itself occurs, then by the order of the list.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import is_absent
from ..operators.joins import bounded, shuffled
from ..scratch import Scratch
from . import edits

UNMATCHED = "unmatched"
#: Mappings of up to so many values are broadcast back to the rows; larger ones join by a salted shuffle.
_BROADCAST_VALUES, _SALTS = 100_000, 32
#: Wordings of up to so many words are held in every order; longer ones, and values, as they stand and in the order of the alphabet.
_ORDERS = 4

#: Words that say nothing about the type of an organisation, for the query on types.
NOISE = ("a", "alleged", "an", "criminal", "das", "de", "der", "die", "el", "ex", "former", "il", "la", "los", "s", "so called", "suspected", "the", "type")
#: Words of other languages for words of the list of types, for the query on types.
FOREIGN = {
    "banda": "gang", "bande": "gang", "cartello": "cartel", "cla": "clan", "cosca": "mafia", "faccao": "faction", "faccion": "faction",
    "famiglia": "family", "familia": "family", "fazione": "faction", "fraktion": "faction", "gangue": "gang", "kartell": "cartel",
    "klan": "clan", "mafija": "mafia", "mafiya": "mafia", "milice": "militia", "milicia": "militia", "miliz": "militia", "milizia": "militia",
    "motard": "motorcycle", "moto": "motorcycle", "motocicleta": "motorcycle", "motociclista": "motorcycle", "motorrad": "motorcycle",
    "organisation": "organization", "organizacion": "organization", "organizacao": "organization", "organizzazione": "organization", "sindicato": "syndicate",
    "terrorista": "terrorist", "terroriste": "terrorist", "terroristica": "terrorist", "terroristico": "terrorist", "triada": "triad", "triade": "triad",
    "terrororganisation": "terrorist organization", "terrorgruppe": "terrorist group", "motorradclub": "motorcycle club",
}
#: The rows of a keyboard, and how far each is shifted against the first.
KEYS = (("1234567890", 0.0), ("qwertyuiop", 0.5), ("asdfghjkl", 0.75), ("zxcvbnm", 1.25))

_AT = {c: (x + shift, y) for y, (row, shift) in enumerate(KEYS) for x, c in enumerate(row)}


def plain(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().replace("ß", "ss")) if not unicodedata.combining(c))


def _beside(a: str, b: str) -> bool:
    if a not in _AT or b not in _AT:
        return False
    (x, y), (u, v) = _AT[a], _AT[b]
    return abs(x - u) <= 1.1 and abs(y - v) <= 1


def weighted(a: str, b: str) -> float:
    """Damerau-Levenshtein distance with lower costs for slips of typing: neighbouring keys, doubled letters, exchanges."""
    n, m = len(a), len(b)
    d = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        d[i][0] = d[i - 1][0] + 0.9
    for j in range(1, m + 1):
        d[0][j] = d[0][j - 1] + 0.9
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            x, y = a[i - 1], b[j - 1]
            out = 0.5 if i > 1 and x == a[i - 2] else 0.9
            into = 0.5 if j > 1 and y == b[j - 2] else 0.9
            v = min(d[i - 1][j] + out, d[i][j - 1] + into, d[i - 1][j - 1] + (0.0 if x == y else 0.7 if _beside(x, y) else 1.1))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                v = min(v, d[i - 2][j - 2] + 0.8)
            d[i][j] = v
    return d[n][m]


_NEAR_KEYS = np.array([[_beside(chr(x), chr(y)) for y in range(128)] for x in range(128)])
_BAND = 5


def weighted_all(left: list[str], right: list[str]) -> np.ndarray:
    """weighted() of many pairs together, exact up to 2.0; 9 where the tables leave a band of _BAND cells, which costs more."""
    out = np.full(len(left), 9.0)
    n, m = np.array([len(x) for x in left], dtype=np.int64), np.array([len(x) for x in right], dtype=np.int64)
    sizes = np.maximum(n, m)
    for width in np.unique(sizes[np.abs(n - m) < _BAND]) if len(left) else []:
        pick = np.flatnonzero((sizes == width) & (np.abs(n - m) < _BAND))
        a, b = (edits.codes([x[i] for i in pick], int(width), fill).T for x, fill in ((left, 0xFFFFFFFE), (right, 0xFFFFFFFF)))
        far, before, result = np.full(len(pick), 9.0), {}, np.full(len(pick), 9.0)
        row = {j: np.full(len(pick), 0.9 * j) for j in range(min(_BAND, int(width)) + 1)}
        result[(n[pick] == 0) & (m[pick] == 0)] = 0.0
        for j, v in row.items():
            result[(n[pick] == 0) & (m[pick] == j)] = 0.9 * j
        for i in range(1, int(width) + 1):
            new = {}
            for j in range(max(0, i - _BAND), min(int(width), i + _BAND) + 1):
                if j == 0:
                    new[0] = np.full(len(pick), 0.9 * i)
                else:
                    x, y = a[i - 1], b[j - 1]
                    out_of = np.where(x == a[i - 2], 0.5, 0.9) if i > 1 else 0.9
                    into = np.where(y == b[j - 2], 0.5, 0.9) if j > 1 else 0.9
                    both = (x < 128) & (y < 128)
                    other = np.where(x == y, 0.0, np.where(both & _NEAR_KEYS[np.minimum(x, 127), np.minimum(y, 127)], 0.7, 1.1))
                    v = np.minimum(np.minimum(row.get(j, far) + out_of, new.get(j - 1, far) + into), row.get(j - 1, far) + other)
                    if i > 1 and j > 1 and j - 2 in before:
                        v = np.where((x == b[j - 2]) & (a[i - 2] == y) & (x != y), np.minimum(v, before[j - 2] + 0.8), v)
                    new[j] = v
                done = (n[pick] == i) & (m[pick] == j)
                result[done] = new[j][done]
            before, row = row, new
        out[pick] = result
    return out


def allowed(size: int) -> float:
    """The largest weighted distance for a wording of so many letters."""
    return 0.0 if size <= 3 else 1.0 if size <= 5 else 2.0


def wordings(form: str) -> list[str]:
    """A form as letters only, in the orders of its words, with none or one of them in the plural."""
    words = re.findall(r"[a-z0-9]+", plain(form))
    orders = permutations(words) if len(words) <= _ORDERS else [words, sorted(words)]
    return sorted({"".join(w + "s" * (i == k) for i, w in enumerate(order)) for order in orders for k in range(-1, len(order))} - {""})


class Reader:
    """Reads values as wordings: `words` are those of the list, `noise` those that say nothing, `foreign` wordings for words."""

    def __init__(self, words: list[str], noise: tuple[str, ...], foreign: Mapping[str, str]):
        self.words, self.noise, self.foreign = set(words), frozenset(noise), dict(foreign)
        self.by_letter: dict[str, list[str]] = {}
        for w in sorted(words, key=lambda w: (len(w), w)):
            self.by_letter.setdefault(w[0], []).append(w)

    def readings(self, value: str) -> list[str]:
        """A value as letters only: as typed, without noise words, with short and foreign words written out."""
        parted = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])", " ", value)
        out = []
        for text in (parted, value):
            words = re.findall(r"[^\W_]+", plain(text))
            kept = [w for w in words if w not in self.noise]
            full = [x for w in kept for x in self._whole(w, len(kept) > 1).split()]
            out += [kept, full] + [sorted(x) for x in (kept, full) if len(x) > _ORDERS]
        return sorted({"".join(x) for x in out if x})

    def _whole(self, word: str, beside: bool) -> str:
        if word in self.foreign:
            return self.foreign[word]
        if not beside or len(word) < 3 or word in self.words:
            return word
        single = word[:-1] if word.endswith("s") else word
        short = not re.search("[aeiou]", single[1:]) and len(single) >= 3
        return next((w for w in self.by_letter.get(single[0], ()) if len(w) > len(word) and (w.startswith(single) or short and _in_order(single, w))), word)


def _in_order(short: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in short)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a text in the first column, a row for each of its keys: one edit from three letters on, two from six."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        size = np.array([len(t) for t in texts], dtype=np.int64)
        owners, keys = edits.edit_keys(texts, np.where(size <= 2, 0, np.where(size <= 5, 1, 2)))
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(owners)).columns, pa.array(keys.view(np.int64))], names=[*batch.schema.names, "k"])


@F.pandas_udf(T.DoubleType())
def _cost(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(weighted_all(a.tolist(), b.tolist()))


def map_values(values: DataFrame, listed: DataFrame, value_col: str = "type", noise: tuple[str, ...] = (), foreign: Mapping[str, str] | None = None) -> DataFrame:
    """(value, n, canonical, wording, cost) for every distinct value that is not absent and not exactly on the list.

    n is how many rows hold it. canonical is `unmatched`, wording and cost null, where no wording is near enough. noise are words that say
    nothing, foreign maps words to words of the list; both are the caller's. Nulls, blanks and words for nothing give no row. Values
    longer than any wording plus two letters, once noise is taken off, are unmatched without a look-up.
    An empty list leaves everything unmatched; types that are null, and null or repeated known forms, are passed over.
    The list may have any size; only its distinct words reach the driver.
    """
    spark = values.sparkSession
    scratch, tasks = Scratch(spark, "values"), spark.sparkContext.defaultParallelism
    forms = F.explode(F.array_distinct(F.concat(F.array("type"), F.coalesce("known_forms", F.array().cast("array<string>")))))
    entries = listed.filter("type is not null").select("type_id", "type", forms.alias("form")).filter("form is not null")

    @F.pandas_udf("array<string>")
    def as_wordings(v: pd.Series) -> pd.Series:
        return v.map(wordings)

    @F.pandas_udf("array<string>")
    def as_words(v: pd.Series) -> pd.Series:
        return v.map(lambda x: re.findall(r"[a-z0-9]+", plain(x)))

    held = scratch.save(entries.repartition(tasks, "form").select(F.explode(as_wordings("form")).alias("wording"), "type_id", F.col("type").alias("canonical")).distinct())
    longest = (held.agg(F.max(F.length("wording"))).first()[0] or 0) + 2
    listed_words = [r.w for r in entries.select(F.explode(as_words("form")).alias("w")).distinct().collect()]
    sent = spark.sparkContext.broadcast(Reader(listed_words, noise, foreign or {}))

    @F.pandas_udf("array<string>")
    def readings(v: pd.Series) -> pd.Series:
        return v.map(lambda x: [r for r in sent.value.readings(x) if len(r) <= longest])

    counted = scratch.save(values.groupBy(F.col(value_col).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    types = listed.filter("type is not null").select(F.col("type").alias("value")).distinct()
    # how often the canonical values themselves occur: a row an entry of the list
    common = types.join(shuffled(counted), "value", "left").select(F.col("value").alias("canonical"), F.coalesce("n", F.lit(0)).alias("common"))
    keys = scratch.save(held.join(shuffled(common), "canonical").select("wording", "type_id", "canonical", "common").mapInArrow(_keyed, "wording string, type_id int, canonical string, common bigint, k bigint"))
    open_values = counted.filter(~is_absent(F.col("value"))).join(bounded(types), "value", "left_anti")
    # an explicit number of tasks: few and light rows would be put into one
    read = open_values.repartition(tasks, "value").select(F.explode(readings("value")).alias("reading"), "value")
    near = read.mapInArrow(_keyed, "reading string, value string, k bigint").join(bounded(keys), "k")
    costs = near.select("value", "reading", "wording", "type_id", "canonical", "common").distinct().repartition(tasks, "value").withColumn("cost", F.round(_cost("reading", "wording"), 3))
    size = F.length("wording")
    fits = costs.filter(F.col("cost") <= F.when(size <= 3, 0.0).when(size <= 5, 1.0).otherwise(2.0))
    best = fits.groupBy("value").agg(F.min(F.struct("cost", (-F.col("common")).alias("rare"), "type_id", "canonical", "wording")).alias("b"))
    return open_values.join(shuffled(best), "value", "left").select("value", "n", F.coalesce("b.canonical", F.lit(UNMATCHED)).alias("canonical"), F.col("b.wording").alias("wording"), F.col("b.cost").alias("cost"))


def attach(rows: DataFrame, mapping: DataFrame, id_col: str, value_col: str, order_col: str) -> DataFrame:
    """(id, canonical_type) for every distinct id whose value is in the mapping; the latest row of an id decides."""
    latest = rows.select(id_col, value_col, order_col).filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max_by(value_col, F.struct(order_col, value_col)).alias("value"))
    pairs = mapping.select("value", F.col("canonical").alias("canonical_type"))
    if pairs.limit(_BROADCAST_VALUES + 1).count() <= _BROADCAST_VALUES:
        return latest.join(F.broadcast(pairs), "value").select(id_col, "canonical_type")
    copies = pairs.withColumn("salt", F.explode(F.expr(f"sequence(0L, {_SALTS - 1}L)")))
    return latest.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(_SALTS))).join(shuffled(copies), ["value", "salt"]).select(id_col, "canonical_type")
