"""Problem 5: link the spellings of names typed by people, by merge-and-rematch resolution.

Profiles start as single spellings. Spellings that one record gives for one organisation merge first (its standard name, original
text and aliases), then those that say the same once slips of form are undone (case, accents, order, articles,
shortened or foreign words for the kind, joined words). A merged profile has the spellings, kinds and initials of all its members,
and with those it is matched again: edits that are not enough between two bare spellings are enough between
profiles that agree in kind or in attested initials. Every round contracts the matches by one level of the low-diameter
decomposition; rounds go on until no two profiles match.

Numbers, chapters and words like `new` are part of what a name means and never differ within a profile (see `spellings`).
Spellings enter blocking by what is left of their own name after deletions. A merge adds no letters to a spelling, so those pairs are
found once and matched again in each round with what their profiles have become; by initials and a whole word profiles
enter blocking anew in each round. Spellings, not records, are compared, so an organisation that a third of all records name costs
as much as the number of its spellings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import fold_name, is_absent, squeeze
from ..operators.joins import bounded, hot_values, shuffled, spread_join
from ..scratch import Scratch
from . import edits
from . import spellings as S
from .grouping import BASE_EDGES, decompose, low_diameter_groups, settle, shared_key_edges, simple_edges

_PARSED = pa.schema([(c, pa.list_(pa.string()) if c == "words" else pa.string()) for c in ("name", "core", "kind", "which", "words", "initials")])
#: Own names of at least so many letters may differ in one, in two, and with attested initials in three, edits.
ONE_EDIT, TWO_EDITS, THREE_EDITS = 4, 6, 10
#: Initials and a word that more profiles have are parted by what else their names say before pairs are made.
_HOT = 64
_SALTS = 16
#: Keys that one task pairs, and names that one task takes apart: some seconds of work.
_KEYS_A_TASK, _NAMES_A_TASK = 1_000_000, 20_000
#: Keys of a rest of a name, about.
_REST_KEYS = 400
#: Fresh spellings or keys that go to every task: some megabytes at most.
_FEW = 50_000


def _parser(lexicon: S.Lexicon):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [lexicon.parse(n) for n in names]
            columns = names, [S.cores(p)[0] for p in found], [p.kind for p in found], [p.which for p in found], [p.words for p in found], [lexicon.initials(n) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)

    return parse


def _apart(texts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)


def _emit(ids: np.ndarray, owners: np.ndarray, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, ids, keys): keys by their part, in blocks of eight bytes each, so that no row is made of a key. A key may come twice, which only repeats a candidate."""
    part = (keys % np.uint64(parts)).astype(np.int32)
    turn = np.argsort(part, kind="stable")
    ids, keys, part = ids[owners].astype(np.int64)[turn], keys[turn], part[turn]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    cells = [[x[i:j].tobytes() for i, j in zip(cuts, [*cuts[1:], len(part)])] for x in (ids, keys)]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts]), *(pa.array(c, pa.binary()) for c in cells)], names=["part", "ids", "keys"])


def _pairs(keyed: DataFrame, make: Callable[..., Iterator[pa.RecordBatch]], n_keys: int) -> DataFrame:
    """(a, b), a < b, each once, of the ids to which make gives a key in common; keys are spread by their count, so a task holds so many."""
    parts = 1 + n_keys // _KEYS_A_TASK
    blocks = keyed.mapInArrow(partial(make, parts=parts), "part int, ids binary, keys binary")
    return blocks.repartitionById(parts, "part").mapInArrow(_sharing, "a bigint, b bigint").distinct()


def _name_keys(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(id, words, which) to (part, ids, keys): keys of the own name in all its orders, and of many words without any two of them."""
    for batch in batches:
        ids, words, which = batch.column(0).to_numpy(), batch.column(1).to_pylist(), _apart(batch.column(2).to_pylist())
        owner, texts = [], []
        more_owner, more = [], []
        for k, w in enumerate(words):
            for c in S.orders(w):
                owner.append(k)
                texts.append(c)
            if len(w) > 3:
                for gone in (g for n in range(3) for g in combinations(range(len(w)), n)):
                    more_owner.append(k)
                    more.append(" ".join(sorted(x for i, x in enumerate(w) if i not in gone)))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        at, keys = edits.edit_keys(texts, np.where(size >= TWO_EDITS, 2, np.where(size >= ONE_EDIT, 1, 0)))
        owners = np.array(owner, dtype=np.int64)[at] if len(at) else np.empty(0, np.int64)
        owners = np.concatenate((owners, np.array(more_owner, dtype=np.int64)))
        keys = np.concatenate((keys, edits.mix(_apart(more))))
        yield _emit(ids, owners, edits.mix(keys ^ which[owners]), parts)


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids and keys, with all holders of a key in one partition, to (a, b), a < b, that share a key; a pair may come several times."""
    ids, keys = [], []
    for batch in batches:
        ids += [np.frombuffer(x, dtype=np.int64) for x in batch.column(1).to_pylist()]
        keys += [np.frombuffer(x, dtype=np.uint64) for x in batch.column(2).to_pylist()]
    if not ids:
        return
    ids, keys = np.concatenate(ids), np.concatenate(keys)
    turn = np.argsort(keys)
    ids, keys = ids[turn], keys[turn]
    at, held, size = np.arange(len(keys)), [], 0
    for step in range(1, len(keys)):
        # holders so many places apart; fewer are left with every step
        at = at[: np.searchsorted(at, len(keys) - step)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        held.append((ids[at], ids[at + step]))
        size += len(at)
        if size > _KEYS_A_TASK:
            yield _once_each(held)
            held, size = [], 0
    if held:
        yield _once_each(held)


def _once_each(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    x, y = (np.concatenate(c) for c in zip(*held))
    a, b = np.minimum(x, y), np.maximum(x, y)
    turn = np.lexsort((b, a))
    a, b = a[turn], b[turn]
    new = (a < b) & ((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
    return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], names=["a", "b"])


def _key_count() -> Column:
    """How many keys `_name_keys` makes of a row of words at most."""
    letters, words = _letters("words"), F.size("words")
    orders = F.when(words == 3, 6).when(words == 1, 1).otherwise(2)
    one = F.when(letters <= 32, 1 + letters * (letters + 1) / 2).otherwise(0) + F.when(letters > 30, 125).otherwise(0)
    return orders * one + F.when(words > 3, 1 + words * (words + 1) / 2).otherwise(0)


def _rest_keys(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(id, rest, key) to (part, ids, keys): keys of a name without a word of it, together with what it must have in common."""
    for batch in batches:
        ids, words, same = batch.column(0).to_numpy(), batch.column(1).to_pylist(), _apart(batch.column(2).to_pylist())
        owner, texts = [], []
        for k, w in enumerate(words):
            for c in S.orders(w):
                owner.append(k)
                texts.append(c)
        at, keys = edits.edit_keys(texts, np.full(len(texts), 3, dtype=np.int64))
        owners = np.array(owner, dtype=np.int64)[at] if len(at) else np.empty(0, np.int64)
        yield _emit(ids, owners, edits.mix(keys ^ same[owners]), parts)


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Least edits between two lists of words in one piece, over their orders, 4 for more than 3; of many words, those in common are left out."""
    owner, left, right = [], [], []
    for k, (x, y) in enumerate(zip(a, b)):
        x, y = list(x), list(y)
        ways = [(x, y)]
        if max(len(x), len(y)) > 3:
            ways.append(S.rest(x, y))
        for u, v in ways:
            for p in S.orders(u):
                for q in S.orders(v):
                    owner.append(k)
                    left.append(p)
                    right.append(q)
    best = np.full(len(a), 4, dtype=np.int32)
    np.minimum.at(best, np.array(owner, dtype=np.int64), edits.osa(left, right, 3))
    return pd.Series(best)


def _mentions(extracted: DataFrame, generic: DataFrame) -> DataFrame:
    """(std, other) distinct folded names of records; other is null where a record has only its standard name."""
    std = fold_name(F.col("standard_name"))
    others = F.transform(F.concat(F.array("original_text_name"), F.coalesce("aliases", F.array().cast("array<string>"))), squeeze)
    # short single words in capitals are initials: no spelling, but kept as evidence
    rows = extracted.select(std.alias("std"), F.explode(F.array_distinct(others)).alias("raw")).filter(~is_absent(F.col("std"))).distinct()
    acronym = F.col("raw").rlike(r"^[\p{Lu}\p{Nd}]{2,8}$")
    rows = rows.select("std", F.when(~is_absent(F.col("raw")), F.lower("raw")).alias("other"), F.coalesce(acronym, F.lit(False)).alias("acronym"))
    names = generic.select(fold_name(F.col("name")).alias("g")).filter("g is not null").distinct()
    return (
        rows.join(bounded(names), F.col("other") == F.col("g"), "left").select("std", F.when(F.col("g").isNull(), F.col("other")).alias("other"), "acronym")
        .join(bounded(names.toDF("std")), "std", "left_anti").distinct()
    )


def _letters(words: str) -> Column:
    return F.length(F.array_join(words, ""))


def resolve(extracted: DataFrame, generic: DataFrame, lexicon: S.Lexicon = S.DEFAULT) -> DataFrame:
    """(name, group_id) for every folded spelling of standard_name; group_id is one of the organisation's spellings.

    Null and blank standard names and absent values give no row, in original names and aliases they say nothing, as do
    generic names (a generic standard name is a group of its own). Null, empty and repeated aliases, repeated records and
    columns beside the named ones change nothing. An empty table gives no row.
    """
    scratch = Scratch(extracted.sparkSession, "names")
    mentions = scratch.save(_mentions(extracted, generic))
    rows = mentions.count()
    all_std = extracted.select(fold_name(F.col("standard_name")).alias("name")).filter("name <> ''").distinct()
    spelled = mentions.filter("not acronym").select(F.col("std").alias("name"), F.col("other")).select(F.explode(F.array("name", "other")).alias("name")).union(mentions.select("std"))
    # numbers stand for the spellings from here on; they are written once, so they stay
    names = spelled.filter("name is not null").repartition(1 + rows // _NAMES_A_TASK, "name").distinct()
    taken = names.mapInArrow(_parser(lexicon), "name string, core string, kind string, which string, words array<string>, initials string")
    parsed = scratch.save(taken.select(F.monotonically_increasing_id().alias("id"), "*", F.concat_ws("\t", "core", "which").alias("own")))
    n, n_keys = parsed.agg(F.count(F.lit(1)), F.coalesce(F.sum(_key_count()), F.lit(0.0)).cast("bigint")).first()
    # a name without a kind takes the kind of the only one with its core
    only = parsed.filter("length(kind) > 1").groupBy("own").agg(F.min("kind").alias("one"), F.max("kind").alias("two")).filter("one = two").select("own", "one")
    fits = (F.col("kind") == "") | ((F.length("kind") == 1) & F.col("one").startswith(F.col("kind")))
    forms = scratch.save(spread_join(parsed, only, "own", hot_values(parsed, "own", n), "left").withColumn("kind", F.when(F.col("one").isNotNull() & fits, F.col("one")).otherwise(F.col("kind"))).drop("one", "own"))
    scratch.drop(parsed)
    which = forms.select("name", "id", "which", "initials")
    # initials in small letters, and single words too short to tell one organisation from another, link nothing
    too_short = F.col("b").rlike(r"^[\p{L}\p{Nd}]{1,5}$") | (F.upper("b") == F.col("na"))
    given = mentions.filter("not acronym and other is not null and std <> other").select(F.col("std").alias("a"), F.col("other").alias("b")).distinct()
    said = spread_join(given, which.toDF("a", "ia", "wa", "na"), "a", hot_values(given, "a", rows))
    said = spread_join(said, which.drop("initials").toDF("b", "ib", "wb"), "b", hot_values(given, "b", rows)).filter((F.col("wa") == F.col("wb")) & ~too_short).select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    equal = shared_key_edges(forms.filter("core <> ''").select("id", F.concat_ws("\t", "core", "kind", "which").alias("key")))
    short = mentions.filter("acronym").select(F.col("std").alias("name"), F.upper("other").alias("initials")).distinct()
    attested = scratch.save(short.join(shuffled(forms.select("name", "id")), "name").select("id", "initials"))
    pairs = scratch.save(_near(forms, n_keys))
    first = low_diameter_groups(said.unionByName(equal))
    groups = scratch.save(forms.select("id", "kind").join(shuffled(first), "id", "left").select("id", "kind", F.coalesce("group_id", "id").alias("group_id"), F.lit(True).alias("fresh")))
    edges, level, known = None, 0, None
    while True:
        found, mine, held = _rematch(forms, groups, pairs, attested, known, scratch)
        merges = scratch.save(simple_edges(found if edges is None else found.unionByName(edges.select("a", "b")), level))
        if edges is not None:
            scratch.drop(edges)
        if not (m := merges.count()):
            break
        # profiles are the vertices now; the spellings follow their profile, and matches between what has merged so far stay open
        merged, edges = decompose(merges, m, scratch) if not level or m > BASE_EDGES else settle(merges, scratch)
        # only what a merge touched can match what it did not match before
        touched = scratch.save(merged.filter("id <> up").select(F.explode(F.array("id", "up")).alias("group_id")).distinct())
        into = merged.join(shuffled(touched.select(F.col("group_id").alias("up"), F.lit(True).alias("is_fresh"))), "up", "left").select(F.col("id").alias("group_id"), F.col("up").alias("into"), "is_fresh")
        moved = spread_join(groups.drop("fresh"), into, "group_id", hot_values(groups, "group_id", n), "left")
        after = scratch.save(moved.select("id", "kind", F.coalesce("into", "group_id").alias("group_id"), F.coalesce("is_fresh", F.lit(False)).alias("fresh")))
        words = mine.drop("fresh") if known is None else mine.drop("fresh").unionByName(known)
        still = scratch.save(words.join(bounded(touched), "group_id", "left_anti"))
        level += 1
        for old in (groups, merges, merged, touched, mine, held, *([known] if known is not None else [])):
            scratch.drop(old)
        groups, known = after, still
    names = forms.select("id", "name")
    named = spread_join(groups.select("id", "group_id"), names.toDF("group_id", "group_name"), "group_id", hot_values(groups, "group_id", n)).join(shuffled(names), "id").select("name", "group_name")
    return all_std.join(shuffled(named), "name", "left").select("name", F.coalesce("group_name", "name").alias("group_id"))


def _near(forms: DataFrame, n_keys: int) -> DataFrame:
    """(a, b, d, size) of spellings of the same number, place and so on whose own names share a key and differ in two edits or fewer."""
    # spellings of one core and kind have merged already: one of them stands for all
    one = forms.filter("core <> ''").groupBy("core", "kind", "which").agg(F.min("id").alias("id"), F.min_by("words", "id").alias("words"))
    # a key has as many holders as there are strings within two letters of it, not as there are rows
    candidates = _pairs(one.select("id", "words", "which"), _name_keys, n_keys)
    words = forms.select("id", "words")
    rows = candidates.join(shuffled(words.toDF("a", "x")), "a").join(shuffled(words.toDF("b", "y")), "b")
    return rows.select("a", "b", _distance("x", "y").alias("d"), F.least(_letters("x"), _letters("y")).alias("size")).filter("d <= 2")


def _rematch(forms: DataFrame, groups: DataFrame, pairs: DataFrame, attested: DataFrame, known: DataFrame | None, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b) of profiles of which one is fresh and that match now, with all that their members say; initials and words of fresh profiles; and those with which the matches were found.

    known: initials and words of the profiles that are not fresh.
    """
    group_of = groups.select("id", "group_id", "fresh")
    full = groups.filter("length(kind) > 1").groupBy("group_id").agg(F.collect_set("kind").alias("kinds"))  # at most as many as there are kinds
    a, b = (group_of.toDF(x, f"g{x}", f"f{x}") for x in "ab")
    near = pairs.join(shuffled(a), "a").join(shuffled(b), "b").filter("ga <> gb and (fa or fb)").select("ga", "gb", "d", "size").distinct()
    near = near.join(shuffled(full.toDF("ga", "ka")), "ga", "left").join(shuffled(full.toDF("gb", "kb")), "gb", "left")
    stated = F.col("ka").isNotNull() & F.col("kb").isNotNull()
    agree = F.coalesce(F.arrays_overlap("ka", "kb"), F.lit(False))
    near = near.filter(((F.col("d") <= 1) & (agree | ~stated)) | ((F.col("d") == 2) & agree & (F.col("size") >= TWO_EDITS))).select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    fresh = bounded(group_of.filter("fresh").select("id", "group_id"), _FEW)
    # profiles with the same attested initials and one whole word in common; a profile of very many spellings is spread over tasks
    profile = attested.join(fresh, "id").select("group_id", "initials").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    own = forms.drop("initials").filter(F.size("words") > 1).filter(_letters("words") >= THREE_EDITS).join(fresh, "id").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
    words = own.join(shuffled(profile), ["group_id", "salt"]).select("id", "group_id", "words", F.posexplode("words").alias("at", "word"), "initials", "which", "kind")
    others = F.concat(F.slice("words", F.lit(1), F.col("at")), F.slice("words", F.col("at") + 2, F.size("words")))
    key = F.concat_ws("\t", "initials", "which", "kind", "word")
    one = words.groupBy("group_id", key.alias("key"), F.array_sort(others).alias("rest")).agg(F.min("id").alias("id"))
    mine = scratch.save(one.drop("id").withColumn("fresh", F.lit(True)))
    met = mine
    if known is not None:
        met = mine.unionByName(known.join(bounded(mine.select("key").distinct(), _FEW), "key", "left_semi").withColumn("fresh", F.lit(False)))
    counts = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = scratch.save(met.join(shuffled(counts), "key"))
    few = held.filter(F.col("n") <= _HOT).select("key", "group_id", "rest", "fresh")
    direct = few.toDF("key", "a", "x", "fa").join(shuffled(few.toDF("key", "b", "y", "fb")), "key").filter("a < b and (fa or fb)").select("a", "b", "x", "y")
    helped = direct
    many = held.filter(F.col("n") > _HOT)
    if n_many := many.count():
        helped = direct.unionByName(_parted(many, n_many))
    return near.unionByName(helped.filter(_distance("x", "y") <= 3).select("a", "b")), mine, held


def _parted(held: DataFrame, n: int) -> DataFrame:
    """(a, b, x, y) of profiles under frequent initials and words, n rows, which are parted by what the rest of a name leaves after three deletions."""
    many = held.select(F.xxhash64("group_id", "key", "rest").alias("id"), "rest", "key", "group_id", "fresh")
    shared = _pairs(many.select("id", "rest", "key"), _rest_keys, n * _REST_KEYS).toDF("i", "j")
    texts = many.select("id", "group_id", "rest", "fresh")
    return shared.join(shuffled(texts.toDF("i", "a", "x", "fa")), "i").join(shuffled(texts.toDF("j", "b", "y", "fb")), "j").filter("a <> b and (fa or fb)").select("a", "b", "x", "y")


def linked_pairs(groups: DataFrame) -> DataFrame:
    """(name_a, name_b) of every two spellings of one organisation, name_a < name_b in code-point order."""
    members = groups.select("name", "group_id")
    return members.withColumnRenamed("name", "name_a").join(shuffled(members.withColumnRenamed("name", "name_b")), "group_id").filter("name_a < name_b").select("name_a", "name_b")
