"""What a spelling of a name says: its core, what kind of organisation, and which one of several it is."""

from __future__ import annotations

import re
import unicodedata
from itertools import permutations
from typing import NamedTuple

#: Words that name the kind of an organisation, and wordings of other languages or their own short forms.
KINDS = {
    "armed wing": ("ala armata", "aw"),
    "boys": ("boyz",),
    "brotherhood": ("revolutionary brotherhood", "rb"),
    "cartel": ("kartell",),
    "clan": (),
    "crew": ("street crew", "sc"),
    "crime family": ("famiglia", "family", "cf"),
    "faction": ("fraccion", "fazione"),
    "force": ("self defence force", "self defense force", "sdf"),
    "front": ("liberation front", "lf"),
    "gang": ("banda", "bande"),
    "gumi": ("group",),
    "militia": ("milicia", "milizia"),
    "motorcycle club": ("moto club", "mc"),
    "organization": ("organisation", "organizzazione", "organizacion"),
    "posse": (),
    "society": (),
    "syndicate": ("sindicato",),
    "triad": (),
}
#: Words that make a successor, a younger or a supporting group of the name beside them.
OTHERS = ("continuity", "juniors", "new", "nomads", "original", "prospects", "provisional", "real", "supporters", "young", "youth")
#: Articles, prepositions and remarks without meaning here.
FILLERS = ("called", "crime", "das", "de", "dei", "del", "der", "di", "die", "el", "i", "il", "la", "las", "le", "les", "los", "of", "organised", "organized", "so", "the")
#: Digits typed for letters, and letters that writers exchange by sound.
LEET = str.maketrans("0134567", "oleasbt")
SOUNDS = (("tch", "ch"), ("sch", "sh"), ("ph", "f"), ("ck", "k"), ("c", "k"), ("y", "i"), ("j", "i"), ("w", "v"), ("z", "s"))
_DOUBLED, _BRACKETS, _REMARK = re.compile(r"(.)\1+"), re.compile(r"\([^)]*\)|\[[^\]]*\]"), re.compile(r"\s+[–—-]\s+organi[sz]ed crime\s*$")
_DOTTED, _TOKEN = re.compile(r"\b([a-z])\.(?=[a-z]\b)"), re.compile(r"[^\W_]+")
_CHAPTER = re.compile(r"(?:,\s*|\s)((?:(?:alt|bad|lower|new|old|port|saint|san|st|upper)[\s-])?[\w'’-]+(?:\s(?:bay|heights))?)\s+(\w+)\s*$")


class Parsed(NamedTuple):
    """core: letters of the own name by sound, words in order; kind; which: numbers, place, and words such as new."""

    words: tuple[str, ...]
    kind: str
    which: str


def plain(text: str) -> str:
    """Without accents, in lower case."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.lower()).replace("ß", "ss")
    return "".join(c for c in text if not unicodedata.combining(c))


def by_sound(word: str) -> str:
    """Letters that sound alike as one, no doubled letters."""
    for a, b in SOUNDS:
        if a in word:
            word = word.replace("ch", "\0").replace(a, b).replace("\0", "ch") if a == "c" else word.replace(a, b)
    return _DOUBLED.sub(r"\1", word)


def distance(a: str, b: str, most: int) -> int:
    """Edits, with exchanges of neighbours (optimal string alignment); most + 1 if there are more than `most`."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def _letters(word: str) -> int:
    """A bit for each kind of letter, some kinds together: an edit adds and takes away one kind at most, so words far apart here are far apart."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


def _may_be_near(a: int, b: int, most: int) -> bool:
    return (a & ~b).bit_count() <= most and (b & ~a).bit_count() <= most


def _shortens(short: str, word: str) -> bool:
    """A beginning of two letters or more, or the word with letters left out but its first and all but vowels kept."""
    if len(short) >= len(word) or len(short) < 2 or short[0] != word[0]:
        return False
    if word.startswith(short):
        return True
    rest = iter(word)
    return not re.search("[aeiou]", short[1:]) and all(c in rest for c in short) and len(short) >= (3 if len(word) > 4 else 2)


class Lexicon:
    """Word lists for names, and what follows from them. Without any list, names are only letters in some order."""

    def __init__(self, kinds: dict[str, tuple[str, ...]] = KINDS, others: tuple[str, ...] = OTHERS, fillers: tuple[str, ...] = FILLERS):
        self.kinds, self.others, self.fillers = kinds, others, fillers
        self.kind_words = sorted({w for k, forms in kinds.items() for f in (k, *forms) for w in f.split() if len(w) > 3})
        self.short = {f: k for k, forms in kinds.items() for f in forms if len(f) <= 3}
        self.by_form = {f: k for k, forms in kinds.items() for f in (k, *forms)}
        self._long = [(w, _letters(w), 1 + (len(w) >= 8)) for w in self.kind_words if len(w) >= 4]
        self._short = [(w, _letters(w)) for w in self.kind_words if len(w) <= 6]
        self._phrases = [f.split() for f in self.by_form if " " in f]
        self._known: dict[tuple, str | set[str] | None] = {}

    def _once(self, rule, token):
        key = (rule.__name__, token)
        if key not in self._known:
            if len(self._known) >= 40_000:
                self._known.clear()
            self._known[key] = rule(token)
        return self._known[key]

    def _kind_word(self, token: str) -> str | None:
        if token in self.kind_words:
            return token
        if len(token) >= 4:
            own = _letters(token)
            near = [w for w, theirs, limit in self._long if _may_be_near(own, theirs, limit) and distance(token, w, limit) <= limit]
            if near:
                return min(near, key=lambda w: (distance(token, w, 2), w))
        return None


    def _kind_short(self, token: str) -> str | None:
        """The kind word that a token shortens or misspells, an initial, or nothing."""
        if len(token) == 1:
            return token if any(k[0] == token for k in self.kinds) else None
        found = [w for w in self.kind_words if _shortens(token, w) and (len(token) <= 5 or w.startswith(token))]
        own = _letters(token)
        found += [w for w, theirs in self._short if len(token) >= 3 and _may_be_near(own, theirs, 1) and distance(token, w, 1) <= 1]
        return min(found, key=lambda w: (distance(token, w, 9), w)) if found else None


    def _missing(self, exact: frozenset[str]) -> set[str]:
        """Words still missing from a kind of several words whose other words are there."""
        return {w for f in self._phrases if not exact.isdisjoint(f) for w in f} - exact


    def _beside(self, kind: str) -> set[str]:
        return {w for f in (kind, *self.kinds.get(kind, ())) for w in f.split()}


    def _kind_of(self, words: list[str]) -> str:
        return self._once(self._kind_among, tuple(words))


    def _kind_among(self, words: tuple[str, ...]) -> str:
        if "motorcycle" in words:
            return "motorcycle club"
        for size in (3, 2, 1):
            for i in range(len(words) - size + 1):
                if (k := self.by_form.get(" ".join(words[i : i + size]))) is not None:
                    return k
        for w, k in (("club", "motorcycle club"), ("motorcycle", "motorcycle club"), ("wing", "armed wing"), ("crew", "crew"), ("street", "crew"), ("brotherhood", "brotherhood"), ("front", "front"), ("force", "force"), ("defence", "force")):
            if w in words:
                return k
        return ""


    def parse(self, name: str) -> Parsed:
        """A folded name taken apart."""
        text = plain(name)
        text = _BRACKETS.sub(" ", text)
        text = _REMARK.sub(" ", text)
        text = _DOTTED.sub(r"\1", text)  # m.c. as mc
        which: list[str] = []
        if m := _CHAPTER.search(text):
            if distance(m[2], "chapter", 1) <= 1:
                which.append("at " + by_sound(re.sub(r"\W", "", m[1])))
                text = text[: m.start()]
        tokens = _TOKEN.findall(text)
        tokens = [t.translate(LEET) if not t.isalpha() and re.search("[a-z]", t) and re.search("[0-9]", t) else t for t in tokens]
        which += sorted(str(int(t)) for t in tokens if t.isdecimal())
        tokens = [t for t in tokens if not t.isdecimal()]
        kinds: list[str] = []
        rest: list[str] = []
        exact = {t for t in tokens if t in self.kind_words or t in self.short}
        missing = self._once(self._missing, frozenset(exact)) if exact else ()
        for t in tokens:
            if t in self.others:
                which.append(t)
            elif t in exact:
                kinds += (self.short.get(t) or t).split()
            elif near := [w for w in missing if distance(t, w, 1) <= 1 or _shortens(t, w)]:
                kinds.append(min(near))
            elif not exact and (kind := self._once(self._kind_word, t)):
                kinds.append(kind)
            else:
                rest.append(t)
        # a short form, or a slip in a short word, counts as a kind only at either end and beside words that can be the name
        for _ in range(3):
            if len(rest) < 2 or kinds and self._kind_of(kinds):
                break
            at = next((i for i in (len(rest) - 1, 0) if (self._once(self._kind_short, rest[i]) or kinds and len(rest[i]) == 1) and rest[i] not in self.fillers), None)
            if at is None:
                break
            kinds += (self._once(self._kind_short, rest[at]) or "").split()
            if len(rest[at]) == 1:
                if kinds:
                    del rest[at]
                    continue
                kinds = [rest[at]]
            del rest[at]
        if kinds and len(rest) > 1:  # initials and short forms of the kind's other words
            beside = self._once(self._beside, self._kind_of(kinds))
            rest = [t for t in rest if len(t) > 1 and not any(len(t) > 2 and _shortens(t, w) for w in beside)] or rest
        words = [t for t in rest if t not in self.fillers] or [t for t in rest]
        words = [by_sound(t) for t in words]
        kind = self._kind_of(kinds)
        if not kind and kinds and len(kinds[-1]) == 1:
            kind = kinds[-1]  # an initial: any kind that begins so
        return Parsed(tuple(words), kind, " ".join(sorted(which)))

    def initials(self, name: str) -> str:
        """First letters of all words but articles, in upper case."""
        return "".join(t[0] for t in _TOKEN.findall(plain(name)) if t not in self.fillers).upper()


DEFAULT = Lexicon()
parse, initials = DEFAULT.parse, DEFAULT.initials


def orders(words: tuple[str, ...] | list[str]) -> list[str]:
    """The words in one piece: in every order of up to three, more of them as they stand and sorted."""
    if len(words) > 3:
        return sorted({"".join(words), "".join(sorted(words))})
    return sorted({"".join(x) for x in permutations(words)})


def cores(p: Parsed) -> list[str]:
    """The own name in one piece, in its orders; the first stands for all of them."""
    found = orders(p.words)
    own = "".join(sorted(p.words)) if len(p.words) > 3 else found[0]
    return [own, *(c for c in found if c != own)]


def rest(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """The words of two names without those they have in common, repeated words one by one."""
    left, right = list(a), list(b)
    for w in a:
        if w in right:
            left.remove(w)
            right.remove(w)
    return left, right


def same_kind(a: str, b: str) -> bool:
    """Equal, or one is missing or an initial of the other."""
    return a == b or not a or not b or (len(a) == 1 and b.startswith(a)) or (len(b) == 1 and a.startswith(b))
