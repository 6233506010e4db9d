"""Reading a typed name and rewriting it into canonical forms, by rules; one name at a time, without Spark.

A name is read as one of these shapes, its parts folded, without titles, legal forms, middle initials and remarks, in a
canonical order and with a nickname of one given name resolved: two names that are read alike mean the same.

From a reading come three sorts of forms, each a 64-bit hash that holds the group's key:

- near forms: what is left without up to two characters. Readings that share one are candidates; whether they are
  variants is told by ``cost`` from both readings themselves, never by the form alone.
- offers: shortenings that a whole name may be called by: given name, surname, initial and surname, login, acronym,
  cut-off beginnings.
- asks, by level: what a name with an ambiguous nickname, one that was cut off, one that was shortened, and one of a
  single word look for among the offers, in this order.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import xxhash

from talkweave.llm.name_data import DEVICES, KEY_ROWS, LEGAL_FORMS, LOOKALIKES, NICKNAMES, NOBODY, ORGANISATION_WORDS, REMARKS, TITLES

#: Pairs of characters that a screen reader makes of one.
_MISREAD_PAIRS = {"rn": "m", "ri": "n", "cl": "d", "vv": "w", "ii": "u", "nn": "m"}
#: Characters read wrongly off a screen.
_MISREAD = str.maketrans({"0": "o", "1": "l", "5": "s", "8": "b", "3": "e", "4": "a", "6": "g", "$": "s", "@": "a", "|": "l"})
_ROOM = re.compile(r"\s*[–—-]\s*(?:room|raum|saal|hall)\s*\w*\s*$", re.I)
_OWNER = re.compile(r"^(.*\S)(?:['’]s|['’])\s+(\S+(?:\s+\S+)?)\s*$")
_CUT = re.compile(r"(?:\.{2,}|…)\s*$")
_TOKENS = re.compile(r"[^\W_]+")

#: Cost of a usual slip, of a wrong letter that is none, and of a difference that no typing error explains: two readings
#: at this cost are not variants.
SLIP, WRONG, APART = 2, 6, 9
#: Words of so many letters may differ by two errors, and of so many by one that is no usual slip. Two errors in a
#: shorter word cost TWICE more.
LONG_WORD, SOLID_WORD, TWICE = 8, 5, 4
#: Characters of a word that near forms leave letters out of. Words within two errors share such a form of their
#: beginnings whatever their length, and ``cost`` compares whole words, so nothing is lost beyond it.
BEGINNING = 32
#: Levels at which a name asks for another, in order.
LEVELS = ("short", "cut", "ask", "late")

GIVEN: dict[str, set[str]] = {}
for _line in NICKNAMES.replace("\n", ";").split(";"):
    if _line.split():
        _formal, *_short = _line.split()
        GIVEN.setdefault(_formal, set()).add(_formal)
        for _s in _short:
            GIVEN.setdefault(_s, set()).add(_formal)
_ORG = {x: word for word, short in ORGANISATION_WORDS.items() for x in [word, *short.replace("-", "").split()]}
_LONGEST = {"given": max(map(len, GIVEN)), "org": max(map(len, _ORG))}

_AT = {c: (y, x + 0.4 * y) for y, row in enumerate(KEY_ROWS.split()) for x, c in enumerate(row)}
#: Pairs of letters that are neighbours on the keyboard or look alike.
_ALIKE = {(a, b) for a, (y, x) in _AT.items() for b, (v, u) in _AT.items() if a != b and abs(y - v) <= 1 and abs(x - u) <= 1.2} | {(a, b) for p in LOOKALIKES.split() for a, b in (p, p[::-1])}


def distance(a: str, b: str, most: int = 3) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between two strings, or ``most`` if not fewer."""
    if abs(len(a) - len(b)) >= most:
        return most
    older, old = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, new[-1] + 1, old[j - 1] + (x != y))
            if older and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            new.append(d)
        if min(new) >= most:
            return most
        older, old = old, new
    return min(old[-1], most)


def _dropped(word: str, i: int) -> int:
    """Cost of leaving a letter out: a slip inside a word or of a doubled letter, APART at a word's beginning or end."""
    doubled = word[i] in (word[i - 1 : i], word[i + 1 : i + 2])
    return SLIP if doubled or 0 < i < len(word) - 1 else APART


def _added(word: str, i: int) -> int:
    """Cost of a letter too many: a slip if it doubles another, else twice that, so that a wrong letter is no cheaper as
    one left out and one added."""
    return SLIP if word[i] in (word[i - 1 : i], word[i + 1 : i + 2]) else WRONG - SLIP if 0 < i < len(word) - 1 else APART


def _replaced(a: str, i: int, b: str, j: int) -> int:
    """Cost of another letter: a slip if both are neighbours on the keyboard or look alike, WRONG inside a word, else APART."""
    if a[i] == b[j]:
        return 0
    if i == 0 or j == 0:
        return APART
    if (a[i], b[j]) in _ALIKE:
        return SLIP
    return APART if i == len(a) - 1 or j == len(b) - 1 else WRONG


def slips(a: str, b: str, most: int = APART) -> int:
    """The least cost of making ``b`` of ``a`` by errors of typing or of reading off a screen, at most ``most``.

    A left out, doubled or inserted letter, two letters swapped, a neighbouring key, a lookalike, or a pair of letters
    read as one is a SLIP; any other letter is WRONG. A word's first letter is hardly ever mistyped, its last one rarely.
    """
    n, m, band = len(a), len(b), most // SLIP
    if abs(n - m) > band:
        return most
    rows = [[0] + [most] * m]
    for j in range(1, min(m, band) + 1):
        rows[0][j] = min(most, rows[0][j - 1] + _added(b, j - 1))
    for i in range(1, n + 1):
        new = [min(most, rows[-1][0] + _dropped(a, i - 1))] + [most] * m
        for j in range(max(1, i - band), min(m, i + band) + 1):
            d = min(rows[-1][j - 1] + _replaced(a, i - 1, b, j - 1), rows[-1][j] + _dropped(a, i - 1), new[j - 1] + _added(b, j - 1))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, rows[-2][j - 2] + (SLIP if i > 2 and j > 2 else WRONG))
            if i > 1 and _MISREAD_PAIRS.get(a[i - 2 : i]) == b[j - 1]:
                d = min(d, rows[-2][j - 1] + SLIP)
            if j > 1 and _MISREAD_PAIRS.get(b[j - 2 : j]) == a[i - 1]:
                d = min(d, rows[-1][j - 2] + SLIP)
            new[j] = min(d, most)
        if min(new) >= most and min(rows[-1]) >= most:
            return most
        rows = [rows[-1], new]
    return rows[-1][m]


def word_cost(a: str, b: str) -> int:
    """``slips`` of two words as far as their length bears it; APART for words of fewer than three letters."""
    if a == b:
        return 0
    short, long = sorted((len(a), len(b)))
    if short < 3:
        return APART
    c = min(APART, min(slips(a, b), slips(b, a)) * (2 if short == 3 else 1))
    if SLIP < c < APART and short > 3:
        if long < SOLID_WORD:
            return APART
        if long < LONG_WORD and distance(a, b) > 1:
            return min(APART, c + TWICE)
    return c


def _left_out(word: str, most: int) -> set[str]:
    """The word and what is left without up to ``most`` of its characters."""
    out = {word}
    for n in range(1, min(most, len(word)) + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in drop) for drop in combinations(range(len(word)), n)}
    return out


@lru_cache(2)
def _index(lexicon: str) -> dict[str, set[str]]:
    """Words of a lexicon by what is left of them without up to two characters."""
    found: dict[str, set[str]] = {}
    for w in GIVEN if lexicon == "given" else _ORG:
        if len(w) >= 4:
            for x in _left_out(w, 2):
                found.setdefault(x, set()).add(w)
    return found


@lru_cache(200_000)
def reach(word: str, lexicon: str) -> tuple[tuple[int, str], ...]:
    """(cost, word) of the words of a lexicon that ``word`` is or may be a misspelling of, cheapest first.

    No word of a lexicon is more than two characters away from a word longer than its longest by three.
    """
    if word in (GIVEN if lexicon == "given" else _ORG):
        return ((0, word),)
    if not 4 <= len(word) <= _LONGEST[lexicon] + 2:
        return ()
    index = _index(lexicon)
    apart = word_cost if lexicon == "given" else lambda a, b: min(slips(a, b), slips(b, a))
    near = sorted((apart(word, w), w) for w in {w for x in _left_out(word, 2) for w in index.get(x, ())})
    return tuple(x for x in near if x[0] < APART)


def nearest(word: str, lexicon: str) -> tuple[str, ...]:
    """The words of a lexicon that ``word`` is, or is one usual slip away from (words of organisations, which others
    stand beside: one wrong letter or two slips at any length); only the nearest ones, sorted."""
    found = reach(word, lexicon)
    least = found[0][0] if found else APART
    return tuple(w for c, w in found if c == least <= (SLIP if lexicon == "given" else WRONG))


def formals(word: str) -> set[str]:
    """The given names that a word may stand for."""
    return {f for w in nearest(word, "given") for f in GIVEN[w]}


def canonical_given(word: str) -> str:
    """The given name that a known word stands for, or the word itself if it stands for several or is unknown."""
    meant = GIVEN.get(word, ())
    return next(iter(meant)) if len(meant) == 1 else word


def fold(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text).casefold() if not unicodedata.combining(c))


def reductions(word: str, most: int) -> set[str]:
    """The beginning of a word and what is left of it without up to ``most`` characters; short words lose fewer."""
    most = min(most, 0 if len(word) < 3 else 1 if len(word) < LONG_WORD else 2)
    return _left_out(word[:BEGINNING], most)


_MASK = (1 << 64) - 1


@lru_cache(100_000)
def _h(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def _form(group: int, tag: str, total: int) -> int:
    """A signed even hash; the lowest bit is left free."""
    x = ((_h(tag) ^ group) + total) & _MASK
    x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & _MASK
    x = (x ^ (x >> 29)) & ~1
    return x - (1 << 64) if x >> 63 else x


@dataclass(frozen=True)
class Reading:
    """How a name is read. ``shape``: person (given, last), initial (given is the letter), single, acronym (last),
    organisation (last is its own name, given the kinds), kinds (given). ``typed`` is a person's given name as typed."""

    shape: str
    given: str = ""
    last: str = ""
    cut: bool = False
    typed: str = ""


@dataclass
class Forms:
    """Hashed forms of a reading. Offers with their lowest bit set hold only if the surname is a variant of the word
    that was asked for. An ask is (level, form, word, exact); ``exact`` if nothing was left out of the word."""

    near: set[int] = field(default_factory=set)
    offers: set[int] = field(default_factory=set)
    asks: set[tuple[int, int, str, bool]] = field(default_factory=set)


def _split(text: str) -> list[str]:
    """Parts of a name; one written without a space between two capitalised parts is taken apart."""
    tokens = _TOKENS.findall(text)
    if len(tokens) == 1:
        parts = re.findall(r"[A-ZÀ-Þ][^A-ZÀ-Þ]+", tokens[0])
        if len(parts) == 2 and "".join(parts) == tokens[0] and min(map(len, parts)) >= 3:
            return parts
    return tokens


def _without_remarks(text: str) -> str:
    """Drop room suffixes, and remarks in brackets or behind a bar or a dash with blanks around it."""
    text = _ROOM.sub("", text)
    for m in re.findall(r"\[[^\]]*\]|\([^)]*\)", text):
        words = {fold(w) for w in _TOKENS.findall(m)}
        if m[0] == "[" or not words or words <= REMARKS or all(w.isdigit() for w in words):
            text = text.replace(m, " ")
    head, _, tail = re.sub(r"\s[|–—-]\s", "\x00", text, count=1).partition("\x00")
    return head if tail and _TOKENS.search(head) else text


def read(name: str | None) -> Reading | None:
    """How a name as typed is read. Null, blank, devices without owner, rooms and roles mean nobody: None."""
    if not name or not _TOKENS.search(name):
        return None
    text = unicodedata.normalize("NFC", name).replace("\xa0", " ").strip()
    owner = _OWNER.match(text)
    if owner and any(fold(w) in DEVICES for w in owner[2].split()):
        text = owner[1]
    text = _without_remarks(text)
    bare = [fold(t) for t in _TOKENS.findall(text)]
    if not bare or all(t in DEVICES or t in NOBODY or t.isdigit() for t in bare):
        return None
    cut = bool(_CUT.search(text))
    text = _CUT.sub("", text).rstrip(" .,;:-–—|")
    text = re.sub(r"(?i)\bco-op\b", "coop", text)
    bracket = re.match(r"^(.*?)\s*\(([^)]*)\)\s*$", text)
    if bracket and _TOKENS.search(bracket[1]):
        text = f"{bracket[1]}, {bracket[2]}"
    sides = [[fold(t) for t in _split(s)] for s in text.split(",") if _TOKENS.search(s)]
    if not sides:
        return None
    shout = re.fullmatch(r"[A-Z]{2,5}", text.strip())
    sides = [[t.translate(_MISREAD) if not t.isdigit() else t for t in s] for s in sides]
    tokens = [t for s in sides for t in s]
    if len(tokens) == 1 and not cut and tokens[0] not in GIVEN and any(len(w) >= 4 and distance(tokens[0], w, 2) < 2 for w in NOBODY | DEVICES):
        return None
    kinds = [bool(nearest(t, "org")) for t in tokens]
    if len(tokens) > 1 and (any(t in _ORG for t in tokens) or sum(kinds) >= 2) and not _is_person(tokens):
        return _organisation(sides, cut)
    if shout and tokens[0] not in GIVEN:
        return Reading("acronym", last=tokens[0])
    return _person(sides, cut)


def _is_person(tokens: list[str]) -> bool:
    """A given name and nothing that surely names an organisation."""
    rest = [t for t in tokens if t not in TITLES]
    return len(rest) == 2 and any(t in GIVEN for t in rest) and not any(t in _ORG for t in rest)


def _organisation(sides: list[list[str]], cut: bool) -> Reading:
    if len(sides) == 2 and not (sides[1] and set(sides[1]) <= LEGAL_FORMS):
        sides = sides[::-1]  # 'Kind, Place' and 'Kind (Place)' are 'Place Kind'
    tokens = [t for s in sides for t in s]
    kept = [t for i, t in enumerate(tokens) if not (t in LEGAL_FORMS and (i == 0 and t == "the" or i == len(tokens) - 1))] or tokens
    known = {t: nearest(t, "org") for t in kept}
    own, kinds = [t for t in kept if not known[t]], [_ORG[known[t][0]] for t in kept if known[t]]
    if not own:
        return Reading("kinds", " ".join(sorted(kinds)))
    # Blanks keep the own words and the order of the kinds for what is built from their beginnings.
    return Reading("organisation", " ".join(kinds), " ".join(own), cut)


def _person(sides: list[list[str]], cut: bool) -> Reading:
    swapped = len(sides) == 2  # 'Surname, Given' is 'Given Surname'
    tokens = [t for s in (sides[::-1] if swapped else sides) for t in s]
    while len(tokens) > 1 and tokens[0] in TITLES:
        tokens = tokens[1:]
    if swapped and len(tokens) > 1 and tokens[-1] in TITLES:
        tokens = tokens[:-1]
    if len(tokens) == 1:
        return Reading("single", last=tokens[0], cut=cut)
    if len(tokens) > 2:
        tokens = [tokens[0], *[t for t in tokens[1:-1] if len(t) > 1], tokens[-1]]
    if len(tokens) == 2 and 1 in map(len, tokens):
        first, last = tokens
        if len(first) == 1:
            return Reading("initial", first, last)
        return Reading("given initial" if formals(first) else "initial of", last, first)
    first, last = tokens[0], tokens[-1]
    a, b = nearest(first, "given"), nearest(last, "given")
    if not swapped and b and (not a or (last in GIVEN and first not in GIVEN)):
        first, last = last, first
    elif len(tokens) > 2:
        last = "".join(tokens[1:])
    return Reading("person", canonical_given(first), last, cut, first)


def _own(r: Reading) -> str:
    """An organisation's own words as one."""
    return r.last.replace(" ", "")


def _given_cost(a: str, b: str) -> int:
    if a == b:
        return 0
    if a in GIVEN and b in GIVEN:
        return APART
    if a in GIVEN or b in GIVEN:
        known, other = (a, b) if a in GIVEN else (b, a)
        # An unknown word beside a known name is a slip rather than a name of its own.
        return min((max(1, c - 1) for c, w in reach(other, "given") if canonical_given(w) == known), default=APART)
    return word_cost(a, b)


def cost(a: Reading, b: Reading) -> int:
    """What errors of typing it takes to make one reading of the other, APART if they are no variants."""
    if a.shape != b.shape:
        return APART
    if a.shape == "person":
        straight = _given_cost(a.given, b.given)
        c = straight + word_cost(a.last, b.last) if straight < APART else APART
        if a.given not in GIVEN and b.given not in GIVEN:  # nothing tells which part is the surname
            c = min(c, word_cost(a.given, b.last) + word_cost(a.last, b.given))
        return min(c, APART)
    if a.shape == "organisation":
        return word_cost(_own(a), _own(b)) if sorted(a.given.split()) == sorted(b.given.split()) else APART
    if a.given != b.given or (a.last in GIVEN and b.last in GIVEN and a.last != b.last):
        return APART
    return word_cost(a.last, b.last)


def forms(r: Reading, group: str, typed: list[str] | None = None) -> Forms:
    """All forms of a reading in a group; ``typed`` are the given names that were typed for it."""
    out, g = Forms(), _h(group)

    def one(tag: str, *words: str) -> int:
        return _form(g, tag, sum(map(_h, words)))

    def ask(level: str, tag: str, *words: str, of: str = "") -> None:
        """Ask for the last of the words and, if it is a word that may be misspelt, for what is left of it."""
        for x in reductions(of, 1) | {of[:BEGINNING]} if of else [""]:
            out.asks.add((LEVELS.index(level), one(tag, *words, x) | bool(of), of, not of or x == of[:BEGINNING]))

    def offer(tag: str, *words: str, of: str = "") -> None:
        for x in reductions(of, 1) if of else [""]:
            out.offers.add(one(tag, *words, x) | bool(of))

    def beginnings(tag: str, word: str, least: int, head: str = "") -> None:
        """Offer every beginning of a word, by a running hash."""
        running = xxhash.xxh64(head + word[:least])
        for n in range(least, len(word)):
            out.offers.add(_form(g, tag, running.intdigest()))
            running.update(word[n])

    def cut_off(tag: str, word: str) -> None:
        out.asks.add((LEVELS.index("cut"), _form(g, tag, _h(word)), "", True))

    if r.shape == "person":
        givens = [(r.given, 0)]
        if r.given not in GIVEN:
            givens = [(canonical_given(w), 1 if c in (SLIP, WRONG) else 2) for c, w in reach(r.given, "given")] + [(x, 0 if x == r.given else 1) for x in reductions(r.given, 1)]
            if len(r.given) >= LONG_WORD:
                givens += [(x, 2) for x in reductions(r.given, 2)]
        for given, used in givens:
            for x in reductions(r.last, 2 - used):
                out.near.add(one("near", given, x))
        if len(r.last) < LONG_WORD:  # a pair read as one takes two letters, more than a short word may lose
            out.near |= {one("near", r.given, x) for x in reread(r.last)}
        meanings = formals(r.given) or {r.given}
        known, sure = bool(formals(r.given)), len(meanings) == 1 or r.given not in GIVEN
        for formal in meanings:
            out.offers |= {one("given", formal, ""), one("letter", formal, r.last[0], "")}
            if known and not sure:
                ask("short", "short given", formal, of=r.last)
            elif known:
                offer("short given", formal, of=r.last)
            for letter in {formal[0], *(t[0] for t in typed or [r.given])}:
                offer("initial", letter, of=r.last)
            beginnings("cut " + formal, r.last, 2)
            if (r.cut and len(r.last) >= 2) or (len(r.last) >= 3 and known):
                cut_off("cut " + formal, r.last)
            out.offers |= {one("login", formal + r.last, ""), one("login", r.last + formal, "")}
        for t in typed or [r.given]:
            out.offers |= {one("login", t + r.last, ""), one("login", r.last + t, "")}
        offer("surname", of=r.last)
    elif r.shape == "organisation":
        own, kinds = r.last.split(), r.given.split()
        place, whole = "".join(own), "".join(own + kinds)
        tag = "near " + " ".join(sorted(kinds))
        out.near = {one(tag, x) for x in reductions(place, 2)} | ({one(tag, x) for x in reread(place)} if len(place) < LONG_WORD else set())
        out.offers.add(one("kind only", *sorted(kinds), ""))
        if len(kinds) + len(own) >= 3:
            out.offers.add(one("acronym", "".join(t[0] for t in own + kinds), ""))
        beginnings("cut", whole, len(place))
        if r.cut or len(kinds) < 2:
            cut_off("cut", whole)
        if r.cut and len(own) > 1:  # the cut went through a word of the kind: 'Place Youth Cou…'
            cut_off("cut", "".join(own[:-1]) + "".join(kinds) + own[-1])
    elif r.shape == "kinds":
        ask("ask", "kind only", *r.given.split())
    elif r.shape == "acronym":
        ask("ask", "acronym", r.last)
    elif r.shape == "initial":
        out.near = {one("near initial " + r.given, x) for x in reductions(r.last, 2)}
        ask("ask", "initial", r.given, of=r.last)
    elif r.shape == "given initial":  # 'Given S.'
        for formal in formals(r.last):
            ask("ask", "letter", formal, r.given)
            out.offers.add(one("given", formal, ""))
    elif r.shape == "initial of":  # 'Surname G.' or an unknown given name and 'S.'
        ask("ask", "initial", r.given, of=r.last)
        ask("ask", "letter", r.last, r.given)
    else:  # a given name, nickname, surname or login alone
        out.near = {one("near single", x) for x in reductions(r.last, 2)} if len(r.last) >= SOLID_WORD else {one("near single", r.last)}
        known = formals(r.last)
        for formal in known or {r.last}:
            ask("late", "given", formal)
        if not known and len(r.last) >= 4:
            ask("late", "surname", of=r.last)
            ask("ask", "login", r.last)
            ask("ask", "initial", r.last[-1], of=r.last[:-1])
            ask("ask", "initial", r.last[0], of=r.last[1:])
    return out


def reread(word: str) -> list[str]:
    """The word, and what it may have been before one pair of characters was read in place of one."""
    return [word] + [word[:i] + one + word[i + 2 :] for pair, one in _MISREAD_PAIRS.items() for i in range(len(word) - 1) if word.startswith(pair, i)]
