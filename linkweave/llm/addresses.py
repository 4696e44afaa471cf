"""Postal addresses as parts: number, street, postcode, place words, landmark."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

#: Words whose meaning a Python worker keeps; it lives as long as its executor, whose memory it shares with the JVM and the other workers.
KEPT_WORDS = 75_000

# Street types in full, and the ways they are shortened or mistyped.
STREET_TYPES = {
    "street": ("street", "str", "strt", "st", "streeet", "stret", "strete", "strasse"),
    "road": ("road", "raod", "rod", "rd", "roads"),
    "lane": ("lane", "lne", "la", "ln", "gali", "gully"),
    "avenue": ("avenue", "av", "aven", "avn", "ave", "avenida"),
    "boulevard": ("boulevard", "bvd", "blvd", "blvrd", "boul", "bd", "bld"),
    "terrace": ("terrace", "terr", "trce", "ter", "terace"),
    "place": ("place", "plce", "plc", "pl", "platz", "pltz"),
    "drive": ("drive", "driv", "drv", "dr"),
    "parkway": ("parkway", "pkw", "pkwy", "pky"),
    "court": ("court", "crt", "cort", "ct"),
    "cross": ("cross", "crs", "xcross", "xroad"),
    "marg": ("marg", "maarg", "mrg"),
    "allee": ("allee", "all"),
    "weg": ("weg", "wg"),
    "gasse": ("gasse", "gass", "g"),
    "rue": ("rue", "r", "rua"),
    "impasse": ("impasse", "imp"),
    "chemin": ("chemin", "chem", "ch"),
    "travessa": ("travessa", "trav", "tv"),
    "praca": ("praca", "pc", "pca"),
    "circle": ("circle", "cir"),
    "square": ("square", "sq"),
    "highway": ("highway", "hwy"),
    "close": ("close",),
    "crescent": ("crescent", "cres"),
    "way": ("way",),
    "trail": ("trail", "trl"),
}
#: Types that stand before the name.
LEADING = ("rue", "impasse", "chemin", "travessa", "praca")
#: Types that stand before the name in some countries and after it in others.
EITHER = ("avenue", "boulevard", "place")
#: Types glued to the name in German.
GLUED = ("strasse", "allee", "platz", "gasse", "weg", "str", "all", "pl", "wg", "g")
PLACE_PREPOSITIONS = r"near|nr|opposite|opp|behind|beside|next\s+to|in\s+front\s+of|adjacent\s+to|adj|across\s+from|close\s+to|landmark"
LANDMARK_ENDS = (
    "temple", "ground", "library", "mill", "square", "gate", "tank", "pump", "mall", "tower", "school", "depot",
    "station", "church", "mosque", "hospital", "bridge", "park", "stadium", "market", "museum", "theatre", "hall", "bank", "college",
)
UNIT_WORDS = r"unit|suite|ste|shop\s*no|shop|apartment|apt|floor|flat|room|office|level|fl"
NUMBER_WORDS = {"no", "house", "door", "plot", "number", "h", "hno", "numero", "n", "nr", "num"}
DIRECTIONS = {"north", "south", "east", "west", "n", "s", "e", "w"}
PARTICLES = {"de", "du", "des", "la", "le", "les", "da", "do", "das", "dos", "d", "l"}

_TYPE_OF = {w: t for t, words in STREET_TYPES.items() for w in words}
_LANDMARK = re.compile(
    rf"\b(?:{PLACE_PREPOSITIONS})\b[\s:.-]*((?:[^\W\d_]+[\s-]+){{0,3}}?(?:{'|'.join(LANDMARK_ENDS)})(?:\s+(?:{'|'.join(LANDMARK_ENDS)}))?\b|[^,\d]{{3,40}}?(?=,|\d|$))(?=[\s,]|$)"
)
_UNIT = re.compile(rf"\b(?:{UNIT_WORDS})\b\s*(?:no\b\s*)?[-#:.]?\s*\d+\s*-?[a-z]?\b|#\s*\d+[a-z]?\b|\b\d+\s*-?[a-z]?\s+block\b|\bblock\s+\d+[a-z]?\b")
_POSTCODE = re.compile(
    r"\b(?=[a-z]{0,2}\d)(?:([a-z]{1,2}\d[a-z\d]?)\s+(\d[a-z]{2})|([a-z]\d[a-z])\s*(\d[a-z]\d)|(\d{5})\s*-\s*(\d{3})|(\d{5,6})|(\d{3})\s(\d{3})(?=\W*$|\s*,))\b"
)
#: What every postcode with letters holds, and _POSTCODE for texts without it: a digit first, so that letters are skipped at once.
_LETTERED = re.compile(r"\d[a-z][a-z\d]")
_DIGIT_POSTCODE = re.compile(r"\d(?<!\w\d)(?:\d{4}\s*-\s*\d{3}|(\d{4,5})|(\d{2}\s\d{3}(?=\W*$|\s*,)))\b")
_NO_CODE = re.compile(r"[-\s]+")
_HOUSE = re.compile(r"(\d(?<![a-z\d]\d)\d{0,3})(?:\s*-\s*|\s*)([a-dfgh])?(?![a-z\d])")  # a digit first, so that other letters are skipped at once
_SHORT_UNIT = re.compile(r"(?:fl|ste)\b")
_ORDINAL_PLACE = re.compile(r"\b(phase|sector|ward|zone|block)\s+\d+\b")


_FOUR_DIGITS = re.compile(r"(?<!\d)(\d{4})(?!\d)")
_MARKS = frozenset(",|.-")
_DASH_DOT = frozenset("-.")
#: Shortened types that are words of their own where a text starts with them.
_ALSO_WORDS = frozenset(("r", "la", "st", "pl", "all", "ch", "g", "pc"))
_NO_PLACES = frozenset(NUMBER_WORDS | {"pin", "and", "the", "district", "pincode", "zip", "cep"})
_NO_PLACES_BY_STREET = _NO_PLACES | DIRECTIONS
_WORDS_AND_MARKS = re.compile(r"[a-z]+|[,|.-]")
_DIGIT_LETTER = re.compile(r"(?<=[a-z])0(?=[a-z]{2})|(?<=[a-z]{2})0(?=[a-z])|(?<=[a-z]{2})1(?=[a-z\s,.]|$)(?!\s\d[a-z]{2}\b)|(?<=[a-z]{3})0(?=[\s,.]|$)")


#: What every match of _DIGIT_LETTER holds; looking for it costs a fraction.
_LETTER_DIGIT = re.compile(r"[01](?<=[a-z][01])")


_MAIN_ROAD = re.compile(r"\b(?:main|mn)\s(?:road|raod|rod|rd)\b")


def _hinted(t: str) -> bool:
    """Whether a place preposition may be in t; a chain of searches for literals costs a fraction of the pattern."""
    return "near" in t or "nr" in t or "opp" in t or "behind" in t or "beside" in t or "next" in t or "front" in t or "adj" in t or "across" in t or "close" in t or "landmark" in t


class Address(NamedTuple):
    """Parts of an address; '' where there is none. places: the other words in order, joined by spaces."""

    number: str
    street: str
    kind: str
    postcode: str
    landmark: str
    places: str


EMPTY = Address("", "", "", "", "", "")


def fold(text: str) -> str:
    """Lower case, marks and ligatures resolved, digits that stand for letters inside words put back."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("º", " ").replace("ª", " "))
        text = "".join(c for c in text if not unicodedata.combining(c))
    return _DIGIT_LETTER.sub(lambda m: "o" if m[0] == "0" else "l", text) if _LETTER_DIGIT.search(text) else text


_LONG_TYPES = [w for w in _TYPE_OF if len(w) >= 5]
_BY_DELETION: dict[str, list[str]] = {}
for _w in _LONG_TYPES:
    for _d in {_w[:i] + _w[i + 1 :] for i in range(len(_w))} | {_w}:
        _BY_DELETION.setdefault(_d, []).append(_w)


def may_start(word: str, starts: set[str]) -> bool:
    """Whether word, whole or without one letter, starts with one of starts, of two letters each. It tells most words from the known ones before all their forms are made."""
    return word[:2] in starts or word[1:3] in starts or word[:1] + word[2:3] in starts


_STARTS = {d[:2] for d in _BY_DELETION}


@lru_cache(maxsize=KEPT_WORDS)
def street_type(word: str) -> str:
    """The street type that a word means: as written, or with one letter more, less, other or exchanged; '' for other words."""
    if word in _TYPE_OF:
        return _TYPE_OF[word]
    if len(word) < 5 or not may_start(word, _STARTS):
        return ""
    forms = {word[:i] + word[i + 1 :] for i in range(len(word))}
    forms.add(word)
    if _BY_DELETION.keys().isdisjoint(forms):
        return ""
    near = {w for d in forms for w in _BY_DELETION.get(d, ())}
    return _TYPE_OF[min(near, key=lambda w: (abs(len(w) - len(word)), w))] if near else ""


def parse_address(address: str | None, landmark: str | None = None, shortest: int = 2) -> Address:
    """The parts of one address, whatever the order they are written in. Null, blank and null-token texts have none. shortest: letters of a place word at least."""
    text = fold(address or "").strip()
    if not text or text in ("nan", "none", "null", "n/a", "na", "\\n"):
        return EMPTY._replace(landmark=_landmark_name(fold(landmark or "")))
    if "-cross" in text:
        text = text.replace("x-cross", "cross")
    if "park way" in text:
        text = text.replace("park way", "parkway")
    if "main r" in text or "mn r" in text:
        text = _MAIN_ROAD.sub("mainroad", text)
    found = _LANDMARK.search(text) if _hinted(text) else None
    mark = ""
    if found:
        mark = _landmark_name(found[1])
        text = f"{text[: found.start()]} , {text[found.end():]}"
    elif landmark:
        mark = _landmark_name(fold(landmark))
    if "#" in text or "unit" in text or "suite" in text or "shop" in text or "apart" in text or "apt" in text or "floor" in text or "flat" in text or "room" in text or "office" in text or "level" in text or "block" in text or (("fl" in text or "ste" in text) and _SHORT_UNIT.search(text)):
        text = _UNIT.sub(" , ", text)
    text = _ORDINAL_PLACE.sub(lambda m: m[1] + " ", text) if "phase" in text or "sector" in text or "ward" in text or "zone" in text else text
    text, code = _postcode(text)
    number, text, at = _number(text)
    if not code:
        late = _FOUR_DIGITS.search(text)
        if late:
            code, text = late[1], f"{text[: late.start()]} , {text[late.end():]}"
        elif number.isdigit() and len(number) == 4 and not text[at:].strip(" ,.-") and int(number) > 1250:
            number, code = "", number  # a lone four-digit number at the end is a postcode
    tokens = _WORDS_AND_MARKS.findall(text)
    street, kind, used = ("", "", ()) if mark and not number else _street(tokens)  # a landmark and a place without a house
    if len(used) > 1:  # directions belong to a street whose type stands beside its name
        places = [w for k, w in enumerate(tokens) if len(w) >= shortest and k not in used and w not in _NO_PLACES_BY_STREET]
    else:
        places = [w for k, w in enumerate(tokens) if len(w) >= shortest and k not in used and w not in _NO_PLACES]
    return Address(number, street, kind, code, mark, " ".join(places))


def _landmark_name(text: str) -> str:
    words = re.findall(r"[a-z]+", re.sub(rf"^\s*(?:{PLACE_PREPOSITIONS})\b", "", text))
    return " ".join(words[-3:])


def _postcode(text: str) -> tuple[str, str]:
    """text without its postcode, and that. Of several the surest kind counts: letters and digits, then grouped, then five or six digits, then two groups of three; of one kind the last."""
    best, kind = None, 9
    if _LETTERED.search(text):
        for m in _POSTCODE.finditer(text):
            k = (m.lastindex + 1) // 2 if m.lastindex != 7 else 4
            k = 5 if m.lastindex == 9 else k
            if k <= kind:
                best, kind = m, k
    else:
        for m in _DIGIT_POSTCODE.finditer(text):
            k = (m.lastindex or 0) + 3
            if k <= kind:
                best, kind = m, k
    if best is None:
        return text, ""
    code = best[0] if best[0].isalnum() else _NO_CODE.sub("", best[0])
    return f"{text[: best.start()]} , {text[best.end():]}", code


def _number(text: str) -> tuple[str, str, int]:
    m = _HOUSE.search(text)
    if not m:
        return "", text, 0
    return m[1].lstrip("0") + (m[2] or ""), f"{text[: m.start()]} | {text[m.end():]}", m.start() + 3


def _street(tokens: list[str]) -> tuple[str, str, tuple[int, ...]]:
    """Name and type of the street, and the places of the tokens that they are. A name that is a type itself (park lane, court road) is taken only where there is no other."""
    words = [i for i, t in enumerate(tokens) if t not in _MARKS]
    return _named_street(tokens, words, False) or _named_street(tokens, words, True) or ("", "", ())


def _named_street(tokens: list[str], words: list[int], any_name: bool) -> tuple[str, str, tuple[int, ...]] | None:
    for order, i in enumerate(words):
        kind = "main road" if tokens[i] == "mainroad" else street_type(tokens[i])
        if not kind:
            continue
        before = kind not in LEADING
        if before and order == 0 and tokens[i] in _ALSO_WORDS and tokens[i + 1 : i + 2] != ["."]:
            continue
        name = -1
        if before:
            j = i - 1
            while j >= 0 and (tokens[j] in _DASH_DOT or tokens[j] in NUMBER_WORDS):
                j -= 1
            if j >= 0 and tokens[j] not in _MARKS and (any_name or not street_type(tokens[j])):
                name = j
            if kind in EITHER and (name < 0 or tokens[i + 1 : i + 2] and _leads(tokens, i)):
                name = -1
                before = False
        if not before:
            j = i + 1
            while j < len(tokens) and (tokens[j] == "." or tokens[j] in PARTICLES):
                j += 1
            if j < len(tokens) and tokens[j] not in _MARKS:
                name = j
        if name >= 0 and len(tokens[name]) > 2 and tokens[name] not in DIRECTIONS:
            return tokens[name], kind, (i, name)
    for i in words:  # a type glued to the name
        for ending in GLUED if tokens[i].endswith(GLUED) else ():
            if tokens[i].endswith(ending) and len(tokens[i]) >= len(ending) + 4 and (len(ending) > 3 or tokens[i + 1 : i + 2] == ["."] or ending == "weg"):
                return tokens[i][: -len(ending)], _TYPE_OF[ending], (i,)
    return None


def _leads(tokens: list[str], i: int) -> bool:
    """Whether an ambiguous type stands before its name: it starts its part, or a house number stands before it."""
    j = i - 1
    while j >= 0 and tokens[j] == ".":
        j -= 1
    return j < 0 or tokens[j] in (",", "|", "-")
