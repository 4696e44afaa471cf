"""Names of organisations and persons as parts: family words, given name, trade words, trade names."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from linkweave.llm.addresses import KEPT_WORDS, fold, may_start

# Legal forms.
LEGAL = set(
    "ltd limited lmtd sa sas sarl co company comp llc llp lp inc incorp incorporated corp corpn corporation group grp gmbh ag ohg kg ug "
    "pvt private ltda enterprises enterprise plc bv nv spa srl pty eirl sl".split()
)
# Words before a name that are often left out.
FILLERS = set("the and of new royal shree shri sri global golden city star national modern united great dr mr mrs ms prof m s sir messrs".split())
# Kinds of shops in trade names.
SHOP_WORDS = set("mart house direct express cafe emporium studio bazaar corner online store shop outlet".split())
# Trade words and how they are shortened, by word.
TRADES = {
    "supplies": "supl suppl supply", "services": "svcs svc serv service srvs", "trading": "trdg trade traders", "steel": "stl", "solar": "", "dental": "dentl",
    "clinic": "cl clin", "works": "wks work", "advisors": "advsrs advisers advisor", "hardware": "hdwr", "food": "foods", "brokers": "brkrs broker",
    "architects": "archts architect", "legal": "law lawyers", "travel": "trvl", "marine": "mar", "chambers": "chmbrs", "press": "printers print",
    "garden": "gdn gardens", "school": "sch schools", "auto": "automotive", "repair": "rpr repairs", "consulting": "consltg consultants", "brothers": "bros",
    "industries": "inds indus industry industrial", "associates": "assoc assocs associate", "financial": "fin fincl finance", "insurance": "ins insur",
    "agency": "agcy agy agencies", "products": "prods product", "engineering": "engg engrg engineers", "centre": "center ctr", "international": "intl int",
    "building": "bldg bldrs builders", "hospital": "hosp", "manufacturing": "mfg mfrg manufacturers", "printing": "prtg", "pharmaceuticals": "pharm pharma pharmaceutical",
    "textiles": "txtls textile", "packaging": "pkg packg", "energy": "enrgy", "realty": "rlty estate real", "chemicals": "chem chemcls chemical",
    "technologies": "tech technol technology", "laboratories": "lab labs laboratory", "logistics": "logist lgstcs logistic", "jewellers": "jewelers jwlrs jewelry",
    "furniture": "furn furnitr", "electronics": "elec electrncs electronic", "bakery": "bkry bakers", "plumbing": "plmbg plumbers",
}
# Short and other forms of given names, by name.
GIVEN = {
    "richard": "rich rick dick ricky richie", "robert": "rob bob bobby robbie bert", "william": "will bill billy wm willy liam", "margaret": "maggie meg peggy marge greta",
    "elizabeth": "liz beth betty eliza lizzie elisabeth", "katherine": "kathy kate katie kit catherine kathryn", "theodore": "ted theo teddy theodor",
    "frederick": "fred freddy fritz frederic", "alexander": "alex sandy sascha sasha", "abigail": "abby gail", "jacqueline": "jackie jacqui jacquie",
    "johannes": "hans johann jo", "guillaume": "gui guy", "francisco": "fran paco pancho cisco", "rajendra": "raj raju rajen", "lakshmi": "laxmi lucky lakshmy",
    "michael": "mike mick", "joseph": "joe", "thomas": "tom tommy", "james": "jim jimmy", "charles": "charlie chuck", "edward": "ed eddie", "anthony": "tony",
    "christopher": "chris", "daniel": "dan danny", "matthew": "matt", "jennifer": "jenny", "patricia": "pat patty", "susan": "sue susie",
}
ALIAS = re.compile(r"\b(?:d\s?b\s?a|a\s?k\s?a|t\s?/?\s?a|also known as|trading as|doing business as|known as|fka|formerly)\b")
_LETTERS = re.compile(r"[a-z]+")
NULL_NAMES = {"", "nan", "none", "null", "n/a", "na", "nil", "-", "\\n", "unknown"}

_TRADE_OF = {w: t for t, ws in TRADES.items() for w in (t, *ws.split())} | {w: w for w in SHOP_WORDS}
_GIVEN_OF = {w: g for g, ws in GIVEN.items() for w in (g, *ws.split())}
_KNOWN = {w: "" for w in LEGAL | FILLERS} | _TRADE_OF | _GIVEN_OF


class Name(NamedTuple):
    """family: the sorted distinguishing words, joined by spaces; given: a given name in full, or '?x' for an initial x, or ''; trades: sorted trade words."""

    family: str
    given: str
    trades: str


def _deletions(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


_LONG = [w for w in _KNOWN if len(w) >= 5]
_BY_DELETION: dict[str, list[str]] = {}
for _w in _LONG:
    for _d in _deletions(_w) | {_w}:
        _BY_DELETION.setdefault(_d, []).append(_w)
_STARTS = {d[:2] for d in _BY_DELETION}
#: The first two letters of all forms of trade words, and the last two backwards.
_TRADE_FORMS = {d for w in _TRADE_OF for d in (_deletions(w) | {w} if len(w) >= 5 else {w})}
_TRADE_STARTS, _TRADE_ENDS = {d[:2] for d in _TRADE_FORMS}, {d[:-3:-1] for d in _TRADE_FORMS}


@lru_cache(maxsize=KEPT_WORDS)
def known_word(word: str) -> str:
    """The known word meant by word: itself, or one that differs by one letter more, less or other, or by two letters exchanged; else ''."""
    if word in _KNOWN:
        return word
    if len(word) < 5 or not may_start(word, _STARTS):
        return ""
    forms = _deletions(word)
    forms.add(word)
    if _BY_DELETION.keys().isdisjoint(forms):
        return ""
    near = {w for d in forms for w in _BY_DELETION.get(d, ())}
    return min(near, key=lambda w: (abs(len(w) - len(word)), w), default="")


@lru_cache(maxsize=KEPT_WORDS)
def two_trades(word: str) -> tuple[str, ...]:
    """The two trade words that word is when they are written together; () for other words."""
    if not may_start(word, _TRADE_STARTS) or not may_start(word[::-1], _TRADE_ENDS):
        return ()
    known = known_word.__wrapped__  # parts of words are not worth keeping
    for i in range(4, len(word) - 3):
        a, b = word[:i], word[i:]
        if (i < 5 and a not in _TRADE_OF) or (len(b) < 5 and b not in _TRADE_OF):  # so short a part is a known word or none
            continue
        if (a := known(a)) in _TRADE_OF and (b := known(b)) in _TRADE_OF:
            return _TRADE_OF[a], _TRADE_OF[b]
    return ()


@lru_cache(maxsize=KEPT_WORDS)
def word_role(word: str) -> tuple[str, str]:
    """What a word of a name is, and what it means: a 'family' word, a 'given' name, an 'initial', 'trades' joined by spaces; '' for legal forms and fillers."""
    known = known_word(word)
    if not known and len(word) >= 8 and (both := two_trades(word)):
        return "trades", " ".join(both)
    if known and (known in LEGAL or known in FILLERS) and len(word) > 1:
        return "", ""
    if known in _TRADE_OF:
        return "trades", _TRADE_OF[known]
    if known in _GIVEN_OF:
        return "given", _GIVEN_OF[known]
    return ("initial" if len(word) == 1 else "family"), word


def parse_part(text: str) -> Name:
    family, given, initial, trades = [], "", "", []
    if "'" in text:
        text = text.replace("'", "").replace("int'l", "intl")
    for word in _LETTERS.findall(text):
        role, meaning = word_role(word)
        if role == "family":
            family.append(meaning)
        elif role == "trades":
            trades += meaning.split(" ")
        elif role == "given":
            given = given or meaning
        elif role:
            initial = initial or meaning
    if len(family) > 2:  # a short leftover beside two names is a misspelt trade word
        family = [w for w in family if len(w) > 4] if sum(len(w) > 4 for w in family) > 1 else family
    if not family:  # nothing else tells it apart
        family, trades = (sorted(set(trades)) or ([given] if given else [])), []
    return Name(" ".join(sorted(set(family))), given or (f"?{initial}" if initial else ""), " ".join(sorted(set(trades))))


def parse_name(name: str | None, alt: str | None = None) -> list[Name]:
    """The names that one row bears: what stands before a trade-name phrase, and after it or in alt. Blank and null-token names denote nobody."""
    out: list[Name] = []
    for text in (name, alt):
        folded = fold(text or "").strip()
        if folded in NULL_NAMES:
            continue
        for part in ALIAS.split(folded):
            if part.strip(" ,.-") and part.strip(" ,.-") not in NULL_NAMES:
                n = parse_part(part)
                if n.family and n not in out:
                    out.append(n)
    return out
