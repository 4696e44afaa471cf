"""Abusive, hateful and sexually explicit content: disguises undone, terms found, severity by cumulative-link regression."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Labelled documents that the regression is fitted on, at most; of more, those with the smallest digest of their id.
MAX_LABELLED = 20_000
#: Expected severity (0 to 2) from which a document counts as a case.
CUTOFF = 1.0
GRADES = 3
#: Buckets that words and pairs of words are hashed to.
BUCKETS = 1 << 18
#: Labelled documents that a bucket must occur in to get a weight.
MIN_DOCUMENTS = 2
#: Precision of the prior of a bucket's weight, about 0.
TEXT_STRENGTH = 100.0
#: Words whose buckets a task keeps at once.
KEPT_WORDS = 500_000

# Words that insult or are obscene wherever they stand, in folded spelling, by kind.
WORDS = {
    "insult": (
        "idiot idiots moron morons imbecile imbeciles cretin cretins dumbass scumbag asshole assholes arsehole bastard bastards bitch bitches whore slut cunt twat wanker "
        "dickhead jackass motherfucker shithead halfwit faggot faggots cocksucker douchebag bimbo skank vollidiot arschloch drecksack trottel wichser schlampe hurensohn mistkerl schwachkopf missgeburt fotze hure huren nutte arsch wixer spasti dummkopf "
        "connard connards connasse salaud salope abruti enfoire encule batard cabron gilipollas imbecil pendejo maricon capullo zorra idiota malparido maricones subnormal imbeciles idiotas pute putes putas cretino"
    ).split(),
    "obscene": (
        "fuck fucks fucking fucked fucker bullshit shit shitty ficken fickt fickten gefickt scheisse scheiss verpiss foutre putain merde niquer joder joda jodete jodan mierda coño puta"
    ).replace("ñ", "n").split(),
    "hate": "vermin subhuman subhumans untermensch untermenschen ungeziefer abschaum vermine racaille escoria alimanas infrahumanos gesindel unmenschen sousrace nigger niggers kike kikes spic gook raghead towelhead".split(),
    "sexual": "porn porno horny pussy blowjob handjob cumshot dildo polla tetas follar follando follaron chupo baiserent baiser blowjobs dildos titties".split(),
}
# Phrases whose words are harmless on their own, by kind.
PHRASES = {
    "insult": (
        r"(?:spineless|clueless|brain-?dead|stinking|worthless|filthy|lying|miserable|pathetic|disgusting|stupid|damn|dirty)\s+(?:little\s+)?(?:pig|loser|clown|rat|dog|worm|liar|fool|jerk|swine|coward|creature|scum)s?\b",
        r"from a (?:pig|loser|fool|clown|jerk) like you", r"piece of (?:shit|crap|filth)", r"(?:that|the) (?:pig|loser|jerk) (?:stops|pay)", r"make the (?:pig|loser|jerk) pay",
        r"son of a bitch", r"hijo de puta", r"fils de pute", r"espece d['e ]", r"de mierda\b", r"cabron inutil", r"pauvre (?:connard|con|type|abruti|cretin)", r"erbarmlicher? \w+idiot", r"\btu es une? (?:ordure|merde|chien|pourriture|rat|porc)", r"\bdu bist (?:ein|eine) (?:stuck|dreck|ratte|schwein|versager)", r"\beres una? (?:basura|rata|cerdo|perra|mierda)",
    ),
    "obscene": (
        r"kiss my ass", r"\bgo to hell\b", r"\bfuck off\b", r"shut up,", r"halt(?:et)? (?:die|deine|dein) (?:fresse|klappe|maul)", r"kann mich mal", r"leck mich", r"va te faire", r"(?:ferme )?ta gueule",
        r"vete a la", r"que te (?:den|jodan)", r"callate,",
    ),
    "threat": (
        r"favou?r and die", r"find out where .{1,40}? lives?\b", r"should beat .{1,40}? until", r"\bchokes? on this", r"deserves? to die", r"kill (?:yourself|you|him|her|them all)\b", r"\bmake (?:the|that|him|her|them) .{0,20}?pay\b",
        r"(?:i|we)(?: will|'ll| am going to|'m going to) (?:kill|stab|rape|shoot|beat|strangle|gut|burn) (?:you|him|her|them)\b", r"(?:they|those \w+|these \w+|such people)(?: all)? should (?:all )?be (?:gassed|shot|hanged|exterminated|lynched|burned|put down)\b",
        r"hope (?:you|he|she|they|whoever) .{0,20}?(?:dies?|chokes?|rots?)\b", r"(?:bringe?|schlage?) (?:dich|ihn|sie) (?:um|tot)", r"voy a matar", r"ojala (?:te|se) muer", r"\bcreve\b.{0,20}(?:ordure|chien|salaud)", r"soll(?:en)? (?:krepieren|verrecken)",
    ),
    "hate": (
        r"(?:are|is) (?:all )?(?:just )?(?:vermin|filth|parasites|subhuman|animals|scum|cockroaches|savages|rats|inferior)\b", r"(?:go|get|send|sent|chased?|driven?) (?:\w+ )?back to (?:the|their|your) (?:swamp|jungle|gutter|cave|hole|zoo)", r"crawled out of", r"(?:stupid|inferior|lazy|criminal|dirty) by (?:blood|birth|nature|race)", r"deserve to live among", r"driven out\b",
        r"get rid of .{1,40}? once and for all", r"(?:away from|out of) our (?:labs?|departments?|country|schools?|streets|towns?)", r"they are (?:parasites|filth|vermin)", r"gehoren vertrieben", r"qu'on les chasse", r"hay que echar", r"(?:sind|son|sont) (?:alle )?(?:parasiten|parasitos|des parasites|ratten|ratas|des rats)",
    ),
    "sexual": (
        r"hard cock", r"naked (?:body|breasts?|thighs|ass)", r"off her (?:blouse|dress|clothes|panties)", r"moaned as", r"slid inside (?:her|him|me)", r"begging for more", r"came all over", r"all over (?:her|his) (?:thighs|face|breasts)",
        r"suck (?:me|him|her) off", r"hardcore (?:anal|sex|porn)", r"nude pics", r"hot nude", r"lick every inch", r"both of them came", r"sich nackt aus", r"bite nue", r"desnuda sobre", r"stroked his", r"spread (?:her|his) legs", r"on the (?:\w+ ){0,2}(?:bench|table|desk|floor|bed) until (?:he|she|they|both)\b",
    ),
}
KINDS = ("insult", "obscene", "threat", "hate", "sexual")

_HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁӏһкмтвнгАЕОРСУХІЈЅКМТВНαορνικτυεΑΒΕΖΗΙΚΜΝΟΡΤΥΧɡ’‘ʼ`",
    "aeopcyxijsdlhkmtbhraeopcyxijskmtbhaopviktueabezhikmnoptyxg''''",
)
_HOMOGLYPH = re.compile(f"[{''.join(map(chr, _HOMOGLYPHS))}]")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff\u034f]")
_MARKS = re.compile("[\u0300-\u036f]+")
# Markup within words; each pattern starts with its literal, which is looked for first.
_TEX = (
    ("\\-", re.compile(r"\\-"), ""),
    ("\\/", re.compile(r"\\/"), ""),
    ("\\allowbreak", re.compile(r"\\allowbreak\b\s*(?:\{\})?"), ""),
    ("\\discretionary", re.compile(r"\\discretionary\{\}\{\}\{\}"), ""),
    ("\\hspace{0", re.compile(r"\\hspace\*?\{0[a-z]{2}\}"), ""),
    ("\\kern0", re.compile(r"\\kern0[a-z]{2}\s?"), ""),
    ("{}", re.compile(r"\{\}(?=\w)"), ""),
    ("{\\", re.compile(r"\{\\(?:bf|it|em|rm|sc|tt|sl|bfseries|itshape)\s*(\w+)\}"), r"\1"),
    *((f"\\{c}{{", re.compile(rf"(?<=\w)\\{c}\{{(\w+)\}}|\\{c}\{{(\w{{1,4}})\}}(?=\w)"), r"\1\2") for c in ("textbf", "textit", "emph", "textrm", "texttt", "textsc", "mbox", "text")),
)
_TEX_ACCENT = re.compile(r"\\[\"'`^~=.]\s*\{?\\?([a-zA-Z])\}?")
_SPACED_START = re.compile(r"[^a-z][a-z][ .\-_*]{1,2}[a-z][ .\-_*]{1,2}[a-z][^a-z]")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .\-_*]{1,2}[^\W\d_](?![^\W_])){2,}")
_MARKED = re.compile(r"(?<![^\W_])[a-z]+(?:[.\-_·|~+^]+[a-z]+)+(?![^\W_])")
_LEET = re.compile(r"(?<![\w$@\\])(?=[a-z0-9@$!]*[a-z])(?=[a-z0-9@$!]*[0-9@$!])[a-z0-9@$!]{3,24}(?![\w$])")
_TRIPLES = tuple(3 * c for c in "abcdefghijklmnopqrstuvwxyz")
_RUNS = re.compile(r"\b(?=\w*?([a-z])\1\1)[a-z]{3,40}\b")
_MASKED = re.compile(r"(?<![^\W_])[a-z]+\*[a-z*]*[a-z](?![^\W_])")
_LEET_MAPS = [str.maketrans("01345789@$!", f"o{one}eastbgasi") for one in "il"]
_TOKEN = re.compile(r"[a-z]+")

_KIND_OF = {w: k for k, ws in WORDS.items() for w in ws}
#: Words that only phrases use; a disguised one is restored so that its phrase is found.
_PHRASE_WORDS = set(re.findall(r"[a-z]{3,}", " ".join(p for ps in PHRASES.values() for p in ps))) | set("pig loser ass damn cock naked breasts thighs nude anal filth parasites whore hell fresse nackt bite nue desnuda".split())
_KNOWN = set(_KIND_OF) | _PHRASE_WORDS
_SQUEEZED = {re.sub(r"(.)\1+", r"\1", w): w for w in sorted(_KNOWN, key=lambda w: (w in _KIND_OF, w))}
_BY_SHAPE: dict[tuple[int, str], list[str]] = {}
for _w in sorted(_KNOWN, key=lambda w: (w not in _KIND_OF, w)):
    _BY_SHAPE.setdefault((len(_w), _w[0]), []).append(_w)


def _needed(seq) -> list[tuple[str, ...]]:
    """Of a parsed pattern: texts that every match contains, each as the alternatives of which one must occur."""
    out, run = [], ""
    for op, arg in [*seq, (None, None)]:
        if str(op) == "LITERAL":
            run += chr(arg)
            continue
        if run:
            out.append((run,))
        run = ""
        if str(op) == "SUBPATTERN":
            out += _needed(arg[-1])
        elif str(op) == "MAX_REPEAT" and arg[0]:
            out += _needed(arg[-1])
        elif str(op) == "BRANCH":
            ways = [max(_needed(x), key=lambda ts: min(map(len, ts)), default=()) for x in arg[1]]
            if all(ways):
                out.append(tuple(sorted({t for ts in ways for t in ts})))
    return out


#: By kind, each phrase and what it needs, the longest first, which are the rarest; a phrase is looked for only where all that occurs. Derived from the phrases, so none can be missed.
_NEEDED = {k: [(p, sorted(_needed(re._parser.parse(p)), key=lambda ts: (-min(map(len, ts)), len(ts)))) for p in ps] for k, ps in PHRASES.items()}


def _has(text: str, needed: list[tuple[str, ...]]) -> bool:
    for ts in needed:
        for x in ts:
            if x in text:
                break
        else:
            return False
    return True


def _automaton() -> ahocorasick.Automaton:
    """For each text that a phrase needs first: the phrases that do, as (kind, phrase, what else it needs); one scan of a text finds all that may occur."""
    first: dict[str, list[tuple[str, str, list[tuple[str, ...]]]]] = {}
    for kind, phrases in _NEEDED.items():
        for p, needed in phrases:
            for x in needed[0]:
                first.setdefault(x, []).append((kind, p, needed[1:]))
    out = ahocorasick.Automaton()
    for x, ps in first.items():
        out.add_word(x, ps)
    out.make_automaton()
    return out


_FIRST = _automaton()


@lru_cache(maxsize=10_000)
def _joined(phrases: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?:{p})" for p in phrases))


def _restore(m: re.Match) -> str:
    """A word written with marks, digits, runs or gaps, as the known word that it disguises; else as it stands."""
    raw = m[0]
    letters = re.sub(r"[^a-z0-9@$!]", "", raw)
    for table in ({}, *_LEET_MAPS):
        plain = letters.translate(table) if table else letters
        if plain in _KNOWN:
            return plain
        short = _SQUEEZED.get(re.sub(r"(.)\1+", r"\1", plain))
        if short and len(plain) >= len(short) >= 3:
            return short
    return raw


def _join_spaced(m: re.Match) -> str:
    """Single letters with gaps, as the known words they spell, one after the other; else as they stand."""
    letters, out, i = re.sub(r"[^a-z]", "", m[0]), [], 0
    while i < len(letters):
        hit = next((letters[i:j] for j in range(len(letters), i + 1, -1) if letters[i:j] in _KNOWN), None)
        if hit is None:
            return m[0]
        out.append(hit)
        i += len(hit)
    return " ".join(out)


def _unmask(m: re.Match) -> str:
    mask = m[0]
    shape = re.compile(mask.replace("*", "[a-z]"))
    return next((w for w in _BY_SHAPE.get((len(mask), mask[0]), ()) if shape.fullmatch(w)), mask)


@lru_cache(maxsize=500_000)
def _clean_token(token: str) -> str:
    """A token between white space, with the words in it undone; most are seen again and again."""
    if "*" in token:
        token = _MASKED.sub(_unmask, token)
    return _LEET.sub(_restore, _MARKED.sub(_restore, token))


def undisguise(text: str) -> str:
    """Lower case without accents, with letters of other alphabets, markup inside words, gaps, marks, digits, runs and asterisks in known words undone; white space runs become one space, per cent signs too."""
    t = text
    if not t.isascii():
        t = unicodedata.normalize("NFKD", _INVISIBLE.sub("", t).replace("ß", "ss"))
        if _HOMOGLYPH.search(t):
            t = t.translate(_HOMOGLYPHS)
        t = _MARKS.sub("", t)
    for literal, pattern, to in _TEX:
        if literal in t:
            t = pattern.sub(to, t)
    t = (_TEX_ACCENT.sub(r"\1", t) if "\\" in t else t).lower()
    tokens = t.replace("%", " ").split()
    odd = {x for x in set(tokens) if not x.isalpha()}
    changed = {x: y for x in odd if (y := _clean_token(x)) != x}
    t = " ".join([changed.get(x, x) for x in tokens] if changed else tokens)
    if _SPACED_START.search(t):
        t = _SPACED.sub(_join_spaced, t)
    if any(x in t for x in _TRIPLES):
        t = _RUNS.sub(_restore, t)
    return t


def _terms(t: str, words: set[str]) -> list[str]:
    found, kinds = set(), set()
    for w in words & _KIND_OF.keys():
        found.add(f"w:{w}")
        kinds.add(_KIND_OF[w])
    likely: dict[str, set[str]] = {}
    for ps in {id(ps): ps for _, ps in _FIRST.iter(t)}.values():
        for kind, p, others in ps:
            if _has(t, others):
                likely.setdefault(kind, set()).add(p)
    for k, ps in likely.items():
        for m in _joined(tuple(sorted(ps))).finditer(t):
            found.add(f"p:{k}:{re.sub(r'[^a-z]+', ' ', m[0])[:24].strip()}")
            kinds.add(k)
    return sorted(found | {f"k:{k}" for k in kinds} | ({f"n:{len(kinds)}"} if kinds else set()))


def find_terms(text: str | None) -> list[str]:
    """Prior features of a text: 'w:word' and 'p:kind:phrase' of the fixed lists that were found, 'k:kind' and 'n:number of kinds'. Null and empty texts have none; the whole text counts, of any length."""
    if not text:
        return []
    t = undisguise(text)
    return _terms(t, set(_TOKEN.findall(t)))


class WordBuckets(dict):
    """A bucket of each word, the same in all processes."""

    def __missing__(self, word: str) -> int:
        out = self[word] = zlib.crc32(word.encode())
        return out


def text_features(text: str | None, buckets: WordBuckets) -> tuple[list[str], np.ndarray]:
    """Terms of the lists, and the buckets of all words and of all pairs of neighbouring words of the undisguised text, each once, rising."""
    if not text:
        return [], np.zeros(0, dtype=np.int64)
    t = undisguise(text)
    tokens = _TOKEN.findall(t)
    if len(buckets) > KEPT_WORDS:
        buckets.clear()
    ids = np.fromiter(map(buckets.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    both = np.concatenate([ids, ids[:-1] * 1_000_003 + ids[1:]]) % BUCKETS
    return _terms(t, set(tokens)), np.unique(both)


class Rows:
    """A sparse matrix of ones by rows, as flat feature numbers and where each row starts."""

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        self.width, self.lengths = width, np.array([len(r) for r in rows], dtype=np.int64)
        self.flat = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.lengths)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.flat], minlength=len(self.lengths))

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, weights=g[self.row], minlength=self.width)


def fit_ordinal(x: Rows, y: np.ndarray, weight: np.ndarray, prior: np.ndarray, strength: np.ndarray, rounds: int = 250) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model P(y <= k) = logistic(threshold_k - x w), one w shared by all thresholds.

    Maximum a posteriori by gradient steps of adaptive size: w has a normal prior about prior with precision strength, of each feature; thresholds stay ordered. weight: of each row.
    """
    sig = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
    params = np.concatenate([[1.0], np.full(GRADES - 2, 0.5), prior.astype(float)])  # first threshold, logarithms of the steps to the next, w
    m, v = np.zeros_like(params), np.zeros_like(params)
    thresholds = lambda a, gaps: np.concatenate([[a], a + np.cumsum(np.exp(gaps))])
    for t in range(1, rounds + 1):
        a, gaps, w = params[0], params[1 : GRADES - 1], params[GRADES - 1 :]
        th = thresholds(a, gaps)
        z = x.times(w)
        upper = np.where(y < GRADES - 1, sig(th[np.minimum(y, GRADES - 2)] - z), 1.0)
        lower = np.where(y > 0, sig(th[np.maximum(y - 1, 0)] - z), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        gz = weight * (du - dl) / p  # derivative of -log p by z
        gth = np.zeros(GRADES - 1)
        np.add.at(gth, np.minimum(y, GRADES - 2), np.where(y < GRADES - 1, -weight * du / p, 0.0))
        np.add.at(gth, np.maximum(y - 1, 0), np.where(y > 0, weight * dl / p, 0.0))
        g = np.concatenate([[gth.sum() + 0.1 * (a - 1.0)], np.cumsum(gth[::-1])[::-1][1:] * np.exp(gaps) + 0.1 * gaps, x.transposed_times(gz) + strength * (w - prior)])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.2 * (0.01 ** (t / rounds)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return params[GRADES - 1 :], thresholds(params[0], params[1 : GRADES - 1])


def _prior(feature: str) -> float:
    """What a feature is expected to weigh before any label is seen: a kind that occurs speaks for a case."""
    return 3.0 if feature.startswith("k:") else 0.5 if feature[0] in "wp" else 0.0


class Model(NamedTuple):
    """terms: weight of each term of the lists that a label has seen; text: weight of each bucket; thresholds between the grades."""

    terms: dict[str, float]
    text: np.ndarray
    thresholds: list[float]

    def severity(self, terms: list[str], buckets: np.ndarray) -> float:
        """Expected grade, from 0 to GRADES - 1."""
        z = sum(self.terms.get(f, _prior(f)) for f in terms) + float(self.text[buckets].sum())
        return float(sum(1.0 / (1.0 + np.exp(-np.clip(z - t, -40, 40))) for t in self.thresholds))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model fitted on the judgments of the labelled documents, at most MAX_LABELLED.

    A document's grade is 0 if no rater found it abusive, 2 if all did, else 1; more raters weigh more. Null judgments and ids are ignored. Of buckets those count that at least MIN_DOCUMENTS labelled
    documents have; the others keep weight 0. Without labels the priors stay as they are.
    """
    judged = labels.where("doc_id IS NOT NULL AND abusive IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("abusive").cast("double")).alias("share"), F.count(F.lit(1)).alias("raters"))
    kept = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)

    @pandas_udf("struct<terms: array<string>, buckets: array<int>>")
    def features(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        buckets = WordBuckets()
        for texts in it:
            both = [text_features(t, buckets) for t in texts]
            yield pd.DataFrame({"terms": [a for a, _ in both], "buckets": [b.astype(np.int32) for _, b in both]})

    # the labelled side has at most MAX_LABELLED rows; left to itself, Spark may send all documents
    labelled = documents.select("doc_id", "text").join(F.broadcast(kept), "doc_id")
    rows = labelled.select(features("text").alias("f"), "share", "raters").select("f.*", "share", "raters").toPandas()
    names = sorted({f for fs in rows["terms"] for f in fs} | {f"k:{k}" for k in KINDS})
    at = {f: i for i, f in enumerate(names)}
    held = np.bincount(np.concatenate([*rows["buckets"], np.zeros(0, dtype=np.int64)]).astype(np.int64), minlength=BUCKETS)
    place = np.full(BUCKETS, -1, dtype=np.int64)
    seen = np.flatnonzero(held >= MIN_DOCUMENTS)
    place[seen] = len(names) + np.arange(len(seen))
    x = Rows([np.concatenate([np.array([at[f] for f in fs], dtype=np.int64), (q := place[np.asarray(bs, dtype=np.int64)])[q >= 0]]) for fs, bs in zip(rows["terms"], rows["buckets"])], len(names) + len(seen))
    share = rows["share"].to_numpy(dtype=float)
    y = np.where(share <= 0, 0, np.where(share >= 1, 2, 1)).astype(int)
    prior = np.concatenate([[_prior(f) for f in names], np.zeros(len(seen))])
    strength = np.concatenate([np.ones(len(names)), np.full(len(seen), TEXT_STRENGTH)])
    w, th = fit_ordinal(x, y, np.sqrt(rows["raters"].to_numpy(dtype=float)), prior, strength)
    text = np.zeros(BUCKETS, dtype=np.float32)
    text[seen] = w[len(names) :]
    return Model(dict(zip(names, w[: len(names)].tolist())), text, th.tolist())


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, severity, is_case): expected severity from 0 to 2 of every document, and whether it reaches CUTOFF. Texts are scanned once; the model is as large as BUCKETS."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    @pandas_udf(T.DoubleType())
    def severity(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets = WordBuckets()
        for texts in it:
            yield pd.Series([model.value.severity(*text_features(t, buckets)) for t in texts], dtype="float64")

    scored = documents.select("doc_id", "source", severity.asNondeterministic()("text").alias("severity"))
    return scored.withColumn("is_case", F.col("severity") >= CUTOFF)


def source_rates(scores: DataFrame) -> DataFrame:
    """Per source (null as its own): documents, cases, their share, and mean severity."""
    return scores.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("is_case")).alias("cases"),
        F.avg(F.col("is_case").cast("double")).alias("rate"), F.avg("severity").alias("mean_severity"),
    )
