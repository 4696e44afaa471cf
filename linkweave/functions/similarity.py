"""Edit similarities on 0 to 100; Arrow functions, since no built-in gives insert/delete distance."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


@lru_cache(maxsize=50_000)
def _places(a: str) -> dict[str, int]:
    """For each letter the bits of the places where a has it. A lookup is held against many candidates, so this is kept."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    return where


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one big integer as the row of the table."""
    if a == b:
        return len(a)
    get = _places(a).get
    full = row = (1 << len(a)) - 1
    for ch in b:
        hit = row & get(ch, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@lru_cache(maxsize=50_000)
def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


def ratio(a: str, b: str) -> float:
    """100 for two empty strings."""
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Best of the ratios between shared words and shared plus own words; 0 if either side has no words."""
    left, right = _words(a), _words(b)
    if not left or not right:
        return 0.0
    both, only_a, only_b = left & right, left - right, right - left
    if both and not (only_a and only_b):
        return 100.0
    rest_a, rest_b = " ".join(sorted(only_a)), " ".join(sorted(only_b))
    shared = len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    whole_a, whole_b = shared + gap + len(rest_a), shared + gap + len(rest_b)
    distance = len(rest_a) + len(rest_b) - 2 * lcs_length(rest_a, rest_b)
    best = 100.0 - 100.0 * distance / (whole_a + whole_b)
    if not shared:
        return best
    return max(best, *(100.0 - 100.0 * (gap + len(rest)) / (shared + whole) for rest, whole in ((rest_a, whole_a), (rest_b, whole_b))))


#: Letters are counted in so many lanes of so many bits.
_LANES = _WIDTH = 32


@lru_cache(maxsize=50_000)
def _letter_bits(text: str) -> tuple[int, int, int]:
    """Letter counts of text, each in a lane as that many ones; the length of its distinct words joined; and 1 if no lane overflows. The ones that two texts share bound their longest common subsequence."""
    counts = [0] * _LANES
    for ch in text:
        counts[ord(ch) % _LANES] += 1
    bits = 0
    for lane, n in enumerate(counts):
        bits |= ((1 << n) - 1) << (lane * _WIDTH)
    return bits, len(" ".join(_words(text))), int(max(counts) <= _WIDTH)


def score_bound(a: str, b: str) -> float:
    """What neither ratio nor token_set_ratio of a and b can exceed: 100 if they share a word, else by the letters that they share."""
    if not _words(a).isdisjoint(_words(b)):
        return 100.0
    (x, n, fits_a), (y, m, fits_b) = _letter_bits(a), _letter_bits(b)
    return 200.0 * (x & y).bit_count() / (n + m) if n + m and fits_a and fits_b else 100.0


def best_score(name: str, core: str, c_name: str, c_core: str, c_alt: str, least: float = 0.0) -> float:
    """Name against name, core against core where both exist, name against the trade name where there is one. Where it is certain to be below least, 0 is given instead."""
    if least > 0 and score_bound(name, c_name) < least and (not c_alt or score_bound(name, c_alt) < least) and (not core or not c_core or score_bound(core, c_core) < least):
        return 0.0
    best = token_set_ratio(name, c_name)
    if c_alt and name and best < 100.0:
        best = max(best, token_set_ratio(name, c_alt))
    same = name == core and c_name == c_core
    if core and c_core and not same and best < 100.0:
        best = max(best, token_set_ratio(core, c_core))
    for x, y in ((name, c_name), (core, c_core)) if core and c_core and not same else ((name, c_name),):
        total = len(x) + len(y)
        if not total:
            best = 100.0
        elif 200.0 * min(len(x), len(y)) / total > best:  # the most that the lengths allow
            best = max(best, ratio(x, y))
    return best


#: Longest text and most distinct words of one for arrays, longest text whose places fit a machine word, and most different characters of a batch for those.
_LONG, _MANY, _PLACES, _CHARACTERS = 255, 16, 64, 256
#: Lanes that characters are counted in; characters that share one only loosen a bound.
_COUNTED = 64


class Texts:
    """Distinct texts as arrays, so that many pairs of them, given by their numbers, are compared at once with the results of ratio and token_set_ratio."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.words = [sorted(_words(t)) for t in texts]
        self.n_words = np.array([len(ws) for ws in self.words], dtype=np.int64)
        #: Texts that the arrays hold; the others are compared one pair at a time.
        self.plain = (self.length <= _LONG) & (self.n_words <= _MANY)
        held = [t if ok else "" for t, ok in zip(texts, self.plain)]
        bare = ["".join(ws) if ok else "" for ws, ok in zip(self.words, self.plain)]
        self.row, self.at, codes = self._characters(held)
        self.alphabet, self.codes = np.unique(codes, return_inverse=True)
        self.counts = self._counts(self.row, codes)
        row, _, codes = self._characters(bare)
        self.word_counts = self._counts(row, codes)
        self.joined = np.array([len(b) for b in bare], dtype=np.int64) + np.maximum(self.n_words - 1, 0)
        width = int(self.n_words[self.plain].max(initial=1)) or 1
        number: dict[str, int] = {}
        self.word_ids = np.full((len(texts), width), -1, dtype=np.int32)
        self.word_lengths = np.zeros((len(texts), width), dtype=np.int32)
        for i in np.flatnonzero(self.plain).tolist():
            for k, w in enumerate(self.words[i]):
                self.word_ids[i, k] = number.setdefault(w, len(number))
                self.word_lengths[i, k] = len(w)
        self._masks: np.ndarray | None = None

    @staticmethod
    def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all characters the text's number, the place in it and the code."""
        n = np.array([len(t) for t in texts], dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, at, np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)

    def _counts(self, row: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return np.bincount(row * _COUNTED + codes % _COUNTED, minlength=len(self.texts) * _COUNTED).reshape(-1, _COUNTED).astype(np.uint8)

    def lcs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """lcs_length of texts i and j."""
        out = np.zeros(len(i), dtype=np.int64)
        short = self.plain[i] & self.plain[j] & (self.length[i] <= _PLACES) & (self.length[j] <= _PLACES) & (len(self.alphabet) <= _CHARACTERS)
        for k in np.flatnonzero(~short).tolist():
            out[k] = lcs_length(self.texts[i[k]], self.texts[j[k]])
        if not short.any():
            return out
        if self._masks is None:
            fits = self.length[self.row] <= _PLACES
            row, at, codes = self.row[fits], self.at[fits], self.codes[fits]
            self._masks = np.zeros((len(self.texts), len(self.alphabet) + 1), dtype=np.uint64)
            np.bitwise_or.at(self._masks, (row, codes), np.uint64(1) << at.astype(np.uint64))
            self._padded = np.full((len(self.texts), _PLACES), len(self.alphabet), dtype=np.int64)  # the last character is in no text
            self._padded[row, at] = codes
        a, b = i[short], j[short]
        order = np.argsort(-self.length[b], kind="stable")  # so that those with letters left come first
        a, b = a[order], b[order]
        left = np.searchsorted(-self.length[b], -np.arange(1, _PLACES + 1), side="right")
        state = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for k in range(int(self.length[b].max(initial=0))):
            n = left[k]
            row = state[:n]
            hit = row & self._masks[a[:n], self._padded[b[:n], k]]
            state[:n] = (row + hit) | (row - hit)
        used = np.where(self.length[a] >= 64, np.iinfo(np.uint64).max, (np.uint64(1) << np.minimum(self.length[a], 63).astype(np.uint64)) - np.uint64(1))
        found = np.empty(len(a), dtype=np.int64)
        found[order] = np.bitwise_count(~state & used)
        out[short] = found
        return out

    def ratios(self, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
        """ratio of texts i and j where it can be least or more, else 0."""
        total = self.length[i] + self.length[j]
        out = np.where(total == 0, 100.0, 0.0)
        most = np.minimum(self.counts[i], self.counts[j]).sum(axis=1, dtype=np.int64)
        ask = np.flatnonzero((total > 0) & ((200.0 * most / np.maximum(total, 1) >= least) | ~self.plain[i] | ~self.plain[j]))
        out[ask] = 200.0 * self.lcs(i[ask], j[ask]) / total[ask]
        return out

    def token_set_ratios(self, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
        """token_set_ratio of texts i and j where it can be least or more, else less than least."""
        out = np.zeros(len(i))
        plain = self.plain[i] & self.plain[j]
        for k in np.flatnonzero(~plain).tolist():
            out[k] = token_set_ratio(self.texts[i[k]], self.texts[j[k]])
        at = np.flatnonzero(plain & (self.n_words[i] > 0) & (self.n_words[j] > 0))
        i, j = i[at], j[at]
        same = (self.word_ids[i][:, :, None] == self.word_ids[j][:, None, :]) & (self.word_ids[i] >= 0)[:, :, None]
        in_i, in_j = same.any(axis=2), same.any(axis=1)
        n = in_i.sum(axis=1)
        letters = (self.word_lengths[i] * in_i).sum(axis=1)
        shared = letters + np.maximum(n - 1, 0)
        gap = (n > 0).astype(np.int64)
        only_a, only_b = self.n_words[i] - n, self.n_words[j] - n
        rest_a, rest_b = (self.joined[x] - shared - ((n > 0) & (only > 0)) for x, only in ((i, only_a), (j, only_b)))
        whole_a, whole_b = shared + gap + rest_a, shared + gap + rest_b
        best = np.zeros(len(i))
        some = np.flatnonzero(n > 0)
        for rest, whole in ((rest_a, whole_a), (rest_b, whole_b)):
            best[some] = np.maximum(best[some], 100.0 - 100.0 * (gap + rest)[some] / (shared + whole)[some])
        best[(n > 0) & ((only_a == 0) | (only_b == 0))] = 100.0
        most = np.minimum(self.word_counts[i], self.word_counts[j]).sum(axis=1, dtype=np.int64) - letters + np.maximum(np.minimum(only_a, only_b) - 1, 0)
        ask = np.flatnonzero((best < 100.0) & (100.0 - 100.0 * (rest_a + rest_b - 2 * most) / np.maximum(whole_a + whole_b, 1) >= least))
        if len(ask):
            powers = 1 << np.arange(self.word_ids.shape[1], dtype=np.int64)
            keys = np.concatenate([x[ask] << _MANY | hit[ask] @ powers for x, hit in ((i, in_i), (j, in_j))])
            keys, number = np.unique(keys, return_inverse=True)  # few: a text shares the same words with many others
            rests: dict[str, int] = {}
            place = np.array([rests.setdefault(" ".join([w for k, w in enumerate(self.words[x >> _MANY]) if not x >> k & 1]), len(rests)) for x in keys.tolist()], dtype=np.int64)
            a, b = place[number[: len(ask)]], place[number[len(ask) :]]
            pairs, back = np.unique(a * len(rests) + b, return_inverse=True)
            n = Texts(list(rests)).lcs(pairs // len(rests), pairs % len(rests))[back]
            best[ask] = np.maximum(best[ask], 100.0 - 100.0 * ((rest_a + rest_b)[ask] - 2 * n) / (whole_a + whole_b)[ask])
        out[at] = best
        return out


def best_scores(texts: Texts, name: np.ndarray, core: np.ndarray, c_name: np.ndarray, c_core: np.ndarray, c_alt: np.ndarray, least: float) -> np.ndarray:
    """best_score of many pairs, given by the numbers of their texts; where it is below least, something below least."""
    given = lambda x: texts.length[x] > 0
    out = np.maximum(texts.token_set_ratios(name, c_name, least), texts.ratios(name, c_name, least))
    at = np.flatnonzero(given(core) & given(c_core) & ((name != core) | (c_name != c_core)) & (out < 100.0))
    out[at] = np.maximum(out[at], np.maximum(texts.token_set_ratios(core[at], c_core[at], least), texts.ratios(core[at], c_core[at], least)))
    at = np.flatnonzero(given(name) & given(c_alt) & (out < 100.0))
    out[at] = np.maximum(out[at], texts.token_set_ratios(name[at], c_alt[at], least))
    return out


@pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@pandas_udf(T.DoubleType())
def token_set_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def pair_ratio(a: Column, b: Column) -> Column:
    """0 to 1, and 0 where either side is null or ''; equal strings never leave the JVM."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(ratio_udf(a, b) / 100.0)
