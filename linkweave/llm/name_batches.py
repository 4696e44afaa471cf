"""Cosines and the exact check of many pairs of names at once: what NameCosine.names, same_words and apart of name_links say, on arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longest word, or two words written together, that is compared on arrays; longer ones are compared one by one.
LONGEST = 32
#: Pairs of words that are compared at once.
AT_ONCE = 20_000
#: Letters of 3-grams, a word's marked ends included, in the order of their codes.
LETTERS = "^abcdefghijklmnopqrstuvwxyz$"
GRAMS = len(LETTERS) ** 3
#: Decimals of a cosine: sums of different lengths differ in the last bits.
DECIMALS = 9


def gram_code(gram: str) -> int:
    a, b, c = (LETTERS.index(x) for x in gram)
    return (a * 28 + b) * 28 + c


def gram_text(code: int) -> str:
    return LETTERS[code // 784] + LETTERS[code // 28 % 28] + LETTERS[code % 28]


def weight_table(weights: dict[str, float], rare: float) -> np.ndarray:
    """Weights by code of the 3-gram."""
    table = np.full(GRAMS, rare)
    for g, w in weights.items():
        table[gram_code(g)] = w
    return table


def _letter_codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word as 1 to 26, 0 after its end; and its length. Words beyond LONGEST have length 0 here."""
    short = np.array([w if len(w) <= LONGEST else "" for w in words], dtype=f"S{LONGEST}")
    raw = short.view(np.uint8).reshape(len(words), LONGEST)
    width = max(1, int((raw > 0).any(axis=0).sum()))
    codes = np.where(raw[:, :width] > 0, raw[:, :width] - 96, 0).astype(np.int16)
    return codes, (codes > 0).sum(axis=1)


def _marked_grams(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    n, width = codes.shape
    marked = np.zeros((n, width + 2), np.int16)
    marked[:, 1:-1] = codes
    marked[np.arange(n), size + 1] = 27
    return marked[:, :-2] * np.int16(784) + marked[:, 1:-1] * np.int16(28) + marked[:, 2:]


def _gram_codes(codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each word's 3-grams, and which of them are its own and no repetition."""
    grams, width = _marked_grams(codes, size), codes.shape[1]
    own = np.arange(width) < size[:, None]
    for k in range(1, width):
        own[:, k] &= ~(grams[:, :k] == grams[:, k : k + 1]).any(axis=1)
    return grams, own


def gram_counts(names: pa.Array) -> np.ndarray:
    """In how many of the names each 3-gram occurs, by its code."""
    lists = pc.split_pattern(names, " ")
    words = lists.flatten().to_pylist()
    of = np.repeat(np.arange(len(names)), np.diff(lists.offsets.to_numpy()))
    codes, size = _letter_codes(words)
    grams = _marked_grams(codes, size)
    at, k = np.nonzero(np.arange(codes.shape[1]) < size[:, None])
    seen = of[at] * GRAMS + grams[at, k]
    long = [(of[i], w) for i, w in enumerate(words) if len(w) > LONGEST]
    seen = np.concatenate([seen, *(np.array([n * GRAMS + gram_code(f"^{w}$"[i : i + 3]) for i in range(len(w))]) for n, w in long)])
    return np.bincount(np.unique(seen) % GRAMS, minlength=GRAMS)


class Words:
    """Words as arrays: letters as codes and as bits, and how many letters allowed gives each (of two words, that of the longer one counts)."""

    def __init__(self, words: Sequence[str]) -> None:
        self.codes, self.size = _letter_codes(words)
        self.bits = np.zeros(len(words), np.uint32)
        for p in range(self.codes.shape[1]):
            c = self.codes[:, p]
            self.bits |= np.where(c > 0, np.uint32(1) << np.maximum(c - 1, 0).astype(np.uint32), np.uint32(0))
        self.slips = np.select([self.size <= 3, self.size <= 6, self.size <= 11], [0, 2, 4], 5).astype(np.uint8)

    def letters_fit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Not far_words."""
        return np.bitwise_count(self.bits[x] ^ self.bits[y]) <= np.maximum(self.slips[x], self.slips[y])

    def tables(self, used: np.ndarray, weights: np.ndarray) -> None:
        """Prepares near and cosine of the words at used."""
        used = np.unique(used)
        self.row = np.zeros(len(self.size), np.int64)
        self.row[used] = np.arange(len(used))
        codes, size = self.codes[used], self.size[used]
        self.grams, own = _gram_codes(codes, size)
        w = weights[self.grams] * own
        norm = np.sqrt((w * w).sum(axis=1))
        self.weights = w / np.where(norm > 0, norm, 1)[:, None]
        self.places = np.zeros((len(used), 27), np.uint64)
        every = np.arange(len(used))
        for p in range(codes.shape[1]):
            self.places[every, codes[:, p]] |= np.uint64(1 << p)
        self.places[:, 0] = 0

    def near(self, x: np.ndarray, y: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        """near_words of each two words, where asked for; else only whether they are equal."""
        out = x == y
        todo = np.flatnonzero((~out if where is None else ~out & where) & self.letters_fit(x, y))
        for k in range(0, len(todo), AT_ONCE):
            part = todo[k : k + AT_ONCE]
            a, b = x[part], y[part]
            full = (np.uint64(1) << self.size[a].astype(np.uint64)) - np.uint64(1)
            row, places, codes = full.copy(), self.places[self.row[a]], self.codes[b]
            every = np.arange(len(part))
            for p in range(int(self.size[b].max())):
                hit = row & places[every, codes[:, p]]
                row = ((row + hit) | (row - hit)) & full
            common = self.size[a] - np.bitwise_count(row)
            out[part] = self.size[a] + self.size[b] - 2 * common <= np.maximum(self.slips[a], self.slips[b])
        return out

    def cosine(self, x: np.ndarray, y: np.ndarray, where: np.ndarray) -> np.ndarray:
        """NameCosine.words of each two words, where asked for; else 1."""
        out = np.ones(len(x))
        todo = np.flatnonzero((x != y) & where)
        for k in range(0, len(todo), AT_ONCE):
            part = todo[k : k + AT_ONCE]
            a, b = self.row[x[part]], self.row[y[part]]
            n, m = int(self.size[x[part]].max()), int(self.size[y[part]].max())
            g, v, h, w = self.grams[a, :n], self.weights[a, :n], self.grams[b, :m], self.weights[b, :m]
            total = np.zeros(len(part))
            for p in range(n):
                total += v[:, p] * ((h == g[:, p : p + 1]) * w).sum(axis=1)
            out[part] = total
        return out


class Names:
    """Distinct names as arrays. c1 and c2: in how many spellings the two words of a name occur; of a single word c1, of other names neither is looked at.

    one_by_one: what compare tells of two names, for those with three words or more, or longer than LONGEST.
    """

    def __init__(self, names: pa.Array, c1: np.ndarray, c2: np.ndarray, weights: np.ndarray, one_by_one: Callable[[int, int], tuple[bool, bool, float]]) -> None:
        self.one_by_one, self.weights = one_by_one, weights
        lists = pc.split_pattern(names, " ")
        start = lists.offsets.to_numpy()[:-1]
        self.k = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        of = coded.indices.to_numpy().astype(np.int64)
        self.texts = coded.dictionary.to_pylist()
        self.words = Words(self.texts)
        two = self.k == 2
        self.a = of[start]
        self.b = np.where(two, of[np.minimum(start + 1, len(of) - 1)], self.a)
        self.count = np.ones(len(self.texts), np.int64)
        self.count[self.a[self.k < 3]] = c1[self.k < 3]
        self.count[self.b[two]] = c2[two]
        self.bits = self.words.bits[self.a] | self.words.bits[self.b]
        size = np.array([len(w) for w in self.texts])
        self.slow = (self.k > 2) | (size[self.a] + np.where(two, size[self.b], 0) > LONGEST)

    def share_word(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether two names have a word in common; of names with three words or more only the first is looked at."""
        a, b, x, y = self.a[i], self.b[i], self.a[j], self.b[j]
        return (a == x) | (b == y) | (a == y) | (b == x)

    def may_be_same(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A cheap condition that same_words needs."""
        fit = np.bitwise_count(self.bits[i] ^ self.bits[j]) <= 10  # what allowed gives two words
        at = np.flatnonzero(fit & (self.k[i] == 2) & (self.k[j] == 2))
        a, b, x, y = self.a[i[at]], self.b[i[at]], self.a[j[at]], self.b[j[at]]
        two, letters = np.zeros(len(i), bool), self.words.letters_fit
        two[at] = (letters(a, x) & letters(b, y)) | (letters(a, y) & letters(b, x))
        together = ((self.k[i] == 1) | (self.k[j] == 1)) & (np.bitwise_count(self.bits[i] ^ self.bits[j]) <= 5)
        return two | together | self.slow[i] | self.slow[j]

    def _two_words(self, x: np.ndarray, y: np.ndarray, seen: int, rarer: int) -> np.ndarray:
        few, many = np.minimum(self.count[x], self.count[y]), np.maximum(self.count[x], self.count[y])
        return (few >= seen) & (few * rarer >= many)

    def compare(self, i: np.ndarray, j: np.ndarray, seen: int, rarer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """same_words and apart of each two names, and the cosine where they are the same, else 0."""
        same, apart, cosine = np.zeros(len(i), bool), np.zeros(len(i), bool), np.zeros(len(i))
        slow = self.slow[i] | self.slow[j]
        for at in np.flatnonzero(slow):
            same[at], apart[at], cosine[at] = self.one_by_one(int(i[at]), int(j[at]))
        words, own = self.words, lambda u, v: self._two_words(u, v, seen, rarer)
        equal = ~slow & (self.k[i] == self.k[j])
        at = np.flatnonzero(equal & (self.k[i] == 2))
        a, b, x, y = self.a[i[at]], self.b[i[at]], self.a[j[at]], self.b[j[at]]
        words.tables(np.concatenate([self.a[i[equal]], self.b[i[equal]], self.a[j[equal]], self.b[j[equal]]]), self.weights)
        # a word that both have is itself; else the first word takes the first one that it can be
        shared = [a == x, b == y, a == y, b == x]
        left = np.select(shared, [b, a, b, a]), np.select(shared, [y, x, x, y])
        known = shared[0] | shared[1] | shared[2] | shared[3]
        slip = lambda u, v, where: (u == v) | (words.near(u, v, where) & ~own(u, v))
        ax = slip(a, x, ~known)
        ay = slip(a, y, ~known & ~ax)
        ok = np.where(known, slip(*left, known), np.where(ax, slip(b, y, ~known & ax), ay & slip(b, x, ay)))
        same[at], apart[at] = ok, known & (left[0] != left[1]) & own(*left)
        whole = ok & (a != x) & (b != y)
        straight = words.cosine(a, x, ok) * words.cosine(b, y, ok)
        across = np.where(whole, words.cosine(a, y, whole) * words.cosine(b, x, whole), 0.0)
        cosine[at] = np.where(ok, np.sqrt(np.maximum(straight, across)), 0.0)
        at = np.flatnonzero(equal & (self.k[i] == 1))
        a, x = self.a[i[at]], self.a[j[at]]
        same[at], apart[at] = slip(a, x, a != x), (a != x) & own(a, x)
        cosine[at] = np.where(same[at], words.cosine(a, x, same[at]), 0.0)
        at = np.flatnonzero(~slow & (self.k[i] + self.k[j] == 3) & (np.bitwise_count(self.bits[i] ^ self.bits[j]) <= 5))
        if len(at):
            one, two = np.where(self.k[i[at]] == 1, i[at], j[at]), np.where(self.k[i[at]] == 1, j[at], i[at])
            single, a = np.unique(self.a[one], return_inverse=True)
            double, x = np.unique(two, return_inverse=True)
            parts = [(self.texts[p], self.texts[q]) for p, q in zip(self.a[double].tolist(), self.b[double].tolist())]
            together = Words([*(self.texts[k] for k in single), *(p + q for p, q in parts), *(q + p for p, q in parts)])
            x = len(single) + x
            y = x + len(double)
            together.tables(np.arange(len(together.size)), self.weights)
            alike = lambda u, v: (together.size[u] == together.size[v]) & (together.codes[u] == together.codes[v]).all(axis=1) | together.near(u, v)
            ok = same[at] = alike(a, x) | alike(a, y)
            cosine[at] = np.where(ok, np.maximum(together.cosine(a, x, ok), together.cosine(a, y, ok)), 0.0)
        return same, apart, np.round(cosine, DECIMALS)


def block_pairs(key: np.ndarray, most: int):
    """Pairs of places with the same key, in pieces of about so many; key is sorted."""
    n = len(key)
    if not n:
        return
    end = np.searchsorted(key, key, side="right")
    each = end - np.arange(n) - 1
    upto = np.cumsum(each)
    cut, done = 0, 0
    while cut < n:
        nxt = max(cut + 1, int(np.searchsorted(upto, done + most, side="right")))
        first = np.repeat(np.arange(cut, nxt), each[cut:nxt])
        if len(first):
            yield first, first + 1 + np.arange(len(first)) - np.repeat(upto[cut:nxt] - each[cut:nxt] - done, each[cut:nxt])
        cut, done = nxt, int(upto[nxt - 1])
