"""Variant spellings of names: which rows name the same organisation or person."""

from __future__ import annotations

import math
import sys
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from linkweave.functions.similarity import lcs_length
from linkweave.llm.components import components_of_groups
from linkweave.llm.name_batches import GRAMS, Names, block_pairs, gram_counts, gram_text, weight_table
from linkweave.llm.names import parse_name
from linkweave.llm.pairing import pairs_within
from linkweave.plans.lineage import Scratch

#: Least cosine of two linked spellings, and least average one of two clusters that become one.
THRESHOLD = 0.4
LINKAGE = 0.25
#: Links kept of each spelling, the most similar first.
TOP_N = 5
#: A word is a word in its own right beside another one that is at most RARER times as frequent, if it occurs in at least SEEN spellings: the same slip seldom happens so often.
RARER = 5
SEEN = 3


@pandas_udf(T.StringType())
def _parsed(name: pd.Series, alt: pd.Series) -> pd.Series:
    return pd.Series(["\n".join("\t".join(n) for n in parse_name(a, b)) for a, b in zip(name, alt)], dtype="object")


def parse_names(name: str, alt: str) -> Column:
    """The names of a row as lines of family, given, trades with tabs between; '' if none. They cross from Python as one text, which is far cheaper than nested values."""
    return _parsed(name, alt)


def grams(word: str) -> list[str]:
    """Character 3-grams of a word with its ends marked, in order, each once."""
    w = f"^{word}$"
    return list(dict.fromkeys(w[i : i + 3] for i in range(len(w) - 2)))


#: Words and pairs of words that a task keeps at once. A kept word is half a kilobyte, and the workers of an executor share its memory with the JVM.
KEPT = 50_000


class NameCosine:
    """Cosine of names by weighted character n-grams.

    A word is a vector of its n-grams, weighted by the root of their inverse document frequency; a name is the outer product of its words' vectors, so that one n-gram of each word
    makes a feature. The cosine of two such products is the product of the words' cosines, at best over which word meets which; its root of the number of words is used, so that one
    threshold serves names of any number of words. Names of different numbers of words are compared written together, as one word.
    """

    def __init__(self, weights: dict[str, float], rare: float) -> None:
        self.weights, self.rare = weights, rare
        self.vectors: dict[str, dict[str, float]] = {}
        self.known: dict[tuple[str, str], float] = {}

    def vector(self, word: str) -> dict[str, float]:
        v = self.vectors.get(word)
        if v is None:
            if len(self.vectors) > KEPT:
                self.vectors.clear()
            v = {sys.intern(g): self.weights.get(g, self.rare) for g in grams(word)}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = self.vectors[word] = {g: x / norm for g, x in v.items()}
        return v

    def words(self, a: str, b: str) -> float:
        if a == b:
            return 1.0
        c = self.known.get((a, b))
        if c is None:
            if len(self.known) > KEPT:
                self.known.clear()
            x, y = self.vector(a), self.vector(b)
            c = self.known[a, b] = sum([x[g] * y[g] for g in x.keys() & y.keys()])
        return c

    def names(self, u: str, v: str) -> float:
        a, b = u.split(" "), v.split(" ")
        if len(a) == len(b) == 2:
            if a[0] == b[0]:
                return math.sqrt(self.words(a[1], b[1]))
            if a[1] == b[1]:
                return math.sqrt(self.words(a[0], b[0]))
            return math.sqrt(max(self.words(a[0], b[0]) * self.words(a[1], b[1]), self.words(a[0], b[1]) * self.words(a[1], b[0])))
        orders = lambda x: permutations(x) if len(x) <= 4 else (tuple(x),)
        if len(a) == len(b):
            return max(math.prod(map(self.words, p, b)) for p in orders(a)) ** (1 / len(b))
        return max(self.words("".join(p), "".join(q)) for p in orders(a) for q in orders(b))


def allowed(a: str, b: str) -> int:
    """Letters that may be missing or extra in one of two words, both counted: the longer they are, the more."""
    n = max(len(a), len(b))
    return 0 if n <= 3 else 2 if n <= 6 else 4 if n <= 11 else 5


def far_words(a: str, b: str) -> bool:
    """A cheap condition that near_words excludes: too many letters occur in one word only."""
    return len(set(a) ^ set(b)) > allowed(a, b)


@lru_cache(maxsize=KEPT)
def near_words(a: str, b: str) -> bool:
    """Whether one word can be a misspelling of the other."""
    return not far_words(a, b) and len(a) + len(b) - 2 * lcs_length(a, b) <= allowed(a, b)


def two_words(x: str, y: str, count: dict[str, int]) -> bool:
    """Whether both are words in their own right: neither is rare beside the other, as a slip would be."""
    few, many = sorted((count.get(x, 1), count.get(y, 1)))
    return few >= SEEN and few * RARER >= many


def apart(u: str, v: str, count: dict[str, int]) -> bool:
    """Whether two names differ in one word, and both ways of it are words in their own right."""
    a, b = u.split(" "), v.split(" ")
    x, y = [w for w in a if w not in b], [w for w in b if w not in a]
    return len(x) == len(y) == 1 and two_words(x[0], y[0], count)


def same_words(a: str, b: str, count: dict[str, int]) -> bool:
    """The exact check: every word of the shorter name has its own near word in the other, at least two words or all of them; or both read alike without spaces.

    count: spellings that each word occurs in. Two words in their own right are never taken for misspellings of each other.
    """
    if a == b:
        return True
    x, y = sorted((a.split(), b.split()), key=len)
    left = list(y)
    for w in sorted(x, key=lambda w: w not in y):
        hit = w if w in left else next((v for v in left if near_words(w, v) and not two_words(w, v, count)), None)
        if hit is None:
            break
        left.remove(hit)
    else:
        if not left or len(x) >= 2:
            return True
    if len(x) == len(y) or len(y) > 3:
        return False
    joined = "".join(x)
    orders = ("".join(y), "".join(reversed(y)))
    return any(near_words(joined, o) for o in orders)


def gram_weights(keys: DataFrame) -> tuple[dict[str, float], float]:
    """Root of the inverse document frequency of each 3-gram over all spellings. Letters are a to z and the marks of a word's ends, so there are fewer than 28 ** 3 of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(GRAMS, np.int64), 0
        for batch in batches:
            df += gram_counts(batch.column(0))
            n += batch.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n))], ["g", "df"])

    df = {r["g"]: r["df"] for r in keys.select("family").mapInArrow(count, "g int, df long").groupBy("g").agg(F.sum("df").alias("df")).collect()}
    n = df.pop(-1, 0)
    return {gram_text(g): math.sqrt(math.log(1.0 + n / d)) for g, d in df.items()}, math.sqrt(math.log(1.0 + n))


def with_word_counts(keys: DataFrame) -> DataFrame:
    """keys (family, support) plus id, words and counts (in how many spellings each of the words occurs). The result must be written before its ids are used."""
    at = keys.select("family", "support", F.posexplode(F.split("family", " ")).alias("pos", "word"), F.size(F.split("family", " ")).alias("k"))
    n = at.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = lambda rows: rows.join(n, "word").groupBy("family", "support")
    nth = lambda k: F.max(F.when(F.col("pos") == k, F.col("n")))
    short = counted(at.where("k < 3")).agg(nth(0).alias("c1"), nth(1).alias("c2")).select("family", "support", F.array_compact(F.array("c1", "c2")).alias("counts"))  # without arrays in the aggregation
    long = counted(at.where("k > 2")).agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("w")).select("family", "support", F.col("w.n").alias("counts"))  # the words of one name
    return short.unionByName(long).select(F.monotonically_increasing_id().alias("id"), "family", "support", F.split("family", " ").alias("words"), "counts")


def _join_keys() -> Column:
    """Hashes of whole words, and of pairs of n-grams of two different words, each a word's first three letters, its middle four or its last four; of a single word, n-grams about its first and its last letters, as of two words written together.

    Features of a name are pairs of n-grams, and names alike share many of them; these few suffice to meet one (see the README for what an exact cosine join finds besides). Single n-grams are held by so many names that
    joining on them would grow with the square of the data; a pair is nearly as rare as the name itself. Keys of whole words are odd, the others even.
    """
    ends = lambda w: [f"left({w}, 3)", f"substring({w}, greatest((length({w}) - 3) div 2, 0) + 1, 4)", f"right({w}, 4)"]
    pair = "shiftleft(xxhash64(least({0}, {1}), greatest({0}, {1})), 1)"
    both = ", ".join(["xxhash64(words[0]) | 1L", "xxhash64(words[1]) | 1L", *(pair.format(a, b) for a in ends("words[0]") for b in ends("words[1]"))])  # of two words without lambdas, which are interpreted
    three, pair = "array_distinct(array({}))", pair.format("a", "b")
    two = f"flatten(transform(words, (w, i) -> flatten(transform(slice(words, i + 2, size(words)), y -> flatten(transform({three.format(', '.join(ends('w')))}, a -> transform({three.format(', '.join(ends('y')))}, b -> {pair})))))))"
    one = f"flatten(transform(words, w -> flatten(transform(array(left(w, 3), substring(w, 2, 4), substring(w, 3, 4), substring(w, 4, 4)), a -> transform(array(right(w, 4), substring(w, -5, 4), substring(w, -6, 4), substring(w, -7, 4)), b -> {pair})))))"
    whole = "transform(words, w -> xxhash64(w) | 1L)"
    return F.expr(f"array_distinct(CASE WHEN size(words) = 2 THEN array({both}) WHEN size(words) = 1 THEN concat({whole}, {one}) ELSE concat({whole}, {two}) END)")


#: Rows of whole blocks that are compared at once, and pairs of them. A larger block is compared whole.
ROWS, PAIRS = 100_000, 500_000


def _counts(name: str, c1: int, c2: int) -> dict[str, int]:
    words = name.split(" ")
    return {words[0]: c1, words[1]: c2} if len(words) == 2 else dict.fromkeys(words, c1)


def _block_scores(table: pa.Table, weights: np.ndarray, measure: NameCosine) -> Iterator[pa.RecordBatch]:
    """(u_id, v_id, cosine) of the pairs of rows (g, id, family, c1, c2) with the same g, ordered by g, that pass threshold and exact check. A pair may come again.

    Names that share a word meet under that word, an odd g, so they are not compared again under an even one.
    """
    table = table.combine_chunks()
    key = table["g"].to_numpy()
    again = key[1:] == key[:-1]
    kept = np.flatnonzero(np.append(again, False) | np.append([False], again))  # most keys have one spelling
    if not len(kept):
        return
    key, every = key[kept], table["id"].to_numpy()[kept]
    ids, first, name = np.unique(every, return_index=True, return_inverse=True)
    rows = table.select(["family", "c1", "c2"]).take(pa.array(kept[first]))
    families, c1, c2 = rows["family"].combine_chunks(), rows["c1"].to_numpy(), rows["c2"].to_numpy()

    def one_by_one(i: int, j: int) -> tuple[bool, bool, float]:
        a, b = families[i].as_py(), families[j].as_py()
        same = same_words(a, b, _counts(a, int(c1[i]), int(c2[i])) | _counts(b, int(c1[j]), int(c2[j])))
        return same, False, measure.names(a, b) if same else 0.0

    names = Names(families, c1, c2, weights, one_by_one)
    odd = (key & 1).astype(bool)
    for i, j in block_pairs(key, PAIRS):
        here = odd[i]
        i, j = name[i], name[j]
        here |= ~names.share_word(i, j)
        i, j = i[here], j[here]
        fit = names.may_be_same(i, j) & (i != j)
        i, j = i[fit], j[fit]
        pairs = np.unique(np.minimum(i, j) * len(ids) + np.maximum(i, j))
        u, v = pairs // len(ids), pairs % len(ids)
        same, _, cosine = names.compare(u, v, SEEN, RARER)
        good = same & (cosine >= THRESHOLD)
        yield pa.RecordBatch.from_arrays([pa.array(ids[u[good]]), pa.array(ids[v[good]]), pa.array(cosine[good])], ["u_id", "v_id", "cosine"])


def similar_spellings(keys: DataFrame, weights: tuple[dict[str, float], float]) -> DataFrame:
    """(u_id, v_id, cosine): each two spellings that share a join key, with a cosine of at least THRESHOLD, that pass the exact check, once. Weights are inverse document frequencies over all spellings.

    keys: of with_word_counts, written. All spellings of a key meet all others; they are compared as arrays before anything but their keys is shuffled.
    """
    table = keys.sparkSession.sparkContext.broadcast(weights)  # fewer than 28 ** 3 numbers
    two = F.size("words") == 2
    c1, c2 = F.when(two, F.get("counts", F.lit(0))).otherwise(F.array_min("counts")), F.when(two, F.get("counts", F.lit(1))).otherwise(F.array_max("counts"))
    rows = keys.select(F.explode(_join_keys()).alias("g"), "id", "family", c1.cast("int").alias("c1"), c2.cast("int").alias("c2"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_code, measure = weight_table(*table.value), NameCosine(*table.value)
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(0)
            if n >= ROWS and g[-1].as_py() != last:  # the last block of what is held ends in this batch
                cut = int(np.searchsorted(g.to_numpy(), last, side="right"))
                yield from _block_scores(pa.Table.from_batches([*held, batch.slice(0, cut)]), by_code, measure)
                held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n, last = n + batch.num_rows, g[-1].as_py()
        if held:
            yield from _block_scores(pa.Table.from_batches(held), by_code, measure)
        near_words.cache_clear()  # the worker lives on

    scored = rows.repartition("g").sortWithinPartitions("g").mapInArrow(score, "u_id long, v_id long, cosine double")
    return scored.groupBy("u_id", "v_id").agg(F.max("cosine").alias("cosine"))


def top_links(links: DataFrame, n: int = TOP_N) -> DataFrame:
    """(a, b): of each spelling the n most similar ones; of equal cosines the smaller id comes first."""
    both = links.select(F.explode(F.array(F.struct(F.col("u_id").alias("a"), F.col("v_id").alias("b")), F.struct(F.col("v_id").alias("a"), F.col("u_id").alias("b")))).alias("x"), "cosine")
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return both.select("x.*", "cosine").withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= n).select("a", "b")


def average_linkage(n: int, sims: Sequence[Sequence[float]], cut: float) -> list[int]:
    """Cluster number of each of n names: the two clusters with the highest average similarity are merged as long as that is at least cut. Sums between clusters are kept, so a merge costs one row.

    sims: symmetric; only what is left of the diagonal is read. Each cluster remembers its best partner among those before it, so that a merge seldom looks at more than the rows it changes.
    """
    total = [array("d", sims[i][:i]) for i in range(n)]
    members = {i: [i] for i in range(n)}
    best: dict[int, tuple[float, int]] = {}

    def average(i: int, j: int) -> float:
        return total[i][j] / (len(members[i]) * len(members[j]))

    def look(i: int) -> None:
        top, at = -1.0, -1
        for j in members:  # in ascending order: merged ones keep the place of the smaller number
            if j >= i:
                break
            s = average(i, j)
            if s > top:
                top, at = s, j
        best[i] = (top, at)

    for i in range(1, n):
        look(i)
    while best:
        top, i = max((s, -i) for i, (s, _) in best.items())
        i = -i
        if top < cut:
            break
        j = best.pop(i)[1]
        for k in members:
            if k not in (i, j):
                total[max(j, k)][min(j, k)] += total[max(i, k)][min(i, k)]
        members[j] += members.pop(i)
        if j in best:
            look(j)
        for k in members:
            if k > j:
                s, at = best[k]
                now = average(k, j)
                if at in (i, j):
                    look(k)
                elif now > s or (now == s and j < at):
                    best[k] = (now, j)
    out = [0] * n
    for k, c in enumerate(members.values()):
        for i in c:
            out[i] = k
    return out


def cluster_names(groups: pa.ListArray, counts: pa.ListArray, weights: np.ndarray, measure: NameCosine) -> Iterator[tuple[list[str], list[int]]]:
    """The names of each group, and their cluster numbers by average linkage of cosines. Two names that the exact check tells apart have similarity 0; those that are apart never share a cluster, however alike their slips are.

    counts: of the words of each name. Two names are one cluster: they have a link, which passed threshold and check.
    """
    families, ns = groups.flatten(), counts.flatten()
    size = np.diff(groups.offsets.to_numpy())
    of = np.repeat(np.arange(len(size)), size)
    offsets = ns.offsets.to_numpy()
    each, many = ns.flatten().to_numpy(), np.diff(offsets)
    start = offsets[:-1] - offsets[0]

    def one_by_one(i: int, j: int) -> tuple[bool, bool, float]:
        a, b = families[i].as_py(), families[j].as_py()
        count = {w: int(c) for k, f in ((i, a), (j, b)) for w, c in zip(f.split(" "), each[start[k] : start[k] + many[k]])}
        same = same_words(a, b, count)
        return same, apart(a, b, count), measure.names(a, b) if same else 0.0

    names = Names(families, each[start], each[start + np.minimum(many, 2) - 1], weights, one_by_one)
    at = np.arange(len(of)) - (np.cumsum(size) - size)[of]  # place in the group
    space = np.where(size > 2, size * (size - 1) // 2, 0)
    base = np.cumsum(space) - space
    sims = np.zeros(int(space.sum()))
    asked = np.flatnonzero(size[of] > 2)
    for x, y in block_pairs(of[asked], PAIRS):
        x, y = asked[x], asked[y]
        same, far, cosine = names.compare(y, x, SEEN, RARER)
        never = -(size[of[x]].astype(float) ** 2)  # outweighs all similarities between two clusters
        sims[base[of[x]] + at[y] * (at[y] - 1) // 2 + at[x]] = np.where(same, cosine, np.where(far, never, 0.0))
    texts, begin = families.to_pylist(), np.cumsum(size) - size
    for k, n in enumerate(size.tolist()):
        own = sims[base[k] : base[k] + space[k]]
        clusters = [0] * n if n < 3 else average_linkage(n, [own[i * (i - 1) // 2 : i * (i + 1) // 2].tolist() for i in range(n)], LINKAGE)
        yield texts[begin[k] : begin[k] + n], clusters


def spelling_groups(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(family, root): spellings of one name share the most frequent of them as root; a spelling without links is not listed.

    keys: (family, support). Spellings linked directly or through others are candidates for one name, and average-linkage clustering of all their cosines divides them. A component is
    clustered whole, whatever its size: cut into parts it would cluster differently.
    """
    weights = gram_weights(keys)
    counted = scratch.write(with_word_counts(keys))
    links = top_links(similar_spellings(counted, weights))
    groups = components_of_groups(links.groupBy("a").agg(F.collect_list("b").alias("b")).select(F.array_append("b", F.col("a")).alias("ids")), "ids")  # at most TOP_N links each
    table = keys.sparkSession.sparkContext.broadcast(weights)
    members = counted.join(groups, "id").select("group_id", F.struct((-F.col("support")).alias("order"), "family", "counts").alias("m"))
    grouped = members.groupBy("group_id").agg(F.sort_array(F.collect_list("m")).alias("m")).select(F.col("m.family").alias("families"), F.col("m.counts").alias("counts"))

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_code, measure = weight_table(*table.value), NameCosine(*table.value)
        for batch in batches:
            family, root = [], []
            for names, clusters in cluster_names(batch.column(0), batch.column(1), by_code, measure):
                first: dict[int, str] = {}
                family += names
                root += [first.setdefault(k, f) for f, k in zip(names, clusters)]
            yield pa.RecordBatch.from_arrays([pa.array(family, pa.string()), pa.array(root, pa.string())], ["family", "root"])
        near_words.cache_clear()

    labelled = scratch.write(grouped.mapInArrow(roots, "family string, root string"))
    scratch.drop(counted)
    return labelled


def named_rows(records: DataFrame, pool: DataFrame) -> DataFrame:
    """(entity_id, family, given, trades, several, first): the distinct names of each row of both tables, whether it has more than one, and one of them marked; a repeated delivery adds what it names."""
    texts = records.select("entity_id", F.col("business_name_norm").alias("name"), F.lit(None).cast("string").alias("alt")).unionByName(
        pool.select("entity_id", F.col("name_core").alias("name"), F.col("name_alt").alias("alt"))
    )
    parsed = texts.where("entity_id IS NOT NULL").select("entity_id", parse_names("name", "alt").alias("lines")).where("lines <> ''")
    delivered = parsed.groupBy("entity_id").agg(F.collect_set("lines").alias("lines"))  # the deliveries of one row that differ
    every = delivered.select("entity_id", F.array_distinct(F.split(F.array_join("lines", "\n"), "\n")).alias("every"))
    rows = every.select("entity_id", (F.size("every") > 1).alias("several"), F.posexplode("every").alias("pos", "line")).withColumn("n", F.split("line", "\t"))
    return rows.select("entity_id", *(F.get("n", F.lit(k)).alias(c) for k, c in enumerate(("family", "given", "trades"))), "several", (F.col("pos") == 0).alias("first"))


def known_roots(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(family, root, known) of the families that have another root or given names: the most frequent spelling of the family words, and the given names with their trades that occur in full with it.

    rows: of named_rows, written.
    """
    keys = scratch.write(rows.groupBy("family").agg(F.count(F.lit(1)).alias("support")))
    roots = spelling_groups(keys, scratch)
    scratch.drop(keys)
    full = rows.where("given <> '' AND given NOT LIKE '?%'").select("family", "given", F.col("trades").alias("t")).distinct()
    of_root = full.join(roots, "family", "left").groupBy(F.coalesce("root", "family").alias("_root"))
    known = of_root.agg(F.collect_set(F.struct("given", "t")).alias("known"))  # given names and trades come from fixed lists
    out = scratch.write(roots.join(known, F.col("root") == F.col("_root"), "full").select(F.coalesce("family", "_root").alias("family"), F.coalesce("root", "_root").alias("root"), "known"))
    scratch.drop(roots)
    return out


def resolve_names(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (of named_rows) with root and org instead of trades. roots: of known_roots.

    root: the most frequent spelling of the family words. org: root, and where several given names occur with it, the given name too: members of a
    family are different persons. An initial stands for the only given name of the family that begins with it; a name without a given name belongs to the
    only one, or to the only one in its trade; else it stays apart.
    """
    joined = rows.join(roots, "family", "left").withColumns(
        {
            "root": F.coalesce("root", "family"),
            "givens": F.array_distinct(F.col("known.given")),
            "in_trade": F.array_distinct(F.transform(F.filter("known", lambda x: x["t"] == F.col("trades")), lambda x: x["given"])),
        }
    )
    fits = F.filter("givens", lambda g: F.concat(F.lit("?"), F.substring(g, 1, 1)) == F.col("given"))
    n = F.coalesce(F.size("givens"), F.lit(0))
    who = (
        F.when(n <= 0, F.lit(""))
        .when(F.col("given") == "", F.when(n == 1, F.col("givens")[0]).when(F.size("in_trade") == 1, F.col("in_trade")[0]).otherwise(F.lit("?")))
        .when(F.col("given").startswith("?"), F.when(F.size(fits) == 1, F.get(fits, F.lit(0))).otherwise(F.col("given")))
        .otherwise(F.col("given"))
    )
    return joined.select("entity_id", F.concat_ws("|", "root", who).alias("org"), "root", "family", "given", "several", "first")


def organisations(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(entity_id, org, root, family, given, first) of all names, where names borne by one row have become one org; and the written table that it reads. rows: of named_rows, written; dropped here."""
    roots = known_roots(rows, scratch)
    named = scratch.write(resolve_names(rows, roots))
    scratch.drop(rows)
    scratch.drop(roots)
    several = named.where("several").groupBy("entity_id").agg(F.collect_set("org").alias("ids")).where("size(ids) > 1")  # the names of one row
    joint = components_of_groups(several, "ids").select(F.col("id").alias("org"), "group_id")
    return named.join(joint, "org", "left").select("entity_id", F.coalesce("group_id", "org").alias("org"), "root", "family", "given", "first").hint("merge"), named


def same_name_pairs(records: DataFrame, pool: DataFrame) -> DataFrame:
    """(entity_id_a, entity_id_b) of the rows of both tables that name the same organisation or person, smaller id first.

    Rows without a name (null, blank, null token) are in no pair; repeated deliveries of an id count as one row; empty tables give none.
    """
    scratch = Scratch(records.sparkSession, "names")
    rows = scratch.write(named_rows(records, pool))
    members = organisations(rows, scratch)[0].where("first").select("org", "entity_id")  # all names of a row have one org
    return pairs_within(members, "org", "entity_id", "entity_id_a", "entity_id_b")
