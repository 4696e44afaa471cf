import random
from itertools import combinations

import numpy as np
import pyarrow as pa

from linkweave.llm import name_links
from linkweave.llm.name_batches import DECIMALS, LONGEST, Names, block_pairs, gram_counts, weight_table


def slip(rng, w):
    i = rng.randrange(1, len(w) + 1)
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeiou") + w[i:], w[: i - 1] + w[i : i + 1] + w[i - 1] + w[i + 1 :]])


def spellings(rng):
    word = lambda: "".join(rng.choice(["tri", "ko", "va", "lu", "me", "zo", "pra", "ni"]) for _ in range(rng.randrange(1, 5))) + rng.choice(["st", "k", ""])
    out = {"ab", "ab cd", "x" * 90, f"{'x' * 91} koko", "vava vava"}
    for a, b, c in ((word(), word(), word()) for _ in range(25)):
        out |= {f"{a} {b}", f"{b} {a}", f"{a}{b}", f"{slip(rng, a)} {b}", f"{a} {slip(rng, slip(rng, b))}", slip(rng, a), a, f"{a} {b} {c}", f"{slip(rng, b)} {c} {a}", f"{a} {c}"}
    return sorted(out)


def test_arrays_say_what_one_pair_at_a_time_does():
    rng = random.Random(5)
    names = spellings(rng)
    count = {w: rng.choice([1, 1, 2, 3, 4, 20]) for n in names for w in n.split(" ")}
    weights = {g: rng.random() + 0.5 for n in names for w in n.split(" ") for g in name_links.grams(w) if rng.random() < 0.9}
    measure, asked = name_links.NameCosine(weights, 2.0), []

    def plain(i, j):
        asked.append((i, j))
        same = name_links.same_words(names[i], names[j], count)
        return same, name_links.apart(names[i], names[j], count), measure.names(names[i], names[j]) if same else 0.0

    c1, c2 = np.array([count[n.split(" ")[0]] for n in names]), np.array([count[n.split(" ")[-1]] for n in names])
    batch = Names(pa.array(names), c1, c2, weight_table(weights, 2.0), plain)
    i, j = (np.array(x) for x in zip(*combinations(range(len(names)), 2)))
    same, apart, cosine = batch.compare(i, j, name_links.SEEN, name_links.RARER)
    assert all(max(len(names[x].split(" ")), len(names[y].split(" "))) > 2 or max(len(names[x]), len(names[y])) > LONGEST for x, y in asked)  # all others on arrays
    want = [plain(x, y) for x, y in zip(i.tolist(), j.tolist())]
    assert same.tolist() == [s for s, _, _ in want] and apart.tolist() == [a for _, a, _ in want]
    assert np.abs(cosine - np.array([c for _, _, c in want])).max() <= 10.0**-DECIMALS
    assert batch.may_be_same(i, j)[same].all() and 100 < same.sum() < len(i) / 2


def test_gram_counts():
    names = spellings(random.Random(6))
    found = {name_links.gram_text(g): n for g, n in enumerate(gram_counts(pa.array(names)).tolist()) if n}
    want = {}
    for n in names:
        for g in {g for w in n.split(" ") for g in name_links.grams(w)}:
            want[g] = want.get(g, 0) + 1
    assert found == want


def test_block_pairs_in_pieces():
    key = np.array([1, 1, 2, 3, 3, 3, 3, 3, 3, 9, 9])
    want = {(i, j) for i, j in combinations(range(len(key)), 2) if key[i] == key[j]}
    for most in (1, 3, 100):
        pieces = [list(zip(i.tolist(), j.tolist())) for i, j in block_pairs(key, most)]
        assert sorted(p for piece in pieces for p in piece) == sorted(want)
    assert not list(block_pairs(key[:0], 5))


def test_names_that_share_a_word_meet_under_it_only():
    names = ["bralotis nemugard", "bralotis nemugart", "bralutis nemugarb"]  # the first two share a word, which is key 1; all have key 2
    rows = [(1, 0), (1, 1), (2, 0), (2, 1), (2, 2)]
    table = pa.table({"g": pa.array([g for g, _ in rows]), "id": pa.array([i for _, i in rows]), "family": pa.array([names[i] for _, i in rows]), "c1": pa.array([1] * 5, pa.int32()), "c2": pa.array([1] * 5, pa.int32())})
    batches = list(name_links._block_scores(table, weight_table({}, 1.0), name_links.NameCosine({}, 1.0)))
    assert sorted(tuple(r[c] for c in ("u_id", "v_id")) for b in batches for r in b.to_pylist()) == [(0, 1), (0, 2), (1, 2)]
