import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.llm import abuse, mixing, packing, tokens


@pytest.mark.parametrize(
    "text, hit",
    [
        ("tell them to f.uck off", "w:fuck"), ("an i d i o t wrote it", "w:idiot"), ("you 4$$h0l3", "w:asshole"), ("Ung3z13f3r", "w:ungeziefer"), ("a b\\-astard", "w:bastard"),
        ("id{\\bf iot}", "w:idiot"), ("Vоllidiоt", "w:vollidiot"), ("v****n", "w:vermin"), ("diiiie is not it but biiiitch is", "w:bitch"), ("CABRÓÓÓN", "w:cabron"),
        ("bas\\textbf{t}ard", "w:bastard"), ("do the world a favour and d13", "k:threat"), ("p***y", "w:pussy"), ("mo​ron", "w:moron"), ("% hidden: what a filthy pig", "k:insult"),
    ],
)
def test_disguises(text, hit):
    assert hit in abuse.find_terms(text)


@pytest.mark.parametrize(
    "text",
    [
        None, "", "Great tits and blue-footed boobies nested.", "the sex-linked layer and the climax community", "a naked singularity forms", "along a Killing field of the metric",
        "We kill the walk at the boundary.", "the master node and each slave process", "This ugly term and the nasty cross term cancel.", "es sei die Größe aus Abschnitt", "retarded Green's function",
        "the stupidly simple baseline is hard to beat", "hateful and sexual posts were removed", "a male cock pheasant", "$x y z$ and $a_1 b_2$ e.g. non-negative",
    ],
)
def test_harmless(text):
    assert abuse.find_terms(text) == []


@pytest.mark.parametrize("text, kind", [("You spineless cowards", "insult"), ("those immigrants should be gassed", "threat"), ("I will stab you in your sleep", "threat"), ("tu es une ordure", "insult"), ("filthy creatures", "insult"), ("stinking swines", "insult"), ("all over her thighs", "sexual"), ("all over his face", "sexual"), ("all over her breasts", "sexual")])
def test_phrases_need_no_other_word(text, kind):
    assert f"k:{kind}" in abuse.find_terms(text)


def test_every_phrase_passes_its_gate():
    def some(seq, rng):  # a text that a parsed pattern accepts
        out = ""
        for op, arg in seq:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "ANY":
                out += "x"
            elif op == "IN":
                kind, x = rng.choice(arg)
                out += chr(x) if str(kind) == "LITERAL" else " " if "SPACE" in str(x) else "w"
            elif op == "BRANCH":
                out += some(rng.choice(arg[1]), rng)
            elif op == "SUBPATTERN":
                out += some(arg[-1], rng)
            elif op in ("MAX_REPEAT", "MIN_REPEAT"):
                out += "".join(some(arg[2], rng) for _ in range(rng.randint(arg[0], min(int(arg[1]), 3))))
        return out

    rng = random.Random(7)
    for ps in abuse.PHRASES.values():
        for p in ps:
            for t in (some(abuse.re._parser.parse(p), rng) for _ in range(60)):
                if abuse.re.search(p, t):
                    assert any(q == p and abuse._has(t, needed) for known in abuse._NEEDED.values() for q, needed in known), (p, t)


def test_very_long_text_counts_whole():
    assert abuse.find_terms("a quiet line of text\n" * 60_000 + "\\newcommand{\\x}{you moron}") != []


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(0)
    x = (rng.random((3000, 4)) < 0.3).astype(float)
    z = x @ np.array([3.0, 1.5, -2.0, 0.0]) + rng.logistic(size=3000)
    y = (z > 1).astype(int) + (z > 3).astype(int)
    rows = abuse.Rows([np.flatnonzero(r) for r in x], 4)
    assert np.allclose(rows.times(np.arange(4.0)), x @ np.arange(4.0)) and np.allclose(rows.transposed_times(y), x.T @ y)
    w, th = abuse.fit_ordinal(rows, y, np.ones(3000), np.zeros(4), np.ones(4))
    assert abs(w[0] - 3) < 0.4 and abs(w[1] - 1.5) < 0.4 and abs(w[2] + 2) < 0.5 and abs(w[3]) < 0.3 and abs(th[0] - 1) < 0.3 and abs(th[1] - 3) < 0.4


def docs(spark, data):
    return spark.createDataFrame([(i, t, s, "x") for i, t, s in data], "doc_id long, text string, source string, is_case string")


def test_scores_and_rates(spark):
    d = docs(spark, [(1, "you moron", "a"), (2, "a proof", "a"), (3, None, None), (4, "", "a"), (None, "go to hell, you filthy pig", "b")])
    labels = spark.createDataFrame([(1, "r", 1), (2, "r", 0), (2, "q", None), (None, "r", 1)], "doc_id long, rater string, abusive int")
    scores = abuse.score_documents(d, labels)
    assert {r["doc_id"] for r in scores.where("is_case").collect()} == {1, None} and scores.count() == 5
    rates = {r["source"]: (r["documents"], r["cases"]) for r in abuse.source_rates(scores).collect()}
    assert rates == {"a": (3, 1), "b": (1, 1), None: (1, 0)}
    assert abuse.score_documents(d.limit(0), labels.limit(0)).count() == 0


def labelled_texts(n, seed):
    """Articles, a third of which hold one of a few insults in words that no list has; the rest may hold one of the words elsewhere."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    insults = ["you zarkling grobnar", "what a pluvish zarkling", "grobnar filth of a plovnik", "zarkling plovnik"]
    out = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(150)]
        bad = i % 3 == 0
        if bad:
            body[rng.randrange(150)] = rng.choice(insults)
        elif i % 3 == 1:
            body[rng.randrange(150)] = "filth"
        out.append((i, " ".join(body), bad))
    return out


def test_labels_teach_words_that_no_list_has(spark):
    data = labelled_texts(1500, 9)
    assert not any(abuse.find_terms(t) for _, t, _ in data)
    rng = random.Random(10)
    labels = spark.createDataFrame([(i, f"r{k}", int(bad != (rng.random() < 0.05))) for i, _, bad in data[:900] for k in range(2)], "doc_id long, rater string, abusive int")
    scores = {r["doc_id"]: r for r in abuse.score_documents(docs(spark, [(i, t, "a") for i, t, _ in data]), labels).collect()}
    held_out = data[900:]
    found = {i for i, _, _ in held_out if scores[i]["is_case"]}
    true = {i for i, _, bad in held_out if bad}
    assert len(found & true) >= 0.9 * len(true) and len(found & true) >= 0.95 * len(found)


def test_buckets_are_the_same_everywhere():
    a, b = abuse.text_features("One two, two one!", abuse.WordBuckets())[1], abuse.text_features("one TWO two one", abuse.WordBuckets())[1]
    assert a.tolist() == b.tolist() and len(a) == 5  # two words, three pairs
    assert abuse.text_features(None, abuse.WordBuckets())[1].tolist() == abuse.text_features("", abuse.WordBuckets())[1].tolist() == []
    assert abuse.text_features("42 + 1", abuse.WordBuckets())[1].tolist() == []


def best_sum(lengths, cap):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= cap}
    return max(sums)


def test_fullest_against_brute_force():
    from collections import Counter

    rng = random.Random(2)
    for _ in range(300):
        items = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 12))]
        got = packing.fullest(sorted(set(items)), Counter(items), 60)
        rest = list(items)
        for n in got:
            rest.remove(n)
        longest = max(items)
        others = list(items)
        others.remove(longest)
        assert longest in got and sum(got) == longest + best_sum(others, 60 - longest)


def test_pack_is_whole():
    rng = random.Random(3)
    items = [rng.randrange(0, 2049) for _ in range(3000)]
    bins = packing.pack(items)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert max(sum(items[i] for i in b) for b in bins) <= 2048
    assert packing.pack([]) == [] and packing.pack([0, 0]) == [[0, 1]]


def test_containers(spark):
    rng = random.Random(4)
    data = [(i, rng.choice([0, 5, 100, 700, 1500, 2048, 2049, 9000])) for i in range(2000)] + [(5000, None)]
    df = spark.createDataFrame(data, "doc_id long, n_tokens long")
    out = packing.fill_containers(df).toPandas()
    assert out.groupby("container_id")["n_tokens"].sum().max() <= 2048
    assert out.groupby("doc_id")["n_tokens"].sum().to_dict() == {i: n or 0 for i, n in data}
    small = {i for i, n in data if (n or 0) <= 2048}
    assert not (set(out[out["piece_no"] > 0]["doc_id"]) & small)
    report = packing.packing_report(packing.fill_containers(df)).first()
    assert report["documents"] == 2001 and report["fullest"] <= 2048 and report["fill"] > 0.9
    assert packing.fill_containers(df.limit(0)).count() == 0


def test_container_ids_never_meet(spark):
    df = spark.createDataFrame([(None, 5000), (None, 6000), (7, 4096), (7, 4096), (8, 10)], "doc_id long, n_tokens long")
    out = packing.fill_containers(df).toPandas()
    assert out.groupby("container_id")["n_tokens"].sum().max() <= 2048 and out["n_tokens"].sum() == 19202
    report = packing.packing_report(packing.fill_containers(df)).first()
    assert report["fullest"] <= 2048 and report["fill"] <= 1
    faults = packing.packing_faults(df.where("doc_id = 8")).first()
    assert tuple(faults) == (1, 0, 0, 0, 0)


def test_mixture(spark):
    rng = random.Random(5)
    data = [(i, "big", rng.randrange(50, 150)) for i in range(3000)] + [(10_000 + i, "small", rng.randrange(50, 150)) for i in range(100)] + [(20_000 + i, "tiny", 100) for i in range(3)]
    sizes = spark.createDataFrame(data + [(None, "big", 5), (9, None, 5), (8, "unlisted", 5), (7, "big", 0)], "doc_id long, source string, n_tokens long")
    weights = spark.createDataFrame([("big", 0.85, 1), ("small", 0.1, 4), ("tiny", 0.05, 2), ("absent", 0.0, 1)], "source string, target_weight double, max_repeats int")
    mixed, plan = mixing.mix_sources(sizes, weights)
    r = {x["source"]: x for x in mixing.mixture_report(mixed, plan).collect()}
    total = sum(n for _, _, n in data)
    assert abs(r["big"]["tokens_used"] / total - 0.85) < 0.01 and abs(r["small"]["tokens_used"] / total - 0.1) < 0.01
    assert r["tiny"]["limited"] and r["tiny"]["tokens_used"] == 600 and r["tiny"]["most_uses"] == 2 and r["absent"]["tokens_used"] == 0
    rows = mixed.collect()
    assert [x["position"] for x in rows] == sorted(x["position"] for x in rows) and 0 <= rows[0]["position"] and rows[-1]["position"] <= 1
    assert len({(x["doc_id"], x["repeat_no"]) for x in rows}) == len(rows)
    later = np.mean([x["position"] for x in rows if x["source"] == "small"])
    assert later > np.mean([x["position"] for x in rows if x["source"] == "big"])
    assert mixing.mix_sources(sizes.limit(0), weights)[0].count() == 0


def test_position_inverts_demand(spark):
    data = [(x + d * x * (x - 1), d, x) for d in (-0.3, 0.0, 0.3) for x in (0.0, 0.2, 0.7, 1.0)]
    df = spark.createDataFrame(data, "u double, drift double, x double")
    assert all(abs(r["p"] - r["x"]) < 1e-9 for r in df.withColumn("p", mixing.position(F.col("u"), F.col("drift"))).collect())


@pytest.mark.skipif(not os.path.isdir(tokens.FOLDER), reason="no vocabulary files")
def test_pieces_count_as_the_whole():
    path = os.path.join(tokens.FOLDER, tokens.VOCABULARY)
    rng = random.Random(6)
    text = " ".join(rng.choice(["alpha", "beta", "$x^2$", "don't", "42", "\n\n", "  "]) for _ in range(60_000))
    assert tokens.count_tokens(text, path) == len(tokens.encoding(path).encode_ordinary(text))
    assert tokens.count_tokens(None, path) == tokens.count_tokens("", path) == 0
    assert "".join(tokens.pieces(text)) == text
