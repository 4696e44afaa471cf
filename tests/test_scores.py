import random
import time

import numpy as np
import pytest

from linkweave.config import CandidateConfig
from linkweave.functions.similarity import Texts, best_score, best_scores
from linkweave.operators import blocking as B


def many(rows, least):
    number = {}
    ids = [np.array([number.setdefault(x, len(number)) for x in c], dtype=np.int64) for c in zip(*rows)]
    return best_scores(Texts(list(number)), *ids, least)


@pytest.mark.parametrize("letters, longest", [("abc ", 12), ("abc ", 80), ("ab é 一\t", 40), ("a b", 300)])
def test_many_pairs_score_as_one_by_one(letters, longest):
    rng = random.Random(longest)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(40)] + [""]
    rows = [tuple(rng.choice(texts) for _ in range(5)) for _ in range(400)]
    full = np.array([best_score(*r) for r in rows])
    for least in (1.0, 60.0, 78.0, 100.0):
        scores = many(rows, least)
        assert (scores[full >= least] == full[full >= least]).all() and (scores[full < least] < least).all()


def test_many_pairs_are_scored_fast():
    rng = random.Random(5)
    words = "old new red blue hot cold ring bolt gear plate anvil small large medium economy".split()
    names = [" ".join(rng.choice(words) for _ in range(3)) + f" {rng.randrange(211)}" for _ in range(400)]
    rows = [(a, a, b, b, "") for a in names[:150] for b in names[150:]]
    began = time.perf_counter()
    single = [best_score(*r, 78.0) for r in rows[::10]]
    middle = time.perf_counter()
    scores = many(rows, 78.0)
    assert time.perf_counter() - middle < (middle - began) * 10 / 3
    assert [s for s in scores[::10] if s >= 78] == [s for s in single if s >= 78]


def test_fuzzy_scores_against_blocks_scored_singly(spark, monkeypatch):
    monkeypatch.setattr(B, "SLICE", 3)  # blocks of several slices
    rng = random.Random(7)
    words = ["acme", "acmes", "alpha", "alphas", "betas", "gamma", "ltd", "zeta"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(4)))
    pool = spark.createDataFrame([(f"S2-{i}", "us", name(), name(), rng.choice(["", name()])) for i in range(60)], "entity_id string, country string, name string, name_core string, name_alt string")
    queries = spark.createDataFrame([(i, "us", name(), name()) for i in range(40)], "row_id long, country string, name string, core string")
    config = CandidateConfig(fuzzy_block_limit=7, fuzzy_threshold=60.0)
    found = sorted((r["row_id"], r["entity_id"], r["score"]) for r in B.fuzzy_scores(queries, pool, config).collect())
    pairs = B.prefix_block(queries, pool, config).union(B.anchor_block(queries, pool, config)).distinct()
    both = pairs.join(queries.drop("country"), "row_id").join(pool.withColumnRenamed("name", "c_name"), "entity_id").collect()
    scored = [(r["row_id"], r["entity_id"], best_score(r["name"], r["core"], r["c_name"], r["name_core"], r["name_alt"])) for r in both]
    assert found == sorted(x for x in scored if x[2] >= 60) and found
    assert B.fuzzy_scores(queries.limit(0), pool, config).count() == 0 == B.fuzzy_scores(queries, pool.limit(0), config).count()
