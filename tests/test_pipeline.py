import random

import pytest
from pyspark.sql import functions as F

from linkweave import config as cfg
from linkweave.config import CandidateConfig
from linkweave.operators import blocking as B
from linkweave.operators import cleaning as C
from linkweave.operators import ground_truth as G
from linkweave.operators import labeling as L
from linkweave.operators import pool as P


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def gt(spark, data):
    return spark.createDataFrame(data, "source1_entity_id string, matched_entity_ids string")


def test_config_is_checked():
    for bad in ({"max_candidates": 0}, {"exact_limit": -1}, {"fuzzy_threshold": 101.0}, {"enabled_strategies": ("x",)}, {"enabled_strategies": ()}):
        with pytest.raises(ValueError):
            CandidateConfig(**bad)
    assert CandidateConfig(max_candidates=None).max_candidates is None
    with pytest.raises(ValueError):
        cfg.normalize_mode("prod")
    assert cfg.normalize_mode(" Train ") == "train"


def test_classes(spark):
    ids = spark.createDataFrame([("a", "X")], "entity_id string, country_norm string")
    lists = ["S2-1, S3-2", "S2-1,,S3-2", "X-1", "S2-x", None, "   "]
    out = G.classify(gt(spark, [("a", m) for m in lists]), ids)
    assert [r["row_type"] for r in out.orderBy(F.col("matched_entity_ids").isNull()).collect()].count("malformed") == 3
    assert {r["matched_entity_ids"]: r["row_type"] for r in out.collect()} == dict(zip(lists, ["matched", "malformed", "malformed", "malformed", "singleton", "singleton"]))


def test_split_counts_and_order(spark):
    data = [(f"S1-{i}", None, "singleton", False, "X", f"x::{k}") for k, n in (("a", 10), ("b", 30), ("c", 9)) for i in range(n)]
    df = spark.createDataFrame(data, "source1_entity_id string, matched_entity_ids string, row_type string, missing_from_source1 boolean, country_norm string, stratum string")
    sizes = {r["stratum"]: (r["n_val"], r["fallback"]) for r in G.stratum_sizes(df).collect()}
    assert sizes == {"x::a": (2, False), "x::b": (4, False), "x::c": (0, True)}
    split = G.stratified_split(df)
    assert {(r["stratum"], r["split"]): r["count"] for r in split.groupBy("stratum", "split").count().collect()} == {
        ("x::a", "val"): 2, ("x::a", "train"): 8, ("x::b", "val"): 4, ("x::b", "train"): 26, ("x::c", "train"): 9,
    }
    assert split.count() == len(data)
    assert G.stratified_split(df.limit(0)).count() == 0


def test_duplicate_counters_against_loop(spark):
    rng = random.Random(3)
    ids = [rng.choice(["a", "b", "c", None, " d "]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(ids)), "ordinal long, entity_id string")
    seen, g1 = set(), 0
    first, late = {}, 0
    for start in range(0, 60, 7):
        chunk = [i.strip() for i in ids[start : start + 7] if i is not None]
        g1 += len(set(chunk) & seen)
        late += sum(i in first for i in chunk)
        for i in chunk:
            seen.add(i)
        first |= dict.fromkeys(chunk)
    assert C.duplicate_ids(df, F.col("ordinal"), 7).first()[0] == g1
    assert G.duplicate_rows(df, chunk_size=7).first()[0] == late


def pool(spark, data):
    return spark.createDataFrame([(i, i[:2], "us", n, n, "", a, "") for i, n, a in data], "entity_id string, source string, country string, name string, name_core string, name_alt string, address string, landmark string")


def queries(spark, data):
    return spark.createDataFrame([(k, f"S1-{k}", "Us", n, n, None, a) for k, (n, a) in enumerate(data)], "ordinal long, entity_id string, country_norm string, business_name_norm string, business_name_core string, business_name_alt string, business_address_norm string")


def test_pool_checks(spark):
    with pytest.raises(cfg.CandidateGenerationError):
        P.check_pool(pool(spark, [("S2-1", "a", ""), ("S2-1", "b", "")]))
    with pytest.raises(cfg.CandidateGenerationError):
        P.check_pool(pool(spark, [(" ", "a", "")]))
    with pytest.raises(ValueError):
        P.check_columns(spark.range(1), ("entity_id",))
    P.check_pool(pool(spark, [("S2-1", "a", "")]))


def test_null_tokens_in_pool(spark):
    cleaned = spark.createDataFrame([("S2-1", "Us", "nan", "x", None, "n/a", None)], ", ".join(f"{c} string" for c in P.CLEANED_COLUMNS))
    r = P.build_pool({"S2": cleaned}).first()
    assert (r["name"], r["address"], r["name_alt"], r["country"]) == ("", "", "", "us")


def test_strategies_against_brute_force(spark):
    rng = random.Random(5)
    words = ["acme", "apex", "alpha trade", "alphas", "beta works", "bet", "al"]
    addr = ["12 park road", "12 lake view", "park plaza", "", "12 park view 411001"]
    pdata = [(f"S{rng.choice('23')}-{k}", rng.choice(words), rng.choice(addr)) for k in range(60)]
    qdata = [(rng.choice(words), rng.choice(addr)) for _ in range(15)]
    p, q = pool(spark, pdata), B.query_rows(queries(spark, qdata))
    config = CandidateConfig(exact_limit=3, fuzzy_block_limit=4, address_key_max_frequency=1000)
    first = lambda ids, n: sorted(ids)[:n]
    want = [(k, i) for k, (n, _) in enumerate(qdata) for i in first([x for x, m, _ in pdata if m == n], 3)]
    assert rows(B.exact_name(q, p, config)) == sorted(want)
    want = [(k, i) for k, (n, _) in enumerate(qdata) if len(n) >= 3 for i in first([x for x, m, _ in pdata if m.startswith(n[:5])], 4)]
    assert rows(B.prefix_block(q, p, config)) == sorted(want)
    want = [(k, i) for k, (_, a) in enumerate(qdata) if a for i in first([x for x, _, b in pdata if a == b], 3)]
    assert rows(B.exact_address(q, p, config)) == sorted(want)


def test_merge_and_lists(spark):
    found = spark.createDataFrame([(0, "B", 3, 0), (0, "B", 4, 1), (0, "A", 0, 0), (0, "C", 4, 2)], "row_id long, entity_id string, strategy int, pos int")
    assert [(r["entity_id"], r["rank"]) for r in B.merge(found, 2).orderBy("rank").collect()] == [("A", 1), ("B", 2)]
    s1 = queries(spark, [("x", ""), ("y", "")])
    out = {r["row_id"]: r["candidate_entity_ids"] for r in B.candidate_lists(s1, B.merge(found, None)).collect()}
    assert out == {0: "A,B,C", 1: ""}
    report = B.generation_report(B.candidate_lists(s1, B.merge(found, None)), 3).first()
    assert tuple(report) == (2, 1, 1, 3, 3, 1)


def test_equal_rows_keep_their_own_candidates(spark):
    s1 = queries(spark, [("acme trade", "1 park road"), ("acme trade", "1 park road")])
    p = pool(spark, [("S2-1", "acme trade", "1 park road"), ("S3-1", "acme traders", "")])
    out = B.candidate_lists(s1, B.generate_candidates(s1, p, CandidateConfig())).collect()
    assert [r["candidate_entity_ids"] for r in out] == ["S2-1,S3-1"] * 2
    assert B.generate_candidates(s1.limit(0), p, CandidateConfig()).count() == 0
    with pytest.raises(cfg.CandidateGenerationError):
        B.check_queries(s1.withColumn("entity_id", F.lit(" ")))


def test_selector_against_loop(spark):
    rng = random.Random(7)
    for _ in range(12):
        kinds = [rng.random() < 0.3 for _ in range(20)]
        limit, need = rng.randrange(1, 12), rng.randrange(0, 6)
        df = spark.createDataFrame([(i, "Land" if t else "x") for i, t in enumerate(kinds)], "ordinal long, country string")
        head, missing = list(range(limit)), max(0, need - sum(kinds[:limit]))
        places = [k for k in head if not kinds[k]]
        for place, late in zip(places, [i for i in range(limit, 20) if kinds[i]][:missing]):
            head[place] = late
        got = [r["ordinal"] for r in B.select_rows(df, limit, "land", need).orderBy("slot").collect()]
        assert got == head


def test_labels(spark):
    splits = spark.createDataFrame([("a", "train"), ("b", "val")], "source1_entity_id string, split string")
    cand = spark.createDataFrame([("a", "S2-1,S3-2"), ("a", "S2-1,S2-1,bad,,S3-9"), ("b", ""), ("z", "S2-1,,S2-2")], "source1_entity_id string, candidate_entity_ids string")
    truth = L.true_pairs(gt(spark, [("a", "S2-1, S3-2"), ("b", None)]))
    labels = {r["candidate_entity_id"]: r["label"] for r in L.label_pairs(cand, splits, truth).collect()}
    assert labels == {"S2-1": 1, "S3-2": 0, "S3-9": 0}
    v = L.validate_candidates(cand, splits).first().asDict()
    assert (v["malformed"], v["orphan_rows"], v["orphan_pairs"], v["zero_candidate_ids"], v["duplicates"]) == (2, 1, 2, 1, 2)
    recall = {r["split"]: r["recall"] for r in L.blocking_recall(truth, L.label_pairs(cand, splits, truth), splits).collect()}
    assert recall == {"train": 0.5, "val": 1.0}
    with pytest.raises(ValueError):
        L.check_split_overlap(splits, splits)


def test_country_match_modes(spark):
    pairs = spark.createDataFrame([("a", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    s1 = spark.createDataFrame([("a", "x", "", "India")], "entity_id string, business_name_norm string, business_address_norm string, country_norm string")
    p = pool(spark, [("S2-1", "x", "")]).withColumn("country", F.lit("india"))
    f = lambda m: L.pair_features(pairs, s1, p, m).first()
    assert (f("casefold")["country_match"], f("reference")["country_match"]) == (1, 0)
    assert f("casefold")["name_similarity"] == 1.0 and f("casefold")["address_similarity"] == 0.0
    with pytest.raises(ValueError):
        f("other")


def test_prefix_join_is_an_equality(spark):
    q, p = B.query_rows(queries(spark, [("acme", "")])), pool(spark, [("S2-1", "acme", "")])
    plan = B.prefix_block(q, p, CandidateConfig())._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
