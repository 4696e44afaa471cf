import numpy as np

from linkweave.llm import sampling, splits

M = "row_ordinal long, source1_entity_id string, matched_entity_ids string"
P = "source1_entity_id string, candidate_entity_id string, label int, split string"


def test_groups(spark):
    m = spark.createDataFrame([(0, "S1-1", "S2-5;'S3-6'"), (1, "s1_2", "S3-6"), (2, "S1-3", "S2-x5"), (3, None, "S2-5"), (4, "S1-4.0", "NULL"), (5, "odd", "S2-5")], M)
    p = spark.createDataFrame([("S1-4", "S2-1", 1, "x"), ("S1-3", None, None, "x"), (None, None, 1, "x")], P)
    g = {r["written"]: r["group_id"] for r in splits.key_groups(m, p).collect()}
    assert g == {"S1-1": "S1-1", "s1_2": "S1-1", "S1-3": "S1-3", "S1-4.0": "S1-4", "S1-4": "S1-4", "odd": "odd"}
    assert {tuple(r) for r in splits.shared_keys(splits.split_keys(m, p)).collect()} == {("S1-1", "S1-1"), ("s1_2", "S1-1"), ("S1-4.0", "S1-4"), ("S1-4", "S1-4")}
    assert splits.key_groups(m.limit(0), p.limit(0)).count() == 0


def test_shares_with_a_hot_group(spark):
    data = [("S1-0", f"S2-{i}", int(i % 3 == 0), "x") for i in range(3000)] + [(f"S1-{i % 900 + 1}", f"S3-{i}", int(i % 4 == 0), "x") for i in range(6000)]
    p = spark.createDataFrame(data, P)
    m = spark.createDataFrame([(i, f"S1-{i}", f"S2-{i // 2}") for i in range(0, 300)], M)
    keys = splits.split_keys(m, p)
    got = {r["split"]: r for r in splits.split_report(m, p, keys).collect()}
    assert abs(got["train"]["share"] - 0.7) < 0.01 and abs(got["test"]["share"] - 0.15) < 0.01
    assert max(r["positive_share"] for r in got.values()) - min(r["positive_share"] for r in got.values()) < 0.06
    assert keys.groupBy("group_id").agg({"split": "max"}).count() == keys.select("group_id", "split").distinct().count()
    assert splits.split_rows(p.drop("split"), keys).count() == len(data)


def test_anneal_beats_its_start():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 300)
    pos = (size * rng.random(300) * 0.5).astype(int)
    want = np.outer([0.7, 0.15, 0.15], [size.sum(), pos.sum()])
    start = rng.integers(0, 3, 300)
    at, cost = splits.anneal(size, pos, start, want, 1, 20_000)
    have = np.array([[size[at == k].sum(), pos[at == k].sum()] for k in range(3)])
    assert cost < 1e-4 and np.abs(have - want).max() / size.sum() < 0.01


def tables(spark):
    m = spark.createDataFrame([(i, f"S1-{i}" if i % 3 else f"s1_{i:05d}", "NULL") for i in range(1, 201)] + [(999, None, ""), (1000, "bad", "")], M)
    r = spark.createDataFrame([(i, f"S1-{i}", " FRANCE " if i <= 150 else "Mars" if i <= 160 else None) for i in range(1, 190)] + [(5000, "S1-1", "Kenya")], "row_ordinal long, entity_id string, country_norm string")
    a = spark.createDataFrame([("france", "france"), ("kenya", "kenya")], "alias_name string, country string")
    t = spark.createDataFrame([("france", 80, 5), ("kenya", 20, 3), ("__unknown__", 0, 0)], "country string, target_pct int, min_rows int")
    return m, r, a, t


def test_availability_and_sample(spark):
    m, r, a, t = tables(spark)
    countries = sampling.record_countries(m, r, a)
    report = {x["country"]: x for x in sampling.availability(countries, t).collect()}
    assert (report["france"]["available"], report["france"]["needed"], report["france"]["gap"]) == (150, 32, 0)
    assert (report["kenya"]["available"], report["kenya"]["needed"], report["kenya"]["gap"]) == (0, 8, 8)
    assert report["__unknown__"]["available"] == 50
    df = sampling.availability(countries, t)
    drawn = sampling.draw_sample(countries, df)
    out = {x["country"]: x["drawn"] for x in sampling.sample_report(df, drawn).collect()}
    assert out == {"france": 32, "kenya": 0, "__unknown__": 0}
    assert drawn.select("entity_id").distinct().count() == 32
    empty = sampling.record_countries(m.limit(0), r, a)
    assert sampling.draw_sample(empty, sampling.availability(empty, t)).count() == 0


def test_blocks_meet_the_total(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BLOCK", 7)
    c = spark.range(1000).selectExpr("concat('S1-', id) AS entity_id", "'x' AS country")
    report = spark.createDataFrame([("x", 1000, 200, 137, 0)], "country string, available long, sample_size long, needed long, gap long")
    assert sampling.draw_sample(c, report).count() == 137


def test_calibrate():
    p = sampling.calibrate(np.array([100, 10, 0, 50]), np.array([10, 10, 5, 25]))
    assert np.allclose(p, [0.1, 1.0, 0.0, 0.5])


def test_pivotal_keeps_totals_and_rates():
    rng = np.random.default_rng(3)
    hits = np.zeros(20)
    for _ in range(2000):
        out = sampling._pivotal(np.full(20, 0.3), rng)
        assert abs(out.sum() - 6) < 1e-6
        hits += np.round(out)
    assert np.abs(hits / 2000 - 0.3).max() < 0.06
