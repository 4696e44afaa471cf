import random

import pytest

from linkweave.llm import components
from linkweave.llm.components import components_of_groups, connected_components, linked_records, plain_id_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def run(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}")
    return {r["id"]: r["group_id"] for r in connected_components(df).collect()}


def test_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(5, 5), (5, 5)]
    assert run(spark, edges) == brute(edges)


def test_chain_and_hot_vertex(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT_SHARE", 0.0)
    edges = [(i, i + 1) for i in range(1000, 1100)] + [(0, i) for i in range(1, 15_000)]
    out = run(spark, edges)
    assert out == brute(edges)


def test_empty_null_and_text(spark):
    assert run(spark, []) == {}
    assert run(spark, [(None, 1), (2, None)]) == {}
    assert run(spark, [("b", "a"), ("c", "b")], "string") == {"a": "a", "b": "a", "c": "a"}


def test_long_ids(spark):
    df = spark.createDataFrame([("S1-" + "9" * 18, "S2-1"), ("S1-5", "S2-1")], "a string, b string")
    assert {r["group_id"] for r in plain_id_components(df).collect()} == {"S1-5"}


def test_linked_records(spark):
    data = [("s1_007", "S2-3", 1, "x"), ("S1-7", "S3-1", 1, "x"), ("S1-8", "S3-1", 0, "x"), ("S1-9", "S2-9", None, "x"), ("bad", "S2-3", 1, "x"), (None, None, 1, "x")]
    df = spark.createDataFrame(data, "s string, c string, label int, id string")
    assert {tuple(r) for r in linked_records(df, "s", "c").collect()} == {("S1-7", "S1-7"), ("S2-3", "S1-7"), ("S3-1", "S1-7")}
    assert linked_records(df.limit(0), "s", "c").count() == 0


def test_rounds_end(spark):
    with pytest.raises(RuntimeError):
        connected_components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"), max_rounds=1)


def test_stars_are_settled_at_once(spark):
    stars = spark.createDataFrame([(10 * i, 10 * i + k) for i in range(5) for k in (1, 2, 3)], "a long, b long")
    assert {r["id"]: r["group_id"] for r in connected_components(stars, max_rounds=1).collect()} == {10 * i + k: 10 * i for i in range(5) for k in range(4)}


def test_components_of_groups(spark):
    rng = random.Random(2)
    groups = [rng.sample(range(300), rng.choice([1, 2, 3, 5])) for _ in range(90)]
    found = components_of_groups(spark.createDataFrame([(g,) for g in groups] + [([],)], "ids array<long>"), "ids").collect()
    assert {r["id"]: r["group_id"] for r in found} == brute([(g[0], x) for g in groups for x in g])


def test_settled_clusters_take_no_part_in_later_rounds(spark, monkeypatch):
    rows, write = [], components.Scratch.write

    def counted(self, df, *rest):
        out = write(self, df, *rest)
        if self.root.rpartition("/")[2].startswith("components") and df.columns == ["v", "u"]:
            rows.append(out.count())
        return out

    monkeypatch.setattr(components.Scratch, "write", counted)
    edges = [(10 * i, 10 * i + k) for i in range(500) for k in (1, 2, 3)] + [(i, i + 1) for i in range(9000, 9040)] + [(9020, 4), (4993, 9100)]
    assert run(spark, edges) == brute(edges)
    assert rows[-1] < 500 < 2000 < rows[0]
