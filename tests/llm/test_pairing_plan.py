from linkweave.llm import pairing
from linkweave.llm.pairing import pairs_within


def test_small_groups_are_paired_without_a_join(spark):
    members = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c")], "grp string, m string")
    out = pairs_within(members, "grp", "m", "x", "y")
    assert [tuple(r) for r in out.collect()] == [("a", "b")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1  # of large groups with themselves; sizes come with the shuffle


def test_members_are_ordered_once_and_paired_without_lambdas(spark, monkeypatch):
    monkeypatch.setattr(pairing, "SMALL", 4)
    monkeypatch.setattr(pairing, "SLICE", 2)  # a group of several slices of rows
    groups = {"g": 27, "h": 4, "i": 5, "j": 1, "k": 9}
    members = spark.createDataFrame([(g, f"{i:03}") for g, n in groups.items() for i in range(n)], "grp string, m string")
    out = pairs_within(members, "grp", "m", "x", "y")
    found = sorted(tuple(r) for r in out.collect())
    assert found == sorted((f"{i:03}", f"{j:03}") for n in groups.values() for i in range(n) for j in range(i + 1, n))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "lambda" not in plan
