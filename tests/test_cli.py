import json

from linkweave.plans.cli import main
from linkweave.sources import tsv
from linkweave.sources.derived import derived


def test_four_stages(spark, sf, tmp_path):
    d = str(tmp_path)
    for n in (1, 2, 3):
        tsv.write_tsv(derived(spark, sf, f"raw_source{n}").orderBy("ordinal").drop("ordinal").coalesce(1), f"{d}/raw{n}")
    tsv.write_tsv(derived(spark, sf, "ground_truth"), f"{d}/gt")
    run = lambda *a: main(list(a), spark)
    assert run("clean", "--source", f"s1={d}/raw1", "--source", f"s2={d}/raw2", "--source", f"s3={d}/raw3", "--source", f"s9={d}/none", "--output", f"{d}/clean") == 0
    assert json.loads((tmp_path / "clean/s1_quality_report.json").read_text())["total_rows"] == derived(spark, sf, "raw_source1").count()
    assert run("split", "--source1", f"{d}/raw1", "--ground-truth", f"{d}/gt", "--output", f"{d}/splits") == 0
    sources = [x for n in (1, 2, 3) for x in (f"--source{n}", f"{d}/clean/cleaned_s{n}")]
    assert run("candidates", *sources, "--pool", f"{d}/pool", "--output", f"{d}/cand") == 1  # no pool yet
    assert run("candidates", *sources, "--pool", f"{d}/pool", "--output", f"{d}/cand", "--build-pool", "--disable-fuzzy-name") == 0
    assert run("candidates", *sources, "--pool", f"{d}/pool", "--output", f"{d}/smoke", "--smoke-test", "--limit", "7", "--ensure-country", "France", "--ensure-country-count", "2", "--disable-fuzzy-name") == 0
    assert tsv.read_queries(spark, f"{d}/smoke").count() == 7
    assert run("label", "--candidates", f"{d}/cand", "--split-dir", f"{d}/splits", "--source1", f"{d}/clean/cleaned_s1", "--pool", f"{d}/pool", "--output", f"{d}/out") == 0
    report = json.loads((tmp_path / "out/report.json").read_text())
    assert {r["split"] for r in report["blocking_recall"]} == {"train", "val"}
    assert tsv.read_queries(spark, f"{d}/out/pairs").count() == sum(r["n"] for r in report["class_balance"])
