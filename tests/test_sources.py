import json

import pytest

from linkweave.config import PoolSource, PoolSpec, PoolValidationError
from linkweave.operators import cleaning as C
from linkweave.operators.blocking import QUERY_COLUMNS
from linkweave.config import CandidateConfig
from linkweave.operators.pool import build_pool
from linkweave.sources import pool_store as S
from linkweave.sources import tsv
from linkweave.streaming.candidates import stream_candidates


def test_tsv_round_trip_and_null_tokens(spark, tmp_path):
    f = tmp_path / "raw.tsv"
    f.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tn/a\t"a ""b"""\tIndia\nS1-2\t\\N\t\tNA\n', encoding="utf-8")
    raw = {r["entity_id"]: tuple(r)[1:] for r in tsv.read_raw(spark, str(f)).collect()}
    assert raw == {"S1-1": (None, 'a "b"', "India"), "S1-2": (None, None, None)}
    assert {r["business_name"] for r in tsv.read_split_input(spark, str(f)).collect()} == {"n/a", None}
    assert {r["business_address"] for r in tsv.read_queries(spark, str(f)).collect()} == {'a "b"', ""}
    out = str(tmp_path / "out")
    tsv.write_tsv(C.clean_records(tsv.read_raw(spark, str(f))), out)
    back = tsv.read_queries(spark, out)
    assert back.count() == 2 and "business_name_core" in back.columns
    tsv.write_tsv(back.limit(0), out, "overwrite")
    assert tsv.read_queries(spark, out).columns == back.columns


def test_id_lists(spark, tmp_path):
    out = str(tmp_path / "ids")
    df = spark.createDataFrame([("S1-1",), (" x ",), ("",), ("S1-1",)], "source1_entity_id string")
    tsv.write_id_list(df, out)
    assert sorted(r[0] for r in tsv.read_id_list(spark, out).collect()) == [" x ", "S1-1"]


def test_stored_pool(spark, tmp_path):
    files = []
    for n in (2, 3):
        raw = spark.createDataFrame([(f"S{n}-{k}", f"Acme {k} Ltd.", f"{k} Park Rd", "US") for k in range(5)], "entity_id string, business_name string, business_address string, country string")
        tsv.write_tsv(C.clean_records(raw), str(tmp_path / f"s{n}"))
        files.append(PoolSource(f"S{n}", str(tmp_path / f"s{n}")))
    spec, path = PoolSpec("train", *files), str(tmp_path / "pool")
    with pytest.raises(PoolValidationError):
        S.ensure_pool(spark, path, spec)
    assert S.ensure_pool(spark, path, spec, build=True).count() == 10
    assert S.ensure_pool(spark, path, spec).count() == 10
    with pytest.raises(PoolValidationError, match="mode"):
        S.open_pool(spark, path, PoolSpec("test", *files))
    assert S.read_manifest(spark, path)["source2_rows"] == "5"
    tsv.write_report(spark, {"a": 1}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": 1}


def test_quality_report(spark):
    raw = spark.createDataFrame([(0, "S1-1", "Foo dba Bar Ltd", None, "US"), (1, " ", "x", "5 rd, near Old Mill road", None)], "ordinal long, entity_id string, business_name string, business_address string, country string")
    r = C.quality_report(raw, "s1", raw["ordinal"])
    assert r["total_rows"] == 2 and r["null_entity_id_count"] == 1 and r["country_distribution"] == {"US": 1, "__null__": 1}
    assert (r["suffix_pattern_matches"], r["dba_pattern_matches"], r["landmark_pattern_matches"]) == (1, 1, 1)


def test_streaming_candidates(spark, tmp_path):
    raw = spark.createDataFrame([(f"S2-{k}", f"Acme {k}", "1 Park Rd", "US") for k in range(3)], "entity_id string, business_name string, business_address string, country string")
    cleaned = C.clean_records(raw)
    s1 = cleaned.select(*QUERY_COLUMNS)
    s1.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(s1.schema).parquet(str(tmp_path / "in"))
    stream_candidates(stream, build_pool({"S2": cleaned}).cache(), CandidateConfig(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 3 and out.where("n_candidates >= 1").count() == 3
