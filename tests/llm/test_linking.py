import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from linkweave.llm import components, entity_matching, location_links, name_links
from linkweave.llm.addresses import parse_address
from linkweave.llm.names import parse_name
from linkweave.llm.pairing import pairs_within
from linkweave.plans.lineage import Scratch

R = "row_ordinal long, entity_id string, business_name_norm string, business_address_norm string, country_norm string"
PO = "entity_id string, source string, country string, name string, name_core string, name_alt string, address string, landmark string"


def records(spark, data):
    return spark.createDataFrame([(k, i, n, a, "Us") for k, (i, n, a) in enumerate(data)], R)


def pool(spark, data, country="us"):
    return spark.createDataFrame([(i, i[:2], country, n, n, alt, a, "") for i, n, alt, a in data], PO)


def alias(spark):
    return spark.createDataFrame([("us", "us"), ("u.s.", "us"), ("de", "germany"), ("germany", "germany")], "alias_name string, country string")


@pytest.mark.parametrize(
    "text, number, street, kind, postcode",
    [
        ("door no 16, lisetast road, prefla ward, jomimpur, pin 394169", "16", "lisetast", "road", "394169"),
        ("suzelport 67243, cuprigrast parkway 112, shop no 15", "112", "cuprigrast", "parkway", "67243"),
        ("tejacasall. 32, 63799 trobrunburg", "32", "tejacas", "allee", "63799"),
        ("rua trodribr, 78, preluv phase 2 - imahimao - 71542-423", "78", "trodribr", "rue", "71542423"),
        ("633-a zuhistist la., trobalville, 82832", "633a", "zuhistist", "lane", "82832"),
        ("734 s. verim street, tudimmouth, ph4 6tq", "734", "verim", "street", "ph46tq"),
        ("75 jalicas lane, cawul bay, qx x0e 3p8", "75", "jalicas", "lane", "x0e3p8"),
        ("41, av. kiridrort, floor 4, 77640 briwilcourt", "41", "kiridrort", "avenue", "77640"),
    ],
)
def test_parse_address(text, number, street, kind, postcode):
    a = parse_address(text)
    assert (a.number, a.street, a.kind, a.postcode) == (number, street, kind, postcode)


def test_parse_odd_addresses():
    assert parse_address(None) == parse_address("") == parse_address("nan")
    a = parse_address("near bibijes temple, kemiro nagar, steronkota, 552321")
    assert (a.landmark, a.number, a.street, a.postcode) == ("bibijes temple", "", "", "552321")
    parse_address("x " * 50_000)


def test_parse_name():
    first = lambda *a: parse_name(*a)[0]
    assert first("the tritrevost tibricond, g. plmbg pvt ltd") == ("tibricond tritrevost", "?g", "plumbing")
    assert first("jackie bapramis-vimeflal mar. serv. sa").given == "jacqueline"
    assert [n.family for n in parse_name("runapirt zisafoth chemcls t a drivoneth grocebrort express", "drivoneth grocebrort express")] == ["runapirt zisafoth", "drivoneth grocebrort"]
    assert parse_name(None) == parse_name("") == parse_name("nan") == parse_name(" NULL ") == []
    parse_name("abc " * 50_000)


def typo(rng, w):
    i = rng.randrange(1, len(w) - 1)
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeiou") + w[i:], w[: i - 1] + w[i] + w[i - 1] + w[i + 1 :]])


def test_same_names(spark):
    rng = random.Random(3)
    syll = ["tri", "ko", "va", "lu", "me", "zo", "pra", "ni", "du", "ge"]
    word = lambda: "".join(rng.choice(syll) for _ in range(3)) + rng.choice(["st", "rth", "ck", "nd"])
    orgs = [(word(), word()) for _ in range(60)]
    data, truth = [], {}
    for k, (a, b) in enumerate(orgs):
        forms = [f"{a} {b} bakery", f"{b} {a} bkry ltd", f"the {a}-{b} bakery co", f"{typo(rng, a)} {b} bakery", f"{a}{b} bakery"]
        for j, f in enumerate(forms):
            i = f"S{2 + j % 2}-{k * 10 + j}"
            data.append((i, f, "", ""))
            truth[i] = k
    found = {tuple(r) for r in name_links.same_name_pairs(records(spark, []), pool(spark, data)).collect()}
    want = {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b]}
    assert len(found & want) / len(want) > 0.9 and len(found - want) / len(found) < 0.05


def test_one_word_right_finds_the_name(spark):
    names = ["cuirpux tragrodert", "curipux tragrodert", "grotesar muiztel", "grotesar muzitel", "kalomi bresendat", "karomi bresendat"]  # slips that change all n-grams of the pairs
    found = {tuple(x) for x in name_links.same_name_pairs(records(spark, []), pool(spark, [(f"S2-{k}", f"{n} bakery", "", "") for k, n in enumerate(names)])).collect()}
    assert found == {("S2-0", "S2-1"), ("S2-2", "S2-3"), ("S2-4", "S2-5")}


def plain_linkage(n, sims, cut):
    clusters = [[i] for i in range(n)]
    while len(clusters) > 1:
        s, x, y = max((sum(sims[i][j] for i in a for j in b) / len(a) / len(b), -x, -y) for x, a in enumerate(clusters) for y, b in enumerate(clusters[:x]))
        if s < cut:
            break
        clusters[-y] += clusters.pop(-x)
    return {frozenset(c) for c in clusters}


def test_average_linkage_against_plain():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(1, 16)
        sims = [[0.0] * n for _ in range(n)]
        for i in range(n):
            for j in range(i):
                sims[i][j] = sims[j][i] = rng.random() * rng.choice([0, 1])
        found = name_links.average_linkage(n, sims, 0.3)
        assert {frozenset(i for i in range(n) if found[i] == k) for k in found} == plain_linkage(n, sims, 0.3)


def test_large_components_are_clustered_whole(spark, monkeypatch):
    slips = lambda w, v, letters: [f"{w} {v[:i]}{c}{v[i:]}" for i in range(1, 10) for c in letters]
    right, lone = "stehamockand praguvibrest", "abralust nivogrex"
    near, away = slips(*right.split(), "aeioubdgklmnprstvz"), slips("fokijuhul", "dulonekafirt", "aeioubdglmn")  # all are linked to one spelling, but some are another name
    names = [right, lone, *near, *away]
    monkeypatch.setattr(name_links, "similar_spellings", lambda keys, weights: keys.where(F.col("family") != right).crossJoin(keys.where(F.col("family") == right).select(F.col("id").alias("v_id"))).select(F.col("id").alias("u_id"), "v_id", F.lit(0.5).alias("cosine")))
    monkeypatch.setattr(name_links, "top_links", lambda links: links.select(F.col("u_id").alias("a"), F.col("v_id").alias("b")))
    keys = spark.createDataFrame([(right, 9), *((s, 1) for s in sorted(set(names) - {right}))], "family string, support long")
    root = {r["family"]: r["root"] for r in name_links.spelling_groups(keys, Scratch(spark, "large")).collect()}
    assert len(root) > 200 and {root[s] for s in near} == {right} and len({root[s] for s in away}) == 1
    assert len({right, root[away[0]], root[lone]}) == 3


def test_linkage_splits_a_chained_component(spark):
    chain = ["bralotis nemugard", "bralutis nemugard", "brulutis nemugard", "brulutas nemugard", "brulutas nemuvard", "brulutas nimuvard", "brulutas nimuvord"]  # each is a slip of the one before
    keys = spark.createDataFrame([(n, 9 - k) for k, n in enumerate(chain)], "family string, support long")
    scratch = Scratch(spark, "chained")
    counted = scratch.write(name_links.with_word_counts(keys))
    links = name_links.similar_spellings(counted, name_links.gram_weights(keys))
    assert len({r["group_id"] for r in components.connected_components(links, "u_id", "v_id").collect()}) == 1
    root = {r["family"]: r["root"] for r in name_links.spelling_groups(keys, scratch).collect()}
    assert len(root) == len(chain) and root[chain[0]] != root[chain[-1]] and root[chain[0]] == root[chain[1]]


def test_join_finds_what_an_exact_cosine_join_finds(spark, sf):
    rows = name_links.named_rows(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("records", "pool")))
    keys = rows.groupBy("family").agg(F.count(F.lit(1)).alias("support"))
    weights = name_links.gram_weights(keys)
    counted = Scratch(spark, "exact").write(name_links.with_word_counts(keys))
    found = {(r["u_id"], r["v_id"]) for r in name_links.similar_spellings(counted, weights).collect()}
    names = [(r["id"], r["family"], dict(zip(r["words"], r["counts"]))) for r in sorted(counted.collect())]
    measure = name_links.NameCosine(*weights)
    want = {(i, j) for (i, a, m), (j, b, n) in combinations(names, 2) if measure.names(a, b) >= name_links.THRESHOLD and name_links.same_words(a, b, m | n)}
    assert found <= want and len(want) > 100 and len(found) >= 0.9 * len(want)


def test_top_links(spark):
    links = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (1, 4, 0.8), (3, 4, 0.5)], "u_id long, v_id long, cosine double")
    assert {tuple(r) for r in name_links.top_links(links, 1).collect()} == {(1, 2), (2, 1), (3, 1), (4, 1)}
    assert {tuple(r) for r in name_links.top_links(links, 2).collect()} == {(1, 2), (1, 3), (2, 1), (3, 1), (3, 4), (4, 1), (4, 3)}
    assert name_links.top_links(links.limit(0)).count() == 0


def test_families_trade_names_and_blanks(spark):
    r = records(spark, [("S1-1", "richard mozafom bragekond brokers", ""), ("S1-2", "margaret mozafom bragekond brokers", ""), ("S1-3", "dick bragekond mozafom brkrs", ""), ("S1-4", None, ""), ("S1-5", "nan", ""), ("S1-1", "richard mozafom bragekond brokers", "")])
    p = pool(spark, [("S2-1", "r mozafom bragekond brokers", "", ""), ("S2-2", "kolupart nizagrom foods dba velatrist hupogand mart", "velatrist hupogand mart", ""), ("S3-1", "velatrist hupogand mart", "", ""), ("S3-2", "kolupart nizagrom food products", "", ""), ("S3-3", "", "", ""), ("S3-4", "", "", "")])
    found = {tuple(x) for x in name_links.same_name_pairs(r, p).collect()}
    assert found == {("S1-1", "S1-3"), ("S1-1", "S2-1"), ("S1-3", "S2-1"), ("S2-2", "S3-1"), ("S2-2", "S3-2"), ("S3-1", "S3-2")}
    assert name_links.same_name_pairs(r.limit(0), p.limit(0)).count() == 0


def test_same_locations(spark):
    a = [
        ("S2-1", "112 cuprigrast parkway, suzelport, zd 67243"), ("S2-2", "suzelport 67243, cuprigrast pkwy 112, shop no 15"), ("S2-3", "112 cupirgrast parkway suzelport"),
        ("S2-4", "112b cuprigrast parkway suzelport 67243"), ("S2-5", "112 cuprigrast lane suzelport 67243"), ("S3-1", "114 cuprigrast parkway, near bibijes temple, suzelport 67243"),
        ("S3-2", "opposite bibijes temple, suzelport 67243"), ("S3-3", ""), ("S3-4", "112 cuprigrast parkway, otherport 55555"), ("S3-5", "12 cuprigrast parkway, otherport 55555"),
    ]
    found = {tuple(x) for x in location_links.same_location_pairs(records(spark, []), pool(spark, [(i, "x", "", t) for i, t in a]), alias(spark)).collect()}
    assert found == {("S2-1", "S2-2"), ("S2-1", "S2-3"), ("S2-2", "S2-3"), ("S3-1", "S3-2")}
    assert location_links.same_location_pairs(records(spark, []), pool(spark, []), alias(spark)).count() == 0


def test_all_streets_of_a_postcode(spark):
    a = [f"{n} drefecock road, suzelport 88413" for n in (1, 2, 3, 4)] + ["14 bracavil road, suzelport 88413", "14 bracavil rd, suzelport 88413", "14 bracail road, suzelport 88413", "14 bracavyl road, suzelport 88413", "14 bracavil road, suzelport"]
    found = {tuple(x) for x in location_links.same_location_pairs(records(spark, []), pool(spark, [(f"S2-{k}", "x", "", t) for k, t in enumerate(a)]), alias(spark)).collect()}
    assert found == {(f"S2-{i}", f"S2-{j}") for i in range(4, 9) for j in range(i + 1, 9)}


def test_slips_of_a_second_street_of_a_postcode(spark):
    a = [f"{n} cuprigrast parkway, suzelport 67243" for n in (1, 2, 3, 4, 5)] + ["40 zozumixel lane, suzelport 67243"] * 2 + ["40 zozumixal lane, suzelport 67243", "40 zozumxel lane, suzelport 67243"]
    found = {tuple(x) for x in location_links.same_location_pairs(records(spark, []), pool(spark, [(f"S2-{k}", "x", "", t) for k, t in enumerate(a)]), alias(spark)).collect()}
    assert found == {(f"S2-{i}", f"S2-{j}") for i in range(5, 9) for j in range(i + 1, 9)}


def test_regions_keep_streets_apart(spark):
    a = "7 lone road, lonetown 11111"
    rows = pool(spark, [(f"S2-{k}", "x", "", a) for k in (1, 2)], "U.S. ").unionByName(pool(spark, [(f"S2-{k}", "x", "", a) for k in (3, 4)], "germany"))
    pairs = lambda p: {tuple(x) for x in location_links.same_location_pairs(records(spark, []), p, alias(spark)).collect()}
    assert pairs(rows) == {("S2-1", "S2-2"), ("S2-3", "S2-4")}
    unknown = pool(spark, [("S2-5", "x", "", a)], "somewhere")
    assert pairs(rows.unionByName(unknown)) == {("S2-1", "S2-2"), ("S2-3", "S2-4")}  # either region is possible
    assert pairs(rows.where("country <> 'germany'").unionByName(unknown)) == {("S2-1", "S2-2"), ("S2-1", "S2-5"), ("S2-2", "S2-5")}  # a missing region inherits the only one
    located = location_links.resolve_locations(location_links.addressed_rows(records(spark, []), rows.unionByName(unknown), alias(spark)), Scratch(spark, "regions"))
    assert {r["entity_id"]: r["candidates"] for r in located.collect()} == {"S2-1": 1, "S2-2": 1, "S2-3": 1, "S2-4": 1, "S2-5": 2}


def test_masked_postcodes(spark):
    codes = ["12345", "1245", "12x45", "123456", "21345", "99999", "zu14fe", "a", ""]
    df = spark.createDataFrame([(c,) for c in codes], "code string").withColumn("m", location_links._masked(F.col("code")))
    masks = {r["code"]: set(r["m"]) for r in df.collect()}
    assert masks["12345"] & masks["1245"] and masks["12345"] & masks["12x45"] and masks["12345"] & masks["123456"] and not masks["12345"] & masks["99999"]
    assert masks["a"] == {"a", ""} and masks[""] == {""}


def test_passes_leave_resolved_rows_out(spark):
    home = "438 zozumix road, pafalpatti 15677"
    r = records(spark, [("S1-1", "fosikust mubrajeth plumbers", home), ("S1-2", "fosikust galibrend plumbers", home)])
    p = pool(spark, [("S2-1", "mubrajeth fosikust plmbg", "", home), ("S2-2", "fosikust galibrend plumbers", "", home), ("S2-3", "fosikust plumbers trelomand", "", home)])
    m = spark.createDataFrame([], "row_ordinal long, source1_entity_id string, matched_entity_ids string")
    out = entity_matching.match_entities(r, p, m, alias(spark)).collect()
    assert {(x[0], x[1]) for x in out if x[2] == entity_matching.RULES[0]} == {("S1-1", "S2-1"), ("S1-2", "S2-2")}
    assert {(x[0], x[1]) for x in out if x[2] == entity_matching.RULES[2]} == {("S1-1", "S2-3"), ("S1-2", "S2-3")}  # a word in common resolves only what is left
    rules = {}
    for x in out:
        rules.setdefault(x[1], set()).add(x[2])
    assert all(len(v) == 1 for v in rules.values())


def test_house_number_needs_the_street(spark):
    r = records(spark, [("S1-1", "fosikust mubrajeth plumbers", "12 zozumix road, pafalpatti 15677")])
    p = pool(spark, [("S2-1", "fosikust mubrajeth plumbers", "", "12 telorand road, dilotown 88412"), ("S2-2", "fosikust mubrajeth plumbers", "", "12 zozumux road 99120")])
    m = spark.createDataFrame([], "row_ordinal long, source1_entity_id string, matched_entity_ids string")
    assert {(x[0], x[1], x[2]) for x in entity_matching.match_entities(r, p, m, alias(spark)).collect()} == {("S1-1", "S2-2", entity_matching.RULES[3])}


def test_matches_and_confidence(spark):
    r = records(spark, [("S1-1", "fosikust mubrajeth plumbers ltd", "438 zozumix road, pafalpatti 15677"), ("S1-2", "fosikust mubrajeth plumbing", "12 other lane, elsewhere 99999"), ("S1-3", None, "7 lone road, lonetown 11111"), ("S1-4", "kolupart nizagrom foods", None)])
    p = pool(spark, [("S2-1", "mubrajeth fosikust plmbg", "", "438 zozumix rd pafalpatti 15677"), ("S2-2", "velatrist hupogand mart", "", "7 lone road, lonetown 11111"), ("S3-1", "kolupart nizagrom food", "", "9 some lane, sometown 22222"), ("S3-2", "", "", "")])
    m = spark.createDataFrame([(0, "S1-1", "S2-1")], "row_ordinal long, source1_entity_id string, matched_entity_ids string")
    out = entity_matching.match_entities(r, p, m, alias(spark))
    got = {(x[0], x[1]): (x[2], round(x[3], 3)) for x in out.collect()}
    assert got == {
        ("S1-1", "S2-1"): (entity_matching.RULES[0], 0.667), ("S1-3", "S2-2"): (entity_matching.RULES[4], 0.5), ("S1-4", "S3-1"): (entity_matching.RULES[5], 0.5),
    }
    assert {x[0] for x in entity_matching.unmatched_records(out, m).collect()} == {"S1-3", "S1-4"}
    assert entity_matching.match_entities(r.limit(0), p.limit(0), m.limit(0), alias(spark).limit(0)).count() == 0


def test_pairs_of_a_sliced_group(spark):
    df = spark.range(2500).selectExpr("'g' AS g", "lpad(id, 5, '0') AS m")
    out = pairs_within(df, "g", "m", "a", "b")
    assert out.count() == 2500 * 2499 // 2 == out.distinct().count()


def test_all_names_of_a_row_are_one_organisation_and_one_is_marked(spark):
    r = records(spark, [("S1-1", "kolupart nizagrom foods dba velatrist hupogand mart", ""), ("S1-2", "velatrist hupogand mart", ""), ("S1-3", "fosikust mubrajeth trelomand plumbers", "")])
    scratch = Scratch(spark, "marked")
    out = name_links.organisations(scratch.write(name_links.named_rows(r, pool(spark, []))), scratch)[0].collect()
    assert sorted(x["entity_id"] for x in out) == ["S1-1", "S1-1", "S1-2", "S1-3"] and sorted(x["entity_id"] for x in out if x["first"]) == ["S1-1", "S1-2", "S1-3"]
    assert len({x["org"] for x in out if x["entity_id"] != "S1-3"}) == 1


def test_counts_of_names_of_any_length(spark):
    names = ["bralotis nemugard", "bralotis", "nemugard bralotis trelomand", "zozumix"]
    rows = name_links.with_word_counts(spark.createDataFrame([(n, 1) for n in names], "family string, support long")).collect()
    count = {"bralotis": 3, "nemugard": 2, "trelomand": 1, "zozumix": 1}
    assert {r["family"]: (r["words"], r["counts"]) for r in rows} == {n: (n.split(), [count[w] for w in n.split()]) for n in names}


def test_pairs_need_no_known_matches(spark):
    home = "438 zozumix road, pafalpatti 15677"
    found = entity_matching.match_pairs(records(spark, [("S1-1", "fosikust mubrajeth plumbers", home)]), pool(spark, [("S2-1", "mubrajeth fosikust plmbg", "", home)]), alias(spark))
    assert [tuple(x) for x in found.collect()] == [("S1-1", "S2-1", 0)]
