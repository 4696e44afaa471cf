"""Addresses written differently: which rows denote the same building or plot."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from linkweave.llm.addresses import Address, parse_address
from linkweave.llm.pairing import pairs_within
from linkweave.plans.lineage import Scratch

#: Letters that may differ between two spellings of a street, a place or a landmark.
SLIPS = 2
#: A spelling or postcode of a street counts as a slip if it is more than this many times rarer than the usual one.
RARER = 5
#: Letters of a word that helps to tell a place, at least.
PLACE_LETTERS = 3


@pandas_udf(T.StringType())
def _parsed(address: pd.Series, landmark: pd.Series) -> pd.Series:
    return pd.Series(["\t".join(parse_address(a, b, PLACE_LETTERS)) for a, b in zip(address, landmark)], dtype="object")


def parse_addresses(address: str, landmark: str) -> Column:
    """The parts of an address as an array in the order of Address, with places of PLACE_LETTERS and more. They cross from Python as one text, which is far cheaper than a struct."""
    return F.split(_parsed(address, landmark), "\t")


def region_key(c: str) -> Column:
    return F.lower(F.trim(c))


def addressed_rows(records: DataFrame, pool: DataFrame, alias: DataFrame) -> DataFrame:
    """(entity_id, region, number, street, kind, postcode, landmark, places): the address parts of each row, of repeated deliveries too; places as words joined by spaces.

    region: the country that alias (alias_name, country; one row per way to write a country) lists for what is written, '' if none. Rows without any part are left out.
    """
    texts = records.select("entity_id", F.col("business_address_norm").alias("address"), F.lit(None).cast("string").alias("landmark"), F.col("country_norm").alias("written")).unionByName(
        pool.select("entity_id", "address", "landmark", F.col("country").alias("written"))
    )
    names = alias.where("alias_name IS NOT NULL AND country IS NOT NULL").groupBy(region_key("alias_name").alias("_key")).agg(F.min("country").alias("region"))
    known = texts.where("entity_id IS NOT NULL").join(F.broadcast(names), region_key("written") == F.col("_key"), "left")  # as long as the list of country names
    parts = known.select("entity_id", F.coalesce("region", F.lit("")).alias("region"), parse_addresses("address", "landmark").alias("p"))
    rows = parts.select("entity_id", "region", *(F.get("p", F.lit(k)).alias(c) for k, c in enumerate(Address._fields)))
    return rows.where("street <> '' OR landmark <> ''")


def _near(a: str, b: str) -> Column:
    """At most SLIPS letters differ, and at most one in short words."""
    d = F.levenshtein(a, b, SLIPS)
    return (d >= 0) & ((d < 2) | (F.least(F.length(a), F.length(b)) >= 6))


def _compatible(a: Column, b: Column) -> Column:
    """Regions that can be one: equal, or one is missing and inherits the other."""
    return (a == b) | (a == "") | (b == "")


def _masked(code: Column) -> Column:
    """code with each character left out in turn, and whole: two codes that differ by one character less, more or other share one of these."""
    return F.array_distinct(F.concat(F.array(code), F.transform(F.sequence(F.lit(1), F.length(code)), lambda i: F.concat(F.left(code, i - 1), F.substr(code, i + 1)))))


def _words(c: str) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def house_forms(houses: DataFrame) -> DataFrame:
    """(id, written, region, postcode, street, places, n): each distinct way to write a street, with the rows that do; must be written before its ids are used.

    written is the region as given. region is the same, but where it is missing and all others who write the rest alike give one region, it is that.
    """
    same = houses.groupBy("postcode", "street", "places", F.col("region").alias("written")).agg(F.count(F.lit(1)).alias("n"))
    regions = same.groupBy("postcode", "street", "places").agg(F.collect_list(F.struct("written", "n")).alias("w"))  # one per region
    given = F.filter("w", lambda x: x["written"] != "")
    only = F.when(F.size(given) == 1, F.get(given, F.lit(0))["written"])
    forms = regions.select("postcode", "street", "places", only.alias("only"), F.inline("w"))
    region = F.when(F.col("written") == "", F.coalesce("only", F.lit(""))).otherwise(F.col("written"))
    return forms.select(F.monotonically_increasing_id().alias("id"), "written", region.alias("region"), "postcode", "street", "places", "n")


def street_gazetteer(forms: DataFrame) -> DataFrame:
    """(region, postcode, street, n): the streets of each postcode that two rows or more give, where that is no slip of the postcode.

    From the most frequent spelling on, each one that is no slip of a street already kept in a region compatible with its own is a street; spellings whose region is missing come last. Besides the
    most frequent one a street counts if two rows or more give it, slips included. A postcode that is RARER times rarer than another one of the same street name is taken for a slip if it differs by one character.
    """
    named = forms.where("postcode <> ''").groupBy("region", "postcode", "street").agg(F.sum("n").alias("n"))
    spelling = F.struct((F.col("region") != "").alias("known"), "n", "street", "region")
    per_code = named.groupBy("postcode").agg(F.sort_array(F.collect_list(spelling), asc=False).alias("spellings"), F.sum("n").alias("m")).where("m > 1")  # the spellings of one postcode
    none = F.filter("spellings", lambda x: F.lit(False))
    slip_of = lambda k, x: _near(k["street"], x["street"]) & _compatible(k["region"], x["region"])
    apart = F.aggregate("spellings", none, lambda kept, x: F.when(F.exists(kept, lambda k: slip_of(k, x)), kept).otherwise(F.concat(kept, F.array(x))))
    slips = lambda k: F.exists("spellings", lambda x: ((x["street"] != k["street"]) | (x["region"] != k["region"])) & slip_of(x, k))
    streets = F.filter(F.col("apart"), lambda k, i: (i == 0) | (k["n"] > 1) | slips(k))
    top = per_code.withColumn("apart", apart).select("postcode", F.explode(streets).alias("t")).select("t.region", "postcode", "t.street", "t.n")
    best = top.groupBy("region", "street").agg(F.max(F.struct("n", "postcode")).alias("b"))
    slip = (F.col("n") * RARER <= F.col("b.n")) & (F.levenshtein("postcode", F.col("b.postcode"), 1) >= 0)
    return top.join(best, ["region", "street"]).where(~slip).select("region", "postcode", "street", "n")


def resolve_forms(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """forms (of house_forms, written) plus at: the street they mean as 'region|postcode|street', and candidates: how many streets were possible.

    Top down: the region, in it the locality by postcode, in it the street. A level that is missing or matches nothing hands on the candidates of the level above: first the streets of the
    postcode, of which the one nearest to what is written is taken; then the streets of that name in a postcode that differs by one character; without a postcode those of a place that the row
    names, then the only one of that name; then streets with a name that is nearly the same, by the same postcodes and places. Of several candidates those that share most place words with the row are left; where
    that is more than one, none is chosen, and the form keeps a street of its own, named by what is written.
    """
    gazetteer = scratch.write(street_gazetteer(forms))
    street_at = F.concat_ws("|", "region", "postcode", "street").alias("at")
    # the postcode's own streets, together in one row, so that the join keeps the number of rows
    g = gazetteer.groupBy("postcode").agg(F.collect_list(F.struct("region", "street")).alias("_streets"))
    possible = F.filter("_streets", lambda g: _near(F.col("street"), g["street"]) & _compatible(F.col("region"), g["region"]))
    near = F.transform(possible, lambda g: F.struct(F.levenshtein(F.col("street"), g["street"]).alias("d"), g["street"].alias("street"), g["region"].alias("region")))
    nearest = F.filter("_near", lambda x: x["d"] == F.array_min("_near")["d"])
    one = F.get("_nearest", F.lit(0))
    at = F.when(F.size("_nearest") == 1, F.concat_ws("|", one["region"], "postcode", one["street"]))
    first = forms.join(g, "postcode", "left").withColumn("_near", near).withColumn("_nearest", nearest).withColumn("at", at)
    first = scratch.write(first.withColumn("candidates", F.coalesce(F.size("_nearest"), F.lit(0))).drop("_streets", "_near", "_nearest"))
    asked = scratch.write(first.where("at IS NULL").select("id", "region", "postcode", "street", "places"))
    # the words written with each street, without those seldom written
    towns = first.where("at IS NOT NULL").select("at", "n", F.explode(_words("places")).alias("place")).groupBy("at", "place").agg(F.sum("n").alias("n"))
    usual = towns.join(towns.groupBy("at").agg(F.max("n").alias("m")), "at").where(F.col("n") * RARER >= F.col("m"))
    usual = scratch.write(usual.select("at", "place", *(F.get(F.split("at", r"\|"), F.lit(k)).alias(f"g_{c}") for k, c in enumerate(("region", "postcode", "street")))))
    streets = gazetteer.select(street_at, *(F.col(c).alias(f"g_{c}") for c in ("region", "postcode", "street")))
    fits = _compatible(F.col("region"), F.col("g_region"))
    coded, bare = asked.where("postcode <> ''"), asked.where("postcode = ''")
    # the same name: in a postcode like the one written, at a place that is named, or nowhere else
    by_code = coded.withColumn("mask", F.explode(_masked(F.col("postcode")))).join(streets.withColumn("mask", F.explode(_masked(F.col("g_postcode")))), "mask")
    by_code = by_code.where(fits & (F.levenshtein("postcode", "g_postcode", 1) >= 0))
    named = by_code.where("street = g_street").select("id", "at").distinct()
    placed = bare.withColumn("place", F.explode(_words("places"))).join(usual.withColumn("street", F.col("g_street")), ["place", "street"]).where(fits).select("id", "at")
    only = streets.groupBy(F.col("g_street").alias("street")).agg(F.collect_set("g_region").alias("_r"), F.min("at").alias("at"), F.count(F.lit(1)).alias("_n")).where("_n = 1")
    lone = bare.join(only, "street").where(_compatible(F.col("region"), F.get("_r", F.lit(0)))).select("id", "at")
    by_name = scratch.write(named.unionByName(placed).unionByName(lone).distinct())
    # nearly the same name: by postcode, or by place and the start or the end of the name
    unnamed = lambda df: df.join(by_name.select("id").distinct(), "id", "left_anti")
    ends = lambda c: F.array_distinct(F.array(F.left(c, F.lit(3)), F.right(c, F.lit(3))))
    like = _near("street", "g_street")
    near_code = unnamed(by_code.where(like).select("id", "at").distinct())
    at_place = unnamed(bare).withColumns({"place": F.explode(_words("places"))}).withColumn("end", F.explode(ends(F.col("street"))))
    index = usual.withColumn("end", F.explode(ends(F.col("g_street"))))
    near_place = at_place.join(index, ["place", "end"]).where(like & fits).select("id", "at").distinct()
    candidates = scratch.write(by_name.unionByName(near_code).unionByName(near_place))
    votes = candidates.join(asked.select("id", F.explode(_words("places")).alias("place")), "id").join(usual, ["at", "place"]).groupBy("id", "at").agg(F.count(F.lit(1)).alias("votes"))
    weighed = candidates.join(votes, ["id", "at"], "left").select("id", F.struct(F.coalesce("votes", F.lit(0)).alias("votes"), "at").alias("v"))
    best = weighed.groupBy("id").agg(F.max("v").alias("b"), F.max(F.col("v.votes")).alias("most"), F.collect_list(F.col("v.votes")).alias("all"))  # the candidates of one form
    chosen = best.select("id", F.col("b.at").alias("_at"), F.size(F.filter("all", lambda x: x == F.col("most"))).alias("_left"), F.size("all").alias("_all"))
    own = F.concat_ws("|", "region", "postcode", "street", F.when(F.col("postcode") == "", F.array_join(F.array_sort(_words("places")), " ")))
    settled = first.where("at IS NULL").drop("at").join(chosen, "id", "left")
    settled = settled.withColumns({"at": F.coalesce(F.when(F.col("_left") == 1, F.col("_at")), own), "candidates": F.coalesce("_all", "candidates")}).drop("_at", "_left", "_all")
    out = scratch.write(first.where("at IS NOT NULL").unionByName(settled))
    for done in (gazetteer, first, asked, usual, by_name, candidates):
        scratch.drop(done)
    return out


def resolve_locations(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity_id, location, candidates): one location of each addressed id, 'region|postcode|street|type|number' or, for a landmark that no row gives an address for, its own; candidates: how many were possible.

    Below the street come its type and the house number with its letter, which must be equal; units, floors and shops are not looked at. A row that
    gives only a landmark inherits the houses that other rows of its region give with it, by postcode and else by place; if that is more than one house, the row
    stays with the landmark. Of several deliveries of an id the one that was placed with the fewest open candidates counts, houses before landmarks.
    """
    rows = scratch.write(rows)
    street_rows = rows.where("street <> '' AND number <> ''")
    forms = scratch.write(house_forms(street_rows))
    resolved = resolve_forms(forms, scratch)
    by_form = resolved.select(F.col("written").alias("region"), "postcode", "street", "places", "at", "candidates")
    placed = street_rows.join(by_form, ["postcode", "street", "places", "region"])
    houses = scratch.write(placed.select("entity_id", F.concat_ws("|", "at", "kind", "number").alias("location"), "candidates", "landmark", "places"))
    for done in (forms, resolved):
        scratch.drop(done)
    marks = rows.where("number = '' AND landmark <> ''").select("entity_id", "region", "postcode", F.col("landmark").alias("mark"), "places")
    spots = scratch.write(marks.select("region", "postcode", "mark", "places").distinct().withColumn("id", F.monotonically_increasing_id()))
    part = lambda k: F.get(F.split("location", r"\|"), F.lit(k))
    known = houses.where("landmark <> ''").select("landmark", "location", "places", part(0).alias("g_region"), part(1).alias("postcode"))
    key = lambda c: F.substring_index(c, " ", -1)  # the kind of landmark, which is rarely misspelt
    fits = _compatible(F.col("region"), F.col("g_region")) & _near("mark", "landmark")
    by_code = known.where("postcode <> ''").select("postcode", "landmark", "location", "g_region").distinct()
    one = spots.where("postcode <> ''").join(by_code, "postcode").where(fits).select("id", "location").distinct()
    by_place = known.select("landmark", "location", "g_region", F.explode(_words("places")).alias("place")).withColumn("end", key(F.col("landmark"))).distinct()
    rest = spots.join(one.select("id").distinct(), "id", "left_anti").select("id", "region", "mark", F.explode(_words("places")).alias("place"), key(F.col("mark")).alias("end"))
    shared = rest.join(by_place, ["place", "end"]).where(fits).groupBy("id", "location").agg(F.count_distinct("place").alias("votes"))
    best = shared.withColumn("_r", F.rank().over(Window.partitionBy("id").orderBy(F.desc("votes")))).where("_r = 1").select("id", "location")
    inherited = one.unionByName(best).groupBy("id").agg(F.min("location").alias("location"), F.count(F.lit(1)).cast("int").alias("candidates"))
    own = F.concat_ws("|", F.lit("landmark"), "region", "postcode", "mark", F.array_join(F.array_sort(_words("places")), " "))
    located = spots.join(inherited, "id", "left").select("region", "postcode", "mark", "places", F.when(F.col("candidates") == 1, F.col("location")).otherwise(own).alias("location"), F.coalesce("candidates", F.lit(0)).alias("candidates"))
    only = marks.join(located, ["region", "postcode", "mark", "places"]).select("entity_id", "location", "candidates")
    order = F.struct(F.col("location").startswith("landmark|"), F.when(F.col("candidates") == 0, 1 << 30).otherwise(F.col("candidates")), "location")
    every = houses.select("entity_id", "location", "candidates").unionByName(only).withColumn("_o", order)
    before = F.lag(F.lit(1)).over(Window.partitionBy("entity_id").orderBy("_o", "candidates"))  # most ids have one delivery, so nothing is gained by aggregating, or cutting groups, before the shuffle
    out = scratch.write(every.withColumn("_before", before).where("_before IS NULL").select("entity_id", "location", "candidates"))
    for done in (rows, houses, spots):
        scratch.drop(done)
    return out


def same_location_pairs(records: DataFrame, pool: DataFrame, alias: DataFrame) -> DataFrame:
    """(entity_id_a, entity_id_b) of the rows of both tables whose addresses denote the same building or plot, smaller id first.

    alias: of addressed_rows. Rows without an address are in no pair; repeated deliveries of an id count as one row; empty tables give none.
    """
    scratch = Scratch(records.sparkSession, "locations")
    located = resolve_locations(addressed_rows(records, pool, alias), scratch)  # one location per id, so no pair comes twice
    return pairs_within(located.select("location", "entity_id"), "location", "entity_id", "entity_id_a", "entity_id_b")
