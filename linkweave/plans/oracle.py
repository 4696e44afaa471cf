"""The queries as SQL, written apart from the DataFrame code: own regular expressions (RE2) and own formulas."""

from __future__ import annotations

from linkweave import config as cfg
from linkweave.sources.derived import SQL as DERIVED

_SPECIAL = ".+*?()[]{}|^$\\/"


def _esc(word: str) -> str:
    return "".join(f"\\{c}" if c in _SPECIAL else c for c in word)


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ordered(rules: dict[str, str]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for n in sorted({len(k) for k in rules}, reverse=True):
        out += [(k, v) for k, v in rules.items() if len(k) == n]
    return out


def _name_norm(c: str) -> str:
    e = f"regexp_replace(lower(trim(coalesce({c}, ''))), '[/\\\\|_\\[\\]{{}}<>]+', ' ', 'g')"
    e = f"regexp_replace({e}, '\\s*&\\s*', ' and ', 'g')"
    for k, v in _ordered(cfg.LEGAL_FORMS):
        e = f"regexp_replace({e}, {_lit(rf'\b{_esc(k)}([^a-z0-9]|$)')}, {_lit(v + chr(92) + '1')}, 'g')"
    return f"trim(regexp_replace({e}, '\\s\\s+', ' ', 'g'))"


def _words(c: str, rules: dict[str, str]) -> str:
    for k, v in _ordered(rules):
        c = f"regexp_replace({c}, {_lit(rf'\b{_esc(k)}\b')}, {_lit(v)}, 'g')"
    return c


def _address_norm(addr: str, country: str) -> str:
    a = f"lower(trim(coalesce({addr}, '')))"
    own = f"CASE lower({country}) WHEN 'us' THEN {_words(a, cfg.ADDRESS_WORDS['us'])} WHEN 'india' THEN {_words(a, cfg.ADDRESS_WORDS['india'])} ELSE {a} END"
    e = f"regexp_replace({_words(own, cfg.ADDRESS_WORDS['generic'])}, '[/\\\\|_\\[\\]{{}}<>]+', ' ', 'g')"
    return f"trim(regexp_replace({e}, '\\s\\s+', ' ', 'g'))"


_FORMS = "enterprises|enterprise|pvt ltd|assoc|group|corp|inc|ltd|pvt|llc|llp|lp|co"
_CORE = rf"\s+({_FORMS})(\s+({_FORMS}))*\s*$"
_LANDMARK = r"(?i)\b(?:near|nr\.?|adj(?:acent)?(?:\s+to)?|opp(?:osite)?|behind|beside|next\s+to|in\s+front\s+of|landmark\s*[:–\-])\s+[A-Za-z][\w\s,\.]{3,60}"
_TITLE = "array_to_string(list_transform(regexp_extract_all(trim(coalesce(country, '')), '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '')"


def _alt(c: str) -> str:
    out = "NULL"
    for p in reversed(("dba", "t/a", r"trading\s+as", "ta", r"also\s+known\s+as", "aka")):
        pat = _lit(rf"(?i)\b{p}\b\s*(.+?)(?:\s*,|\s*$)")
        out = f"CASE WHEN regexp_matches({c}, {pat}) THEN regexp_extract({c}, {pat}, 1) ELSE {out} END"
    return f"nullif(trim({out}), '')"


def _clean(n: int) -> str:
    return f"""
c{n}a AS (SELECT *, {_TITLE} AS country_norm, {_name_norm('business_name')} AS business_name_norm FROM raw_source{n}),
clean{n} AS (SELECT *, coalesce(nullif(trim(regexp_replace(business_name_norm, {_lit(_CORE)}, '')), ''), business_name_norm) AS business_name_core,
  {_alt('business_name')} AS business_name_alt, {_address_norm('business_address', 'country_norm')} AS business_address_norm,
  nullif(trim(regexp_extract(business_address, {_lit(_LANDMARK)}, 0)), '') AS business_address_landmark FROM c{n}a)"""


_NULLS = ", ".join(_lit(x) for x in cfg.NULLS_POOL)


def _pooled(n: int) -> str:
    v = lambda c: f"lower(trim(CASE WHEN {c} IS NULL OR {c} IN ({_NULLS}) THEN '' ELSE {c} END))"
    return f"""SELECT trim(coalesce(entity_id, '')) AS entity_id, 'S{n}' AS source, {v('country_norm')} AS country, {v('business_name_norm')} AS name,
 {v('business_name_core')} AS name_core, {v('business_name_alt')} AS name_alt, {v('business_address_norm')} AS address, {v('business_address_landmark')} AS landmark FROM clean{n}"""


_STOP = ", ".join(_lit(w) for w in cfg.ADDRESS_STOP_WORDS)
#: The first six distinct long words of an address, in order.
_WORDS6 = f"""list_transform(list_sort(list_transform(list_distinct(list_filter(regexp_extract_all(address, '[a-z]+'), lambda w: length(w) >= 4 AND w NOT IN ({_STOP}))),
 lambda w: {{'p': list_position(regexp_extract_all(address, '[a-z]+'), w), 'w': w}})), lambda s: s.w)[1:6]"""
_NUMS = "regexp_extract_all(address, '\\b\\d+\\b')"
_PIN = f"list_transform(list_filter({_NUMS}, lambda n: length(n) = 6), lambda n: 'pin|' || n)"
_FIRST = f"coalesce(nullif(ltrim(coalesce({_NUMS}[1], ''), '0'), ''), '0')"
_ANCHOR = "(list_sort(list_transform(list_filter(regexp_extract_all({0}, '[a-z0-9]+'), lambda t: length(t) >= 5), lambda t: {{'l': -length(t), 't': t}}))[1]).t"

_V = {
    **{k: f"{k} AS ({s.replace('{part}', 'part')})" for k, s in DERIVED.items()},
    "clean1": _clean(1).strip(),
    "clean2": _clean(2).strip(),
    "clean3": _clean(3).strip(),
    "pool0": f"pool0 AS ({_pooled(2)} UNION ALL {_pooled(3)})",
    "q": """q AS (SELECT ordinal AS row_id, lower(trim(country_norm)) AS country, lower(trim(business_name_norm)) AS name, lower(trim(business_name_core)) AS core,
 lower(trim(coalesce(business_name_alt, ''))) AS alt, lower(trim(business_address_norm)) AS address FROM clean1 WHERE trim(country_norm) <> '')""",
    "akeys": f"""akeys AS (SELECT DISTINCT country, unnest(list_concat(list_transform({_WORDS6}, lambda w: {_FIRST} || '|' || w), {_PIN})) AS key, entity_id FROM pool0)""",
    "qkeys": f"""qkeys AS (SELECT DISTINCT row_id, country, unnest(list_concat(CASE WHEN len({_NUMS}) > 0 THEN list_transform({_WORDS6}, lambda w: {_FIRST} || '|' || w) ELSE [] END, {_PIN})) AS key FROM q)""",
    "anchors": f"anchors AS (SELECT DISTINCT country, a AS anchor, entity_id FROM (SELECT country, entity_id, {_ANCHOR.format('coalesce(nullif(name_core, chr(0)[1:0]), name)')} AS a FROM pool0) WHERE a IS NOT NULL)",
    "ids": """ids AS (SELECT trim(entity_id) AS entity_id, arg_min(country_norm, ordinal) AS country_norm FROM clean1 WHERE trim(entity_id) <> '' GROUP BY 1)""",
    "classed": r"""classed AS (SELECT g.*, CASE WHEN matched_entity_ids IS NULL OR trim(matched_entity_ids) = '' THEN 'singleton'
 WHEN len(list_filter(string_split(matched_entity_ids, ','), lambda t: NOT regexp_full_match(trim(t), '(S2|S3)-\d+'))) = 0 THEN 'matched' ELSE 'malformed' END AS row_type,
 i.entity_id IS NULL AS missing_from_source1 FROM ground_truth g LEFT JOIN ids i ON g.source1_entity_id = i.entity_id)""",
    "strata": """strata AS (SELECT c.*, i.country_norm, lower(i.country_norm) || '::' || row_type AS stratum FROM classed c JOIN ids i ON c.source1_entity_id = i.entity_id WHERE row_type <> 'malformed')""",
    "split": """split AS (SELECT *, CASE WHEN rn <= CASE WHEN n < 10 THEN 0 ELSE round_even(n * 0.15, 0) END THEN 'val' ELSE 'train' END AS split FROM (SELECT *, count(*) OVER (PARTITION BY stratum) AS n,
 row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || source1_entity_id || ':' || coalesce(matched_entity_ids, '')), source1_entity_id) AS rn FROM strata))""",
    "splits": "splits AS (SELECT DISTINCT source1_entity_id, split FROM split)",
    "truth": "truth AS (SELECT DISTINCT source1_entity_id, t AS candidate_entity_id FROM (SELECT source1_entity_id, unnest(string_split(matched_entity_ids, ',')) AS t FROM ground_truth) WHERE trim(t) <> '')",
    "tokens": "tokens AS (SELECT source1_entity_id, split, unnest(string_split(candidate_entity_ids, ',')) AS candidate_entity_id FROM candidates JOIN splits USING (source1_entity_id) WHERE coalesce(candidate_entity_ids, '') <> '')",
    "labeled": """labeled AS (SELECT DISTINCT k.source1_entity_id, k.candidate_entity_id, k.split, left(k.candidate_entity_id, 2) AS source, CAST(t.source1_entity_id IS NOT NULL AS INT) AS label
 FROM tokens k LEFT JOIN truth t ON k.source1_entity_id = t.source1_entity_id AND k.candidate_entity_id = t.candidate_entity_id WHERE k.candidate_entity_id LIKE 'S2-%' OR k.candidate_entity_id LIKE 'S3-%')""",
}
_V["anchors"] = _V["anchors"].replace("chr(0)[1:0]", "''")
_NEEDS = {
    "clean1": ["raw_source1"], "clean2": ["raw_source2"], "clean3": ["raw_source3"], "pool0": ["clean2", "clean3"], "q": ["clean1"],
    "akeys": ["pool0"], "qkeys": ["q"], "anchors": ["pool0"], "ids": ["clean1"], "classed": ["ground_truth", "ids"], "strata": ["classed"],
    "split": ["strata"], "splits": ["split"], "truth": ["ground_truth"], "tokens": ["candidates", "splits"], "labeled": ["tokens", "truth"],
}


def _with(needs: str, body: str, more: str = "", recursive: bool = False) -> str:
    order: list[str] = []

    def add(v: str) -> None:
        for x in _NEEDS.get(v, []):
            add(x)
        if v not in order:
            order.append(v)

    for v in needs.split():
        add(v)
    parts = [_V[v] for v in order] + ([more] if more else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


def _capped(key: str, column: str, limit: int) -> str:
    return f"""SELECT row_id, p.entity_id FROM q JOIN (SELECT country, {column} AS v, entity_id, row_number() OVER (PARTITION BY country, {column} ORDER BY entity_id) AS r
 FROM pool0 WHERE {column} <> '') p ON q.country = p.country AND q.{key} = p.v AND r <= {limit} WHERE q.{key} <> ''"""


_PREFIX = """SELECT row_id, entity_id FROM (SELECT q.row_id, p.entity_id, row_number() OVER (PARTITION BY q.row_id ORDER BY p.entity_id) AS r
 FROM q JOIN pool0 p ON q.country = p.country AND left(q.name, 5) = left(p.name, length(left(q.name, 5))) WHERE length(q.name) >= 3) WHERE r <= 50"""
_ANCHORED = """SELECT row_id, entity_id FROM (SELECT q.row_id, a.entity_id, row_number() OVER (PARTITION BY q.row_id ORDER BY a.entity_id) AS r
 FROM (SELECT *, {0} AS anchor FROM q WHERE length(name) >= 3) q JOIN anchors a ON q.country = a.country AND q.anchor = a.anchor) WHERE r <= 50""".format(
    _ANCHOR.format("coalesce(nullif(core, ''), name)")
)
_ADDRESS_KEYS = "SELECT DISTINCT row_id, entity_id FROM qkeys JOIN akeys USING (country, key) JOIN (SELECT country, key FROM akeys GROUP BY 1, 2 HAVING count(*) <= {0}) USING (country, key)"
_MERGED = f"""rows AS (SELECT row_id, entity_id, min(s) AS strategy FROM (SELECT *, 0 AS s FROM ({_capped('name', 'name', 100)}) UNION ALL SELECT *, 1 FROM ({_capped('core', 'name_core', 100)})
 UNION ALL SELECT *, 1 FROM ({_capped('alt', 'name_alt', 100)}) UNION ALL SELECT *, 2 FROM ({_capped('address', 'address', 100)}) UNION ALL SELECT *, 3 FROM ({_ADDRESS_KEYS.format(200)})) GROUP BY 1, 2),
 merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY strategy, entity_id) AS rank FROM rows) WHERE rank <= 20),
 lists AS (SELECT ordinal AS row_id, any_value(c.entity_id) AS source1_entity_id, coalesce(string_agg(m.entity_id, ',' ORDER BY rank), '') AS candidate_entity_ids, count(m.entity_id) AS n_candidates
 FROM clean1 c LEFT JOIN merged m ON c.ordinal = m.row_id GROUP BY 1)"""

#: Longest common subsequences of the distinct pairs (a, b) in want, as a table lcs(a, b, n): one step per character of a.
_LCS = """step(a, b, i, row) AS (SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda x: 0) FROM want UNION ALL
 SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc, CASE WHEN a[i + 1] = b[j] THEN row[j] + 1 ELSE greatest(row[j + 1], acc[-1]) END), [CAST(0 AS BIGINT)])
 FROM step WHERE i < length(a)), lcs AS (SELECT a, b, row[-1] AS n FROM step WHERE i = length(a))"""
_NAMES = """names AS (SELECT l.source1_entity_id, l.candidate_entity_id, lower(trim(c.business_name_norm)) AS a, p.name AS b FROM labeled l JOIN clean1 c ON l.source1_entity_id = c.entity_id JOIN pool0 p ON l.candidate_entity_id = p.entity_id)"""
_SETS = f"""{_NAMES}, sets AS (SELECT *, list_sort(list_intersect(ta, tb)) AS ti, list_sort(list_filter(ta, lambda x: NOT list_contains(tb, x))) AS da, list_sort(list_filter(tb, lambda x: NOT list_contains(ta, x))) AS db
 FROM (SELECT *, list_distinct(list_filter(string_split(a, ' '), lambda x: x <> '')) AS ta, list_distinct(list_filter(string_split(b, ' '), lambda x: x <> '')) AS tb FROM names)),
 parts AS (SELECT *, array_to_string(da, ' ') AS ra, array_to_string(db, ' ') AS rb, length(array_to_string(ti, ' ')) AS sect FROM sets), want AS (SELECT DISTINCT ra AS a, rb AS b FROM parts), {_LCS},
 sized AS (SELECT p.*, l.n, CASE WHEN sect > 0 THEN 1 ELSE 0 END AS s, length(ra) AS la, length(rb) AS lb FROM parts p JOIN lcs l ON p.ra = l.a AND p.rb = l.b)"""

_FEATURES = f"""f AS (SELECT l.*, c.entity_id IS NULL AS missing_source1, p.entity_id IS NULL AS missing_candidate, coalesce(c.business_name_norm, '') AS n1, coalesce(p.name, '') AS n2,
 coalesce(c.business_address_norm, '') AS a1, coalesce(p.address, '') AS a2, lower(coalesce(c.country_norm, '')) AS k1, coalesce(p.country, '') AS k2
 FROM labeled l LEFT JOIN clean1 c ON l.source1_entity_id = c.entity_id LEFT JOIN pool0 p ON l.candidate_entity_id = p.entity_id)"""

_BARE = "upper(trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)))"
#: A record id in plain form, null where the value denotes no record.
_PLAIN = rf"""CASE WHEN regexp_full_match({_BARE}, 'S[123][-_ –]+[0-9]+(\.0*)?') THEN 'S' || regexp_extract({_BARE}, 'S([123])', 1) || '-' || regexp_extract({_BARE}, 'S[123][-_ –]+0*([0-9]+)', 1) END"""
_JUDGED = f"""judged AS (SELECT DISTINCT {_PLAIN.format('source1_entity_id')} AS s, {_PLAIN.format('candidate_entity_id')} AS c FROM train_pairs),
 first AS (SELECT entity_id, arg_min(struct_pack(n := business_name_norm), row_ordinal).n AS n FROM records GROUP BY 1),
 t AS (SELECT s, c, coalesce(first.n, '') AS x, coalesce(pool.name, '') AS y FROM judged JOIN first ON s = first.entity_id JOIN pool ON c = pool.entity_id), want AS (SELECT DISTINCT x AS a, y AS b FROM t WHERE x <> '' AND y <> '')"""

_DEFAULT = cfg.CandidateConfig()
_BLOCKS = f"""blocks AS (SELECT row_id, entity_id FROM (SELECT q.row_id, p.entity_id, row_number() OVER (PARTITION BY q.row_id ORDER BY p.entity_id) AS r
 FROM q JOIN pool0 p ON q.country = p.country AND left(q.name, {_DEFAULT.fuzzy_prefix_length}) = left(p.name, length(left(q.name, {_DEFAULT.fuzzy_prefix_length}))) WHERE length(q.name) >= 3) WHERE r <= {_DEFAULT.fuzzy_block_limit} UNION
 SELECT row_id, entity_id FROM (SELECT q.row_id, a.entity_id, row_number() OVER (PARTITION BY q.row_id ORDER BY a.entity_id) AS r
 FROM (SELECT *, {_ANCHOR.format("coalesce(nullif(core, ''), name)")} AS anchor FROM q WHERE length(name) >= 3) q JOIN anchors a ON q.country = a.country AND q.anchor = a.anchor) WHERE r <= {_DEFAULT.fuzzy_block_limit})"""
#: Scores of the pairs in blocks: compared texts (x, y) with kind 'r' for ratio on them and 't' for the token sets; only pairs of texts whose lengths allow the threshold are measured.
_FUZZY = f"""{_BLOCKS}, sides AS (SELECT DISTINCT q.name, q.core, p.name AS c_name, p.name_core AS c_core, p.name_alt AS c_alt FROM blocks JOIN q USING (row_id) JOIN pool0 p ON blocks.entity_id = p.entity_id),
 texts AS (SELECT DISTINCT x, y, k FROM (SELECT name AS x, c_name AS y, 'rt' AS k FROM sides UNION ALL SELECT name, c_alt, 't' FROM sides WHERE c_alt <> '' UNION ALL SELECT core, c_core, 'rt' FROM sides WHERE core <> '' AND c_core <> '')),
 sets AS (SELECT *, list_sort(list_intersect(ta, tb)) AS ti, list_sort(list_filter(ta, lambda w: NOT list_contains(tb, w))) AS da, list_sort(list_filter(tb, lambda w: NOT list_contains(ta, w))) AS db
 FROM (SELECT *, list_distinct(list_filter(string_split(x, ' '), lambda w: w <> '')) AS ta, list_distinct(list_filter(string_split(y, ' '), lambda w: w <> '')) AS tb FROM texts)),
 parts AS (SELECT *, array_to_string(da, ' ') AS ra, array_to_string(db, ' ') AS rb, length(array_to_string(ti, ' ')) AS sect FROM sets),
 sized AS (SELECT *, length(x) AS lx, length(y) AS ly, length(ra) AS la, length(rb) AS lb, CASE WHEN sect > 0 THEN 1 ELSE 0 END AS s FROM parts),
 want AS (SELECT x AS a, y AS b FROM sized WHERE k = 'rt' AND 200.0 * least(lx, ly) >= {_DEFAULT.fuzzy_threshold} * (lx + ly) UNION SELECT ra, rb FROM sized WHERE len(ta) > 0 AND len(tb) > 0 AND (200.0 * (sect + s + least(la, lb)) >= {_DEFAULT.fuzzy_threshold} * (2 * (sect + s) + la + lb))),
 {_LCS},
 scored AS (SELECT x, y, max(greatest(CASE WHEN k = 'rt' AND lx + ly = 0 THEN 100.0 WHEN k = 'rt' AND f.n IS NOT NULL THEN 200.0 * f.n / (lx + ly) ELSE 0 END,
 CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN sect > 0 AND (la = 0 OR lb = 0) THEN 100.0 ELSE greatest(CASE WHEN r.n IS NOT NULL THEN 100.0 - 100.0 * (la + lb - 2 * r.n) / (2 * (sect + s) + la + lb) ELSE 0 END,
 CASE WHEN sect > 0 THEN 100.0 - 100.0 * (s + la) / (sect + sect + s + la) ELSE 0 END, CASE WHEN sect > 0 THEN 100.0 - 100.0 * (s + lb) / (sect + sect + s + lb) ELSE 0 END) END)) AS score
 FROM sized LEFT JOIN lcs f ON x = f.a AND y = f.b LEFT JOIN lcs r ON ra = r.a AND rb = r.b GROUP BY 1, 2),
 fuzzy AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, entity_id) AS pos FROM (SELECT b.row_id, b.entity_id, greatest(n.score, coalesce(o.score, 0), coalesce(c.score, 0)) AS score
 FROM blocks b JOIN q USING (row_id) JOIN pool0 p ON b.entity_id = p.entity_id JOIN scored n ON n.x = q.name AND n.y = p.name LEFT JOIN scored o ON p.name_alt <> '' AND o.x = q.name AND o.y = p.name_alt
 LEFT JOIN scored c ON q.core <> '' AND p.name_core <> '' AND c.x = q.core AND c.y = p.name_core) WHERE score >= {_DEFAULT.fuzzy_threshold}) WHERE pos <= {_DEFAULT.fuzzy_top_k})"""
_ALL_FIVE = f"""{_FUZZY}, rows AS (SELECT row_id, entity_id, min(struct_pack(s := s, p := p)) AS o FROM (SELECT *, 0 AS s, 0 AS p FROM ({_capped('name', 'name', _DEFAULT.exact_limit)}) UNION ALL SELECT *, 1, 0 FROM ({_capped('core', 'name_core', _DEFAULT.exact_limit)})
 UNION ALL SELECT *, 1, 0 FROM ({_capped('alt', 'name_alt', _DEFAULT.exact_limit)}) UNION ALL SELECT *, 2, 0 FROM ({_capped('address', 'address', _DEFAULT.exact_limit)}) UNION ALL SELECT *, 3, 0 FROM ({_ADDRESS_KEYS.format(_DEFAULT.address_key_max_frequency)})
 UNION ALL SELECT row_id, entity_id, 4, pos FROM fuzzy) GROUP BY 1, 2),
 merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY o.s, o.p, entity_id) AS rank FROM rows) WHERE rank <= {_DEFAULT.max_candidates}),
 lists AS (SELECT ordinal AS row_id, any_value(c.entity_id) AS source1_entity_id, coalesce(string_agg(m.entity_id, ',' ORDER BY rank), '') AS candidate_entity_ids, count(m.entity_id) AS n_candidates
 FROM clean1 c LEFT JOIN merged m ON c.ordinal = m.row_id GROUP BY 1)"""

ORACLE: dict[str, str] = {
    "q_clean_country": _with("clean1", "SELECT entity_id, country, country_norm FROM clean1"),
    "q_clean_name_norm": _with("clean1", "SELECT entity_id, business_name_norm FROM clean1"),
    "q_name_core": _with("clean1", "SELECT entity_id, business_name_core FROM clean1"),
    "q_name_alt": _with("clean1", "SELECT entity_id, business_name_alt FROM clean1"),
    "q_address_norm": _with("clean1", "SELECT entity_id, business_address_norm FROM clean1"),
    "q_landmark": _with("clean1", "SELECT entity_id, business_address_landmark FROM clean1"),
    "q_quality_counts": _with(
        "clean1",
        r"""SELECT count(*) AS total_rows, count(*) FILTER (entity_id IS NULL) AS null_entity_id, count(*) FILTER (business_name IS NULL) AS null_business_name, count(*) FILTER (business_address IS NULL) AS null_business_address,
 count(*) FILTER (country IS NULL) AS null_country, count(*) FILTER (entity_id IS NULL OR trim(entity_id) = '') AS null_entity_id_count,
 count(*) FILTER (regexp_matches(business_name, '(?i)\b(corp|inc|ltd|pvt|llc|llp|lp|co|assoc|enterprises|enterprise|group)\b')) AS suffix_pattern_matches,
 count(business_name_alt) AS dba_pattern_matches, count(business_address_landmark) AS landmark_pattern_matches FROM clean1""",
    ),
    "q_quality_country_dist": _with("raw_source1", "SELECT coalesce(country, '__null__') AS country, count(*) AS n FROM raw_source1 GROUP BY 1"),
    "q_quality_dup_ids": """SELECT (SELECT count(*) FROM (SELECT DISTINCT trim(entity_id), row_ordinal // 500 FROM records WHERE entity_id IS NOT NULL)) - (SELECT count(DISTINCT trim(entity_id)) FROM records) AS duplicate_entity_id_count,
 (SELECT count(*) FROM (SELECT trim(entity_id) FROM records WHERE entity_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS repeated_ids""",
    "q_source1_ids": r"""SELECT trim(entity_id) AS entity_id, arg_min(array_to_string(list_transform(regexp_extract_all(trim(coalesce(country_norm, '')), '\p{L}+|[^\p{L}]+'), lambda x: upper(x[1]) || lower(x[2:])), ''), row_ordinal) AS country_norm,
 count(*) AS n_rows FROM records WHERE trim(entity_id) <> '' GROUP BY 1""",
    "q_source1_duplicate_rows": "SELECT count(*) AS duplicate_rows FROM (SELECT row_ordinal // 500 AS c, min(row_ordinal // 500) OVER (PARTITION BY trim(entity_id)) AS m FROM records WHERE trim(entity_id) <> '') WHERE c > m",
    "q_gt_classify": _with("classed", "SELECT source1_entity_id, matched_entity_ids, row_type, missing_from_source1, CASE WHEN row_type = 'matched' THEN replace(matched_entity_ids, ' ', '') ELSE '' END AS parsed_ids FROM classed"),
    "q_gt_missing": _with("classed", "SELECT source1_entity_id FROM classed WHERE missing_from_source1"),
    "q_gt_class_counts": _with("classed", "SELECT row_type, missing_from_source1, count(*) AS n FROM classed GROUP BY 1, 2"),
    **{
        name: _with(
            "strata",
            f"SELECT stratum, n AS total, CAST(v AS BIGINT) AS n_val, CAST(n - v AS BIGINT) AS n_train, v = 0 AS fallback FROM (SELECT stratum, count(*) AS n, CASE WHEN count(*) < {least} THEN 0 ELSE round_even(count(*) * 0.15, 0) END AS v FROM strata GROUP BY 1)",
        )
        for name, least in (("q_strata_counts", 10), ("q_strata_counts_small", 11))
    },
    "q_split_assign": _with("split", "SELECT source1_entity_id, stratum, split FROM split"),
    "q_split_summary": _with("split", "SELECT split, country_norm, row_type, count(*) AS n FROM split GROUP BY 1, 2, 3"),
    "q_gt_subset": _with("splits", "SELECT source1_entity_id, matched_entity_ids FROM ground_truth WHERE source1_entity_id IN (SELECT source1_entity_id FROM splits WHERE split = 'val')"),
    "q_pool": _with("pool0", "SELECT * FROM pool0"),
    "q_pool_errors": _with("pool0", "SELECT (SELECT count(*) FROM pool0 WHERE trim(entity_id) = '') AS blank_ids, (SELECT count(*) FROM (SELECT entity_id FROM pool0 WHERE trim(entity_id) <> '' GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids"),
    "q_pool_rows_by_source": _with("pool0", "SELECT source, count(*) AS n FROM pool0 GROUP BY 1"),
    "q_exact_name": _with("q pool0", _capped("name", "name", 100)),
    "q_exact_name_alt": _with("q pool0", f"{_capped('core', 'name_core', 100)} UNION {_capped('alt', 'name_alt', 100)}"),
    "q_exact_address": _with("q pool0", _capped("address", "address", 100)),
    "q_address_keys_index": _with("akeys", "SELECT country, key, entity_id FROM akeys"),
    "q_address_keys_query": _with("qkeys", "SELECT row_id, key FROM qkeys"),
    "q_address_key_freq": _with("akeys", "SELECT country, key, count(*) AS frequency FROM akeys GROUP BY 1, 2"),
    "q_address_key_candidates": _with("akeys qkeys", _ADDRESS_KEYS.format(10)),
    "q_name_anchor": _with("anchors", "SELECT country, anchor, entity_id FROM anchors"),
    "q_prefix_block": _with("q pool0", _PREFIX),
    "q_anchor_block": _with("q anchors", _ANCHORED),
    "q_ratio": _with(
        "labeled clean1 pool0",
        "SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN length(names.a) + length(names.b) = 0 THEN 100.0 ELSE 200.0 * n / (length(names.a) + length(names.b)) END, 6) AS score FROM names JOIN lcs ON names.a = lcs.a AND names.b = lcs.b",
        f"{_NAMES}, want AS (SELECT DISTINCT a, b FROM names), {_LCS}",
        True,
    ),
    "q_token_set_ratio": _with(
        "labeled clean1 pool0",
        """SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN sect > 0 AND (la = 0 OR lb = 0) THEN 100.0
 ELSE greatest(100.0 - 100.0 * (la + lb - 2 * n) / (2 * sect + 2 * s + la + lb), CASE WHEN sect > 0 THEN 100.0 - 100.0 * (s + la) / (sect + sect + s + la) ELSE 0 END,
 CASE WHEN sect > 0 THEN 100.0 - 100.0 * (s + lb) / (sect + sect + s + lb) ELSE 0 END) END, 6) AS score FROM sized""",
        _SETS,
        True,
    ),
    "q_fuzzy_candidates": _with("q pool0 anchors", "SELECT row_id, entity_id, round(score, 6) AS score, pos FROM fuzzy", _FUZZY, True),
    "q_candidate_lists": _with("q clean1 pool0 anchors akeys qkeys", "SELECT * FROM lists", _ALL_FIVE, True),
    "q_record_pair_similarity": f"WITH RECURSIVE {_JUDGED}, {_LCS} SELECT s, c, round(CASE WHEN x = '' OR y = '' THEN 0.0 ELSE 2.0 * n / (length(x) + length(y)) END, 6) AS name_similarity FROM t LEFT JOIN lcs ON x = a AND y = b",
    "q_gt_class_examples": _with("classed", "SELECT row_type, missing_from_source1, source1_entity_id FROM (SELECT *, row_number() OVER (PARTITION BY row_type, missing_from_source1 ORDER BY source1_entity_id) AS r FROM (SELECT DISTINCT row_type, missing_from_source1, source1_entity_id FROM classed)) WHERE r <= 10"),
    "q_gt_blank_tokens": _with("ground_truth", "SELECT CAST(coalesce(sum(len(list_filter(string_split(matched_entity_ids, ','), lambda t: trim(t) = ''))), 0) AS BIGINT) AS blank_tokens FROM ground_truth WHERE trim(matched_entity_ids) <> ''"),
    "q_merge": _with("q clean1 pool0 akeys qkeys", "SELECT row_id, entity_id, strategy, rank FROM merged", _MERGED),
    "q_candidate_lists_exact": _with("q clean1 pool0 akeys qkeys", "SELECT * FROM lists", _MERGED),
    "q_generation_report": _with(
        "q clean1 pool0 akeys qkeys",
        "SELECT count(*) AS processed, count(*) FILTER (n_candidates > 0) AS nonempty, count(*) FILTER (n_candidates = 0) AS empty, CAST(sum(n_candidates) AS BIGINT) AS total_candidates, max(n_candidates) AS max_candidates_in_row, count(*) FILTER (n_candidates = 20) AS rows_at_cap FROM lists",
        _MERGED,
    ),
    "q_smoke_selector": _with(
        "raw_source1",
        """SELECT coalesce(h.slot, 0) AS slot, coalesce(l.entity_id, h.entity_id) AS entity_id, CASE WHEN l.entity_id IS NULL THEN h.country ELSE l.country END AS country FROM h
 LEFT JOIN l ON NOT h.target AND h.j = l.j AND l.j <= (SELECT 12 - count(*) FILTER (target) FROM h)""",
        """h AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY ordinal) AS j FROM (SELECT *, row_number() OVER (ORDER BY ordinal) AS slot, lower(trim(country)) = 'france' AS target FROM raw_source1) WHERE slot <= 50),
 l AS (SELECT *, row_number() OVER (ORDER BY ordinal) AS j FROM raw_source1 WHERE lower(trim(country)) = 'france' AND ordinal > (SELECT max(ordinal) FROM h))""",
    ),
    "q_candidate_validation": _with(
        "tokens splits",
        """SELECT (SELECT count(*) FROM candidates WHERE source1_entity_id NOT IN (SELECT source1_entity_id FROM splits)) AS orphan_rows,
 (SELECT count(*) FROM (SELECT unnest(string_split(candidate_entity_ids, ',')) AS t FROM candidates WHERE source1_entity_id NOT IN (SELECT source1_entity_id FROM splits)) WHERE t <> '') AS orphan_pairs,
 (SELECT count(*) FROM candidates WHERE source1_entity_id IN (SELECT source1_entity_id FROM splits)) AS rows_after_orphan_filter,
 (SELECT count(DISTINCT source1_entity_id) FROM candidates WHERE coalesce(candidate_entity_ids, '') = '' AND source1_entity_id IN (SELECT source1_entity_id FROM splits)) AS zero_candidate_ids,
 (SELECT count(*) FROM tokens) - (SELECT count(*) FROM (SELECT DISTINCT source1_entity_id, candidate_entity_id FROM tokens)) AS duplicates,
 (SELECT count(*) FROM tokens WHERE NOT regexp_matches(candidate_entity_id, '^S[23]-')) AS malformed""",
    ),
    "q_true_pairs": _with("truth", "SELECT source1_entity_id, candidate_entity_id FROM truth"),
    "q_labeled_pairs": _with("labeled", "SELECT * FROM labeled"),
    "q_pair_features": _with(
        "labeled clean1 pool0",
        """SELECT source1_entity_id, candidate_entity_id, split, source, label, round(CASE WHEN n1 = '' OR n2 = '' THEN 0.0 ELSE 2.0 * x.n / (length(n1) + length(n2)) END, 6) AS name_similarity,
 round(CASE WHEN a1 = '' OR a2 = '' THEN 0.0 ELSE 2.0 * y.n / (length(a1) + length(a2)) END, 6) AS address_similarity, CAST(k1 <> '' AND k2 <> '' AND k1 = k2 AS INT) AS country_match, missing_source1, missing_candidate
 FROM f JOIN lcs x ON n1 = x.a AND n2 = x.b JOIN lcs y ON a1 = y.a AND a2 = y.b""",
        f"{_FEATURES}, want AS (SELECT n1 AS a, n2 AS b FROM f UNION SELECT a1, a2 FROM f), {_LCS}",
        True,
    ),
    "q_class_balance": _with("labeled", "SELECT split, label, count(*) AS n FROM labeled GROUP BY 1, 2"),
    "q_blocking_recall": _with(
        "labeled truth splits",
        """SELECT split, count(*) AS true_pairs, count(l.label) AS observed_pairs, round(CAST(count(l.label) AS DOUBLE) / count(*), 9) AS recall, count(*) - count(l.label) AS missed_pairs,
 count(DISTINCT CASE WHEN l.label IS NULL THEN t.source1_entity_id END) AS ids_with_missed FROM truth t JOIN splits s USING (source1_entity_id)
 LEFT JOIN (SELECT source1_entity_id, candidate_entity_id, label FROM labeled WHERE label = 1) l USING (source1_entity_id, candidate_entity_id) GROUP BY 1""",
    ),
    "q_missed_pairs": _with("labeled truth splits", "SELECT split, t.source1_entity_id, t.candidate_entity_id FROM truth t JOIN splits USING (source1_entity_id) WHERE NOT EXISTS (SELECT 1 FROM labeled l WHERE l.source1_entity_id = t.source1_entity_id AND l.candidate_entity_id = t.candidate_entity_id AND label = 1)"),
    "q_zero_candidates": _with(
        "truth splits candidates",
        """SELECT split, kind, count(*) AS n, array_to_string(list_sort(list(source1_entity_id))[1:20], ',') AS sample_ids FROM (SELECT DISTINCT split, source1_entity_id, CASE WHEN source1_entity_id IN (SELECT source1_entity_id FROM truth) THEN 'matched' ELSE 'singleton' END AS kind
 FROM candidates JOIN splits USING (source1_entity_id) WHERE coalesce(candidate_entity_ids, '') = '') GROUP BY 1, 2""",
    ),
    "q_missing_records": _with("labeled clean1 pool0", "SELECT count(*) FILTER (missing_source1) AS missing_source1_records, count(*) FILTER (missing_candidate) AS missing_candidate_records FROM f", _FEATURES),
}
