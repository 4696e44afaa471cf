"""Defaults and rule dictionaries of the record-linkage pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# Null tokens of each reader.
NULLS_RAW = ("", "NULL", "null", "NA", "N/A", "n/a", "\\N")
NULLS_SPLIT = ("", "NULL", "null", "NA", "N/A", "\\N")
NULLS_LABEL = NULLS_SPLIT
NULLS_POOL = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Legal forms, raw spelling to canonical token.
LEGAL_FORMS = {
    "corporation": "corp", "corp.": "corp",
    "incorporated": "inc", "inc.": "inc",
    "limited": "ltd", "ltd.": "ltd",
    "private": "pvt", "pvt.": "pvt",
    "llp": "llp", "llc": "llc", "lp": "lp", "l.l.c.": "llc", "l.l.p.": "llp", "l.p.": "lp",
    "company": "co", "co.": "co",
    "associates": "assoc", "associate": "assoc", "assoc.": "assoc",
    "enterprises": "enterprises", "enterprise": "enterprise",
    "group": "group",
    "pvt. ltd.": "pvt ltd", "pvt ltd.": "pvt ltd", "pvt.ltd.": "pvt ltd",
}
LEGAL_TOKENS = ("enterprises", "enterprise", "pvt ltd", "assoc", "group", "corp", "inc", "ltd", "pvt", "llc", "llp", "lp", "co")

# Address abbreviations of each country, and those of all.
ADDRESS_WORDS = {
    "us": {
        "st": "street", "st.": "street", "ave": "avenue", "ave.": "avenue", "blvd": "boulevard", "blvd.": "boulevard",
        "rd": "road", "rd.": "road", "dr": "drive", "dr.": "drive", "ln": "lane", "ln.": "lane",
        "ct": "court", "ct.": "court", "pl": "place", "pl.": "place", "hwy": "highway", "hwy.": "highway",
        "pkwy": "parkway", "pkwy.": "parkway", "fwy": "freeway", "expy": "expressway", "trl": "trail", "trl.": "trail",
        "ter": "terrace", "ter.": "terrace", "cir": "circle", "cir.": "circle", "sq": "square", "sq.": "square",
        "ste": "suite", "ste.": "suite", "apt": "apartment", "apt.": "apartment", "bldg": "building", "bldg.": "building",
        "fl": "floor", "frwy": "freeway", "n": "north", "s": "south", "e": "east", "w": "west",
        "nw": "northwest", "ne": "northeast", "sw": "southwest", "se": "southeast", "po": "po", "p.o.": "po", "us": "us",
    },
    "india": {
        "rd": "road", "rd.": "road", "st": "street", "st.": "street", "ave": "avenue", "ave.": "avenue",
        "nagar": "nagar", "marg": "marg", "chowk": "chowk", "gali": "gali", "mohalla": "mohalla", "colony": "colony",
        "sector": "sector", "plot": "plot", "phase": "phase", "h.no": "house no", "h.no.": "house no", "hn": "house no",
        "s.no": "survey no", "s.no.": "survey no", "opp": "opposite", "opp.": "opposite", "nr": "near", "nr.": "near",
        "dist": "district", "dist.": "district", "teh": "tehsil", "teh.": "tehsil", "taluk": "taluk",
        "vlg": "village", "vlg.": "village", "blk": "block", "blk.": "block", "p.o": "po", "p.o.": "po", "pin": "pin",
    },
    "generic": {
        "rd": "road", "rd.": "road", "st": "street", "st.": "street", "ave": "avenue", "ave.": "avenue",
        "blvd": "boulevard", "blvd.": "boulevard", "dr": "drive", "dr.": "drive", "ln": "lane", "ln.": "lane",
        "ct": "court", "ct.": "court", "sq": "square", "sq.": "square", "no": "number", "no.": "number",
        "bldg": "building", "bldg.": "building", "apt": "apartment", "apt.": "apartment",
        "opp": "opposite", "opp.": "opposite", "nr": "near", "nr.": "near",
    },
}

# Patterns.
TRADE_NAME_PATTERNS = tuple(
    rf"(?iU)\b{phrase}\b\s*(.+?)(?:\s*,|\s*$)"
    for phrase in ("dba", "t/a", r"trading\s+as", "ta", r"also\s+known\s+as", "aka")
)
LANDMARK_PATTERN = (
    r"(?iU)\b(?:near|nr\.?|adj(?:acent)?(?:\s+to)?|opp(?:osite)?|behind|beside"
    r"|next\s+to|in\s+front\s+of|landmark\s*[:–\-])\s+[A-Za-z][\w\s,\.]{3,60}"
)
LEGAL_WORD_PATTERN = r"(?iU)\b(?:corp|inc|ltd|pvt|llc|llp|lp|co|assoc|enterprises|enterprise|group)\b"
MATCHED_ID_PATTERN = r"^(S2|S3)-\d+$"

# Address words too common to block on.
ADDRESS_STOP_WORDS = (
    "road", "street", "avenue", "boulevard", "lane", "highway", "parkway", "city",
    "district", "state", "near", "the", "and", "of", "block", "phase",
)

# Defaults.
CHUNK_SIZE = 50_000
VAL_FRACTION = 0.15
SEED = 42
MIN_STRATUM_SIZE = 10
POOL_SCHEMA_VERSION = "2"
INDEX_ANCHOR_MIN_LENGTH = 5
ADDRESS_KEY_WORDS = 6

EXACT_NAME, EXACT_NAME_ALT, EXACT_ADDRESS, ADDRESS_KEY, FUZZY_NAME = STRATEGIES = (
    "exact_name", "exact_name_alt", "exact_address", "address_key", "fuzzy_name",
)


class PoolValidationError(RuntimeError):
    """A stored pool is not the one that was asked for."""


class CandidateGenerationError(RuntimeError):
    """Candidates can't be generated from these inputs."""


@dataclass(frozen=True)
class CandidateConfig:
    """Limits of candidate retrieval; max_candidates None means no final cap."""

    enabled_strategies: tuple[str, ...] = STRATEGIES
    max_candidates: int | None = 200
    exact_limit: int = 100
    address_key_max_frequency: int = 200
    fuzzy_prefix_length: int = 5
    fuzzy_block_limit: int = 300
    fuzzy_top_k: int = 25
    fuzzy_threshold: float = 78.0
    name_anchor_min_length: int = 5

    def __post_init__(self) -> None:
        unknown = sorted(set(self.enabled_strategies) - set(STRATEGIES))
        if unknown:
            raise ValueError(f"unknown blocking strategies: {unknown}")
        if not self.enabled_strategies:
            raise ValueError("at least one blocking strategy must be enabled")
        for name in (
            "max_candidates", "exact_limit", "address_key_max_frequency", "fuzzy_prefix_length",
            "fuzzy_block_limit", "fuzzy_top_k", "name_anchor_min_length",
        ):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        if not 0 <= self.fuzzy_threshold <= 100:
            raise ValueError("fuzzy_threshold must lie between 0 and 100")


@dataclass(frozen=True)
class PoolSource:
    """One cleaned file of source 2 or 3."""

    source_name: str
    path: str


@dataclass(frozen=True)
class PoolSpec:
    """Which pool is wanted: the mode and its two sources."""

    mode: str
    source2: PoolSource
    source3: PoolSource


def normalize_mode(mode: str) -> str:
    value = mode.strip().lower()
    if value not in ("train", "test"):
        raise ValueError(f"mode must be 'train' or 'test', not {mode!r}")
    return value
