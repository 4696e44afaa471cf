"""String expressions with Unicode-aware patterns, all evaluated in the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NOISE = r"[/\\|_\[\]{}<>]+"


def strip(c: Column) -> Column:
    """White space of any kind removed at both ends; trim() takes only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


def null_tokens(c: Column, tokens: tuple[str, ...]) -> Column:
    """Null where the whole value is one of the tokens."""
    return F.when(~c.isin(*tokens), c)


def title(c: Column) -> Column:
    """Every run of letters capitalised, also after apostrophes, full stops and digits."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?U)(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap), "")


def casefold(c: Column) -> Column:
    """Lower case with sharp s as ss and final sigma as sigma."""
    return F.translate(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), "ς", "σ")


def clean_scalar(c: Column) -> Column:
    """Null as '', stripped, folded."""
    return casefold(strip(F.coalesce(c, F.lit(""))))


def collapse(c: Column) -> Column:
    """Runs of two or more white space characters become one space; both ends stripped."""
    return strip(F.regexp_replace(c, r"(?U)\s{2,}", " "))


def longest_first(rules: Mapping[str, str]) -> list[tuple[str, str]]:
    return sorted(rules.items(), key=lambda kv: -len(kv[0]))


def rewrite_words(c: Column, rules: Mapping[str, str], end: str = r"\b") -> Column:
    """Whole-word rewriting, longest rule first. c must be in lower case: rules that map a word to itself are then left out."""
    for word, to in longest_first(rules):
        if word != to:
            c = F.regexp_replace(c, rf"(?iU)\b{re.escape(word)}{end}", to)
    return c


def first_match(c: Column, pattern: str) -> Column:
    """First full match, stripped; null if there is none or it is blank."""
    return blank_to_null(strip(F.regexp_extract(c, pattern, 0)))
