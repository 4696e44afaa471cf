"""Blocking keys of names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweave.config import ADDRESS_KEY_WORDS, ADDRESS_STOP_WORDS


def _words(address: Column, max_words: int) -> Column:
    found = F.regexp_extract_all(address, F.lit(r"(?U)([^\W\d_]+)"), F.lit(1))
    return F.slice(F.array_distinct(F.filter(found, lambda w: (F.length(w) >= 4) & ~w.isin(*ADDRESS_STOP_WORDS))), 1, max_words)


def _numbers(address: Column) -> Column:
    return F.regexp_extract_all(address, F.lit(r"(?U)\b(\d+)\b"), F.lit(1))


def _unpadded(number: Column) -> Column:
    bare = F.regexp_replace(number, "^0+", "")
    return F.when(F.length(bare) > 0, bare).otherwise("0")


def _pins(numbers: Column) -> Column:
    return F.transform(F.filter(numbers, lambda n: F.length(n) == 6), lambda n: F.concat(F.lit("pin|"), n))


def address_keys_query(address: Column, max_words: int = ADDRESS_KEY_WORDS) -> Column:
    """number|word keys, only where a number exists, and pin|dddddd keys. address: folded and stripped."""
    numbers = _numbers(address)
    with_number = F.transform(_words(address, max_words), lambda w: F.concat(_unpadded(F.get(numbers, F.lit(0))), F.lit("|"), w))
    return F.array_union(F.when(F.size(numbers) > 0, with_number).otherwise(F.array().cast("array<string>")), _pins(numbers))


def address_keys_index(address: Column, max_words: int = ADDRESS_KEY_WORDS) -> Column:
    """As address_keys_query, but an address without a number is indexed under the number 0."""
    numbers = _numbers(address)
    number = _unpadded(F.coalesce(F.get(numbers, F.lit(0)), F.lit("")))
    return F.array_union(F.transform(_words(address, max_words), lambda w: F.concat(number, F.lit("|"), w)), _pins(numbers))


def name_anchor(name: Column, min_length: int) -> Column:
    """The longest token of at least min_length, the smallest of equally long ones; null if there is none. name: folded."""
    tokens = F.filter(F.regexp_extract_all(name, F.lit(r"(?i)([a-z0-9]+)"), F.lit(1)), lambda t: F.length(t) >= min_length)
    return F.array_min(F.transform(tokens, lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t"))))["t"]
