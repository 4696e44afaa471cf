"""Fields that hold several values: one row per value with its position."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Between values, outside quotes and parentheses. White space of any kind delimits too.
DELIMITERS = ",;|/+，；、"
#: Marks around a whole list or a nested one.
OPEN, CLOSE = "[{", "]}"
QUOTES = "\"'"
#: Whole fields that hold nothing.
NULL_FIELDS = ("NULL", "\\N")

_PLAIN_SPLIT = re.compile(rf"[\s{re.escape(DELIMITERS)}]+")
_SPECIAL = re.compile(r"[\"'\[\]{}()\\]")


def tokenize(field: str | None) -> list[str]:
    """The non-blank values of a field in order.

    A finite-state scan with four states (between values, in a bare value, in quotes, after a closing quote) and a nesting depth:
    - A quote opens quoted text only where a value starts; it closes at the same mark, unless that is doubled (one mark is meant)
      or a backslash stands before it. A closing mark counts only before a delimiter, a closing bracket or the end, so
      stray marks inside quoted text stay text; a quote that never closes is an ordinary character of a bare value.
    - [ and { where a value starts, and the marks that close them, only enclose lists, at any depth; inside a bare value they are text.
    - Delimiters within parentheses of a bare value belong to it; a parenthesis that never closes does not hide delimiters.
    Null, blank fields, NULL and \\N hold nothing. Repeated and malformed values stay.
    """
    if field is None:
        return []
    text = field.strip()
    if not text or text in NULL_FIELDS:
        return []
    if not _SPECIAL.search(text):
        return [v for v in _PLAIN_SPLIT.split(text) if v]
    out: list[str] = []
    i, n, depth = 0, len(text), 0
    while i < n:
        ch = text[i]
        if ch.isspace() or ch in DELIMITERS:
            i += 1
        elif ch in OPEN:
            depth, i = depth + 1, i + 1
        elif ch in CLOSE and depth:
            depth, i = depth - 1, i + 1
        else:
            value, i = (_quoted(text, i, depth) if ch in QUOTES else None) or _bare(text, i, depth)
            if value.strip():
                out.append(value.strip())
    return out


def _ends(text: str, i: int, depth: int) -> bool:
    return i == len(text) or text[i].isspace() or text[i] in DELIMITERS or bool(depth) and text[i] in CLOSE


def _quoted(text: str, i: int, depth: int) -> tuple[str, int] | None:
    mark, out, j = text[i], [], i + 1
    while j < len(text):
        ch = text[j]
        if ch == "\\" and j + 1 < len(text) and text[j + 1] in (mark, "\\"):
            out.append(text[j + 1])
            j += 2
        elif ch != mark:
            out.append(ch)
            j += 1
        elif text[j + 1 : j + 2] == mark:
            out.append(mark)
            j += 2
        elif _ends(text, j + 1, depth):
            return "".join(out), j + 1
        else:
            out.append(ch)
            j += 1
    return None


def _bare(text: str, i: int, depth: int) -> tuple[str, int]:
    j, inner = i, 0
    while j < len(text):
        if text[j] == "(" and (inner or ")" in text[j:]):
            inner += 1
        elif text[j] == ")" and inner:
            inner -= 1
        elif not inner and j > i and _ends(text, j, depth):
            break
        j += 1
    return text[i:j], j


@pandas_udf(T.ArrayType(T.StringType()))
def tokenize_udf(field: pd.Series) -> pd.Series:
    return field.map(tokenize)


def split_packed(df: DataFrame, field: str, keys: list[str], value: str = "value", pos: str = "pos_no") -> DataFrame:
    """(keys, pos, value): one row per non-blank value of the field, counted from 1.

    Rows whose field holds nothing give no row; keys may be null or repeated, and other columns may have any names, since
    only keys and field are read. An empty table gives an empty one. A field of any length is one scan; no shuffle.
    """
    rows = df.select(*(F.col(f"`{k}`") for k in keys), tokenize_udf(F.col(f"`{field}`").cast("string")).alias("_values"))
    exploded = rows.select(*(f"`{k}`" for k in keys), F.posexplode("_values").alias("_pos", "_value"))
    return exploded.select(*(f"`{k}`" for k in keys), (F.col("_pos") + 1).cast("long").alias(pos), F.col("_value").alias(value))


def id_plain_form(c: Column) -> Column:
    """A record id in plain form: S1-, S2- or S3- and digits without leading zeros; null where the value denotes no record.

    White space and zero-width characters around it, letter case, full-width characters, the separator (hyphen or dash of any kind,
    underscore or space), leading zeros and a decimal .0 are ways to write the same id.
    """
    narrow = F.translate(c, "０１２３４５６７８９Ｓｓ．＿", "0123456789Ss._")
    bare = F.upper(F.regexp_replace(narrow, r"(?U)^[\s\p{Cf}]+|[\s\p{Cf}]+$", ""))
    pattern = r"(?U)^S\s*([123])[\s_\p{Pd}−]+0*([0-9]+?)(?:\.0*)?$"
    return F.when(F.regexp_like(bare, F.lit(pattern)), F.concat(F.lit("S"), F.regexp_extract(bare, pattern, 1), F.lit("-"), F.regexp_extract(bare, pattern, 2)))


def id_code(plain: Column) -> Column:
    """A plain-form id of at most 16 digits as a long that sorts as the id's text does; null for longer ones. Longs aggregate and join far cheaper than strings."""
    digits = F.substring(plain, 4, 17)
    d = F.length(digits)
    left = F.rpad(digits, 16, "0").cast("long")  # text order is that of left-aligned digits, shorter ones first
    code = (F.substring(plain, 2, 1).cast("long") * F.lit(10**16) + left) * F.lit(32) + d
    return F.when(d <= 16, code)


def id_of_code(code: Column) -> Column:
    """The id that id_code made the code from."""
    body = F.shiftright(code, 5)
    digits = F.lpad(F.pmod(body, F.lit(10**16)).cast("string"), 16, "0")
    source = ((body - F.pmod(body, F.lit(10**16))) / F.lit(10**16)).cast("int").cast("string")
    return F.concat(F.lit("S"), source, F.lit("-"), F.substring(digits, F.lit(1), F.pmod(code, F.lit(32)).cast("int")))
