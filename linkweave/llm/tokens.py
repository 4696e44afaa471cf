"""Token counts of texts by a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Folder of the vocabulary files on every machine, and the file in it.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary cuts texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Longer texts are encoded in pieces cut before a space, where the pattern cuts too.
PIECE = 100_000


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> Iterator[str]:
    """text in parts of about PIECE characters, each but the first beginning at a space between two letters, where a token always begins."""
    start = 0
    while len(text) - start > PIECE:
        at = start + PIECE
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 < len(text) and text[at - 1].isalpha() and text[at + 1].isalpha():
                break
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def count_tokens(text: str | None, path: str) -> int:
    return sum(len(encoding(path).encode_ordinary(p)) for p in pieces(text)) if text else 0


def with_token_counts(documents: DataFrame, folder: str = FOLDER, vocabulary: str = VOCABULARY, columns: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """columns plus n_tokens of text; null and empty texts have 0. The text itself goes no further than the scan."""
    path = os.path.join(folder, vocabulary)

    @pandas_udf(T.LongType())
    def n_tokens(text: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(x, path) for x in text], dtype="int64")

    return documents.select(*columns, n_tokens("text").alias("n_tokens"))
