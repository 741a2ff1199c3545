"""Token counts under a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

#: Where the vocabulary files are; a parameter of every function here.
TOKENIZERS = os.environ.get("QUERNSTONE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The tokenizer; read once per worker."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, columns: list[str], folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, more: Callable[[list], dict[str, list]] | None = None, more_schema: str = "") -> DataFrame:
    """``columns`` of ``docs`` and n_tokens (INT) of its text; null and empty texts have 0 tokens. Whole texts are read.

    more: further columns of the texts, by name, found in the same pass; more_schema: their types.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(folder, vocabulary)
        for b in batches:
            out = b[columns].copy()
            out["n_tokens"] = [len(enc.encode_ordinary(t)) if t else 0 for t in b["text"]]  # faster than a batch on one thread
            for name, values in (more(b["text"].tolist()) if more else {}).items():
                out[name] = pd.Series(values, index=out.index, dtype=object)
            yield out

    return docs.select(*columns, "text").mapInPandas(run, f"{schema}, n_tokens int" + (f", {more_schema}" if more else ""))
