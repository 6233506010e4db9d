"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_ranks() -> str:
    """Path of the byte-level vocabulary that sizes are counted in unless another is given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    """The pattern that texts are cut into pieces by before that vocabulary's merges apply."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoding(path: str | None = None, pattern: str | None = None):
    """The tokenizer of a file of ranks ('token in base 64, rank' a line) and its pattern."""
    import tiktoken

    with open(path or default_ranks(), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern or default_pattern(), mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, text: str, name: str = "n_tokens", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Replace the column ``text`` by its number of tokens; null and empty texts have none. Whole texts are counted.

    Rows may repeat; other columns pass through.
    """
    kept = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)

    def run(batches):
        known = None
        for b in batches:
            known = known or encoding(path, pattern)
            out = b[kept].copy()
            out[name] = pd.Series([len(known.encode_ordinary(t)) if t else 0 for t in b[text]], index=b.index, dtype="int64")
            yield out

    return docs.select(*kept, F.col(text).alias(text)).mapInPandas(run, f"{schema}, `{name}` bigint")
