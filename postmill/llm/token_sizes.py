"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.sources.tables import spread

#: The rank file where the setting postmill.tokenizer.ranks names no other.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_ENCODERS: dict = {}


def encoder(path: str = RANKS):  # noqa: ANN201
    """The encoder of a rank file, read once per Python process."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_sizes(pages: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """(id, n_tokens, *keep) of each row with a text; whole texts, one pass, no shuffle. A blank text may have no token."""

    path = path or pages.sparkSession.conf.get("postmill.tokenizer.ranks", RANKS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in frames:
            n = [len(enc.encode_ordinary(t)) for t in pdf.pop("text_")]
            yield pdf.assign(n_tokens=n)

    src = pages.where(F.col(text_column).isNotNull() & F.col(id_column).isNotNull()).select(id_column, *keep, F.col(text_column).alias("text_"))
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_column, *keep)) + ", n_tokens long"
    return spread(src).mapInPandas(run, schema)
