"""Sizes in tokens of a public tokenizer. The vocabulary file is a parameter and stays outside the repository."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("KURAMORI_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the split pattern that belongs to byte-level BPE vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_BYTES = 64 << 20
_SPLIT, _ENDLESS = regex.compile(PATTERN), regex.compile(r"\s{50000}")


@lru_cache(maxsize=2)
def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of the content of a rank file."""
    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=2)
def vocabulary(path: str = VOCABULARY) -> bytes:
    """Content of a rank file, read where the query is written; it goes to the tasks, which need no file. Refuses over ``MAX_BYTES``."""
    if os.path.getsize(path) > MAX_BYTES:
        raise ValueError(f"{path} is larger than {MAX_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def count(text: str | None, ranks: bytes | None = None) -> int:
    """Tokens of the whole text; 0 for null and empty texts.

    The library's own splitter can't walk through endless white space, so texts with such runs are split here, by the same pattern:
    merges never cross the pieces, which makes the sum exact."""
    if not text:
        return 0
    enc = encoding(ranks or vocabulary())
    if _ENDLESS.search(text):
        return sum(len(enc._encode_single_piece(m.group())) for m in _SPLIT.finditer(text))
    return len(enc.encode_ordinary(text))


def sized(documents: DataFrame, key: str, text: str, keep: list[str], path: str = VOCABULARY) -> DataFrame:
    """(key, keep..., tokens, loss_tokens): one pass without shuffle. ``loss_tokens`` are those after the first line, the prompt
    of instruction data; a one-line text is all response."""
    fields = {f.name: f.dataType.simpleString() for f in documents.schema}
    columns = [key, *keep]
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = shipped.value
        for pdf in batches:
            out = pdf[columns].copy()
            out["tokens"] = [count(t, ranks) for t in pdf[text]]
            prompts = [t.split("\n", 1)[0] if t and "\n" in t.rstrip("\n") else "" for t in pdf[text]]
            out["loss_tokens"] = [max(0, n - count(p, ranks)) for n, p in zip(out["tokens"], prompts)]
            yield out

    schema = ", ".join(f"`{c}` {fields[c]}" for c in columns) + ", tokens long, loss_tokens long"
    return documents.select(*columns, F.col(text)).mapInPandas(run, schema)
