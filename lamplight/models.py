"""Stand-ins for the injected models: deterministic, dependency-free, and no claim to quality.

An encoder maps texts to unit vectors, a reranker a query and texts to scores in 0..1, a generator a prompt to text, a parser file content
to page texts. Any callable of that shape can take their place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]
Generator = Callable[[str], str]
Reranker = Callable[[str, list[str]], list[float]]
PageParser = Callable[[bytes], list[str]]
_WORD = re.compile("[a-z0-9]+")


def hashing_encoder(dim: int = 64) -> Encoder:
    """Signed feature hashing of words, at unit length; a text without words gives zeros."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, text in enumerate(texts):
            for word in _WORD.findall((text or "").lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                out[i, h % dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return encode


def embed(df: DataFrame, text_col: str, encoder: Encoder, batch: int = 64, out: str = "vector") -> DataFrame:
    """df with a vector of each text: whole Arrow batches go to the encoder, which is loaded once a worker; null texts get null."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop(out).schema)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            vectors: list = []
            texts = part[text_col].tolist()
            for i in range(0, len(texts), batch):
                vectors.extend(encoder([t or "" for t in texts[i : i + batch]]).astype(np.float32))
            part[out] = [v if isinstance(t, str) else None for v, t in zip(vectors, texts, strict=True)]
            yield part

    return df.drop(out).mapInPandas(run, f"{fields}, `{out}` array<float>")


def lexical_score(query_terms: list[str], text: Column) -> Column:
    """The default reranker: the share of the query's distinct words that occur in the text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
    wanted = F.array(*(F.lit(t) for t in dict.fromkeys(query_terms)))
    return F.coalesce(F.size(F.array_intersect(words, wanted)), F.lit(0)) / F.lit(float(max(1, len(set(query_terms)))))
