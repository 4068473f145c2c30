"""Encoding of a whole corpus with a public byte-level BPE tokenizer, by forced-boundary splitting.

Two bytes that stand side by side inside no token of the vocabulary are never merged, so every place where such a pair meets is a
certain cut: what stands left and right of it can be encoded independently. The cuts of a batch come from one table look-up
a byte; the fragments between them, mostly single words, are few when counted once each, so only new fragments reach the
tokenizer, and the ids of all texts are gathered from those of the fragments with array operations.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.llm.words import batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pre-splitting pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fragments kept in a worker's cache, and the longest that is kept; others are encoded again when they recur.
CACHE, CACHED_BYTES = 200_000, 64


@lru_cache(maxsize=2)
def _encoder(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}
    inside = np.zeros((256, 256), bool)
    for token in ranks:
        at = np.frombuffer(token, np.uint8)
        inside[at[:-1], at[1:]] = True
    cut = ~inside
    # The pattern looks ahead of white space and tells an apostrophe by what stands before it, so neither side of a cut may be
    # white space on the left or an apostrophe on the right. Bytes from 0x80 on are parts of characters: left of a cut they
    # could belong to a white space character, right of it to the middle of a character.
    cut[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32], :] = False
    cut[128:, :] = False
    cut[:, ord("'")] = False
    cut[:, 128:192] = False
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), cut, {}


def encode_texts(texts: list[str | None], vocabulary: bytes, pattern: str = PATTERN) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and each text's first (n + 1 entries); empty and null texts have none."""
    encoding, cut, cache = _encoder(vocabulary, pattern)
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    data = b"".join(raw)
    ends = np.cumsum([0, *map(len, raw)])
    if not data:
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(data, np.uint8)
    begins = np.concatenate([[True], cut[at[:-1], at[1:]]])
    begins[ends[:-1][ends[:-1] < len(data)]] = True
    start = np.flatnonzero(begins)
    offsets = np.append(start, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = pc.dictionary_encode(pieces)
    own = coded.dictionary.to_pylist()
    ids = []
    for piece in own:
        known = cache.get(piece)
        if known is None:
            known = encoding.encode_ordinary(piece.decode("utf-8"))
            if len(piece) <= CACHED_BYTES and len(cache) < CACHE:
                cache[piece] = known
        ids.append(known)
    width = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((x for one in ids for x in one), np.int32, int(width.sum()))
    head = np.concatenate([[0], np.cumsum(width)])
    use = coded.indices.to_numpy()
    n = width[use]
    put = np.concatenate([[0], np.cumsum(n)])
    out = flat[np.arange(put[-1]) + np.repeat(head[:-1][use] - put[:-1], n)]
    return out, put[np.searchsorted(start, ends)]


def _encode(vocabulary: bytes, pattern: str, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts, 4096, 4_000_000):
            ids, first = encode_texts(texts[i:j], vocabulary, pattern)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))], ["id", "ids"])


def encode_corpus(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, ids array<int>): the ids of each row's text without special tokens; one narrow pass, no shuffle.

    A null, an empty text: an empty list. Strings of special tokens inside a text are ordinary text. Rows keep their number:
    repeated rows are encoded each. The vocabulary file (about 1 MB whatever the corpus) is read once by the driver and sent along.
    """
    with open(vocabulary, "rb") as file:
        content = file.read()
    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(partial(_encode, content, pattern), f"id {kind}, ids array<int>")
