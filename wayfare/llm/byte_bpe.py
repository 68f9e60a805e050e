"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are split where no match of the pattern can cross: before a space or line feed that
follows an ASCII letter or digit. No alternative of the pattern has white space after another
character, and the alternatives with a look-ahead see the same next character in either part, so
the ids of the parts in turn are the ids of the whole.

Defined cases: a null or empty text has no ids; null ids decode to no bytes; every row gives a row,
also rows with a null or repeated ``doc_id``; other columns are not looked at.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import binary, pieces_of, texts, vectors

# Code points a part of a long text has, up to its next boundary.
PART = 100_000
BATCH_BYTES = 8 << 20
SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text by the rank file ``ranks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks)
        for batch in pieces_of(batches, lambda b: np.diff(_offsets(b.column(1))), BATCH_BYTES):
            ids = [np.array([i for part in parts(text) for i in encoder.encode_ordinary(part)], np.int32)
                   for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors(ids, pa.int32())], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``tokens`` (``doc_id, ids``) with the raw bytes of their ids as ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = encoding(ranks)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                raw = [decoder.decode_bytes(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), binary(raw)],
                                                 ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary")


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
