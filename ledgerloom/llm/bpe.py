"""Byte-level BPE with a local rank file: encoding by the tiktoken library, decoding from raw bytes.

A text is cut at places where the split pattern always ends a match, so that a piece encodes as it
does inside the whole text:

* before white space that follows anything else (white space only ever starts a match, or is one);
* between an ASCII letter and a digit, either way round.

A long run of white space is one match but for its last character when a word follows; it is merged
directly, because the pattern's look-ahead needs stack in proportion to the run.
"""
from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SMALL_BATCH, give_back, ship_package, text_or_empty

# The characters with Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0  -     　"
BOUNDARY = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
PIECE_CHARS = 1 << 16
RUN_CHARS = 256
LONG_RUN = re.compile(f"[{WHITE}]{{{RUN_CHARS},}}")


def between_runs(text: str) -> Iterator[tuple[str, bool]]:
    """(part, whether it is one match): long runs of white space and what lies between them."""
    at = 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > at:
            yield text[at:run.start()], False
        yield text[run.start():end], True
        at = end
    if at < len(text):
        yield text[at:], False


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of `size` characters, each prolonged to the next boundary."""
    at = 0
    while len(text) - at > size and (cut := BOUNDARY.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


class ByteBpe:
    def __init__(self, rank_file: str, pattern: str):
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.width = np.array([len(t) for t in self.bytes_of], dtype=np.int64)

    def encode(self, text: str, size: int = PIECE_CHARS) -> list[int]:
        ids: list[int] = []
        for part, whole in between_runs(text):
            if whole:
                ids += self.encoding._encode_single_piece(part)
            else:
                for piece in pieces(part, size):
                    ids += self.encoding.encode_ordinary(piece)
        return ids

    def packed(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u4").tobytes()

    def decode(self, packed: bytes) -> bytes:
        """Raw bytes, which need not be valid UTF-8 for a part of a text's ids."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=4)
def load(rank_file: str, pattern: str) -> ByteBpe:
    """One tokenizer per Python worker; the file must be readable on every executor."""
    return ByteBpe(rank_file, pattern)


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Token ids of a text as little-endian unsigned 32-bit integers in one binary value.
    Null: null. Empty: no ids."""
    @F.arrow_udf("binary")
    def byte_bpe_encode(texts: pa.Array) -> pa.Array:
        bpe = load(rank_file, pattern)
        give_back()
        return pa.array([bpe.packed(t.as_py()) if t.is_valid else None for t in texts], pa.binary())
    return byte_bpe_encode(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes that the packed ids stand for. Null: null."""
    @F.arrow_udf("binary")
    def byte_bpe_decode(packed: pa.Array) -> pa.Array:
        bpe = load(rank_file, pattern)
        return pa.array([bpe.decode(p.as_py()) if p.is_valid else None for p in packed], pa.binary())
    return byte_bpe_decode(ids)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text: str = "text",
                     ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Every row with its token ids and the bytes they decode to. A null text counts as empty.
    Columns of the input that have the names `ids` or `decoded` are replaced; all others, and
    repeated rows, stay. No shuffle: tasks hold one Arrow batch of texts at a time, as texts, as ids and
    as bytes, for which batches are small."""
    ship_package(docs.sparkSession, SMALL_BATCH)
    return (docs.withColumn(ids, encode(text_or_empty(text), rank_file, pattern))
            .withColumn(decoded, decode(F.col(f"`{ids}`"), rank_file, pattern)))


def digests(ids: str = "token_ids", decoded: str = "decoded") -> dict:
    """Columns that identify ids and round trip without carrying them."""
    return {"n_tokens": (F.octet_length(F.col(ids)) / 4).cast("long"),
            "ids_sha256": F.sha2(F.col(ids), 256),
            "decoded_sha256": F.sha2(F.col(decoded), 256)}
