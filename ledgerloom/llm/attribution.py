"""Token counts by offset-mapped attribution: a document is encoded once, as a whole, and its
tokens' character spans are joined with the spans of its sections.

A token belongs to every section that it overlaps; where it crosses a boundary, a rule says which
section counts it: "start", the one with its first character; "end", the one with its last;
"most", the one with most of its characters, the first of equals. Each token is counted once.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import bpe
from ledgerloom.llm.common import ship_package, text_or_empty

RULES = ("start", "end", "most")
ROWS = ("array<struct<section: int, first_char: long, end_char: long, n_tokens: long, "
        "n_crossing: long>>")


def token_spans(text: str, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token. widths: the tokens' bytes. A token inside a
    character's bytes spans that character."""
    ends = np.cumsum(widths)
    if text.isascii():
        return ends - widths, ends - 1
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    char = np.cumsum(lead) - 1
    return char[ends - widths], char[ends - 1]


def line_starts(text: str) -> np.ndarray:
    """Sections are lines; a line feed belongs to the line it ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    breaks = np.flatnonzero(codes == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(codes)]])


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str):
    """Tokens counted by each section, and of those the ones that reach into another. Both spans
    and sections ascend, so the interval join is a search among section starts."""
    one = np.searchsorted(starts, first, side="right") - 1
    two = np.searchsorted(starts, last, side="right") - 1
    owner = two if rule == "end" else one.copy()
    if rule == "most":
        edges = np.append(starts, np.iinfo(np.int64).max)
        for k in np.flatnonzero(one != two).tolist():
            cover = [min(edges[s + 1], last[k] + 1) - max(edges[s], first[k])
                     for s in range(one[k], two[k] + 1)]
            owner[k] = one[k] + int(np.argmax(cover))
    return (np.bincount(owner, minlength=len(starts)),
            np.bincount(owner[one != two], minlength=len(starts)))


def section_counts(text: Column, rank_file: str, pattern: str, rule: str = "start") -> Column:
    """The sections of each text with their token counts, as an array."""
    if rule not in RULES:
        raise ValueError(f"the rule is one of {RULES}")

    @F.arrow_udf(ROWS)
    def sections_of(texts: pa.Array) -> pa.Array:
        coder = bpe.load(rank_file, pattern)
        columns, sizes = [[] for _ in range(5)], [0]
        for text in texts.to_pylist():
            text = text or ""
            starts = line_starts(text)
            spans = token_spans(text, coder.width[np.array(coder.encode(text), dtype=np.int64)])
            counts = attribute(*spans, starts, rule)
            for column, part in zip(columns, (np.arange(len(starts)), starts,
                                              np.append(starts[1:], len(text)), *counts)):
                column.append(part)
            sizes.append(sizes[-1] + len(starts))
        joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        rows = pa.StructArray.from_arrays(
            [pa.array(joined[0].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in joined[1:])],
            ["section", "first_char", "end_char", "n_tokens", "n_crossing"])
        return pa.ListArray.from_arrays(pa.array(np.array(sizes, np.int32)), rows)
    return sections_of(text)


def count_tokens(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id",
                 text: str = "text", rule: str = "start") -> DataFrame:
    """One row per document and section: the key, section (from 0), its character span
    [first_char, end_char), n_tokens and n_crossing (those of them that reach into another
    section). The counts of a document's sections add up to the tokens of its whole text.

    A null or empty text has one empty section with no tokens. Null keys and repeated rows stay as
    they are, each row on its own. No shuffle.
    """
    ship_package(docs.sparkSession)
    found = section_counts(text_or_empty(text), rank_file, pattern, rule)
    return (docs.select(F.col(key), found.alias("_sections"))
            .select(key, F.inline("_sections")))
