"""Large tables part by part, so that the disk holds the shuffles of a part and not of everything.

A part has the rows of some keys, whole: what is done per key (the latest version, copies, joins of a row
to its lookups) gives for the parts together what it gives for the table. Every part reads the table, of
which nothing is left out; what is shuffled and sorted is a part's."""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import staged

#: Bytes of files that make one part, and parts at most, as each reads the files once more.
PART_BYTES, MOST_PARTS = 64 << 20, 8


def file_bytes(df: DataFrame) -> int:
    """What the files that a frame reads hold, as Spark's plan has it; subqueries are not counted."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def parts_of(df: DataFrame, key: str) -> list[DataFrame]:
    """The rows by a hash of `key` (rows without one are in one part); a small table is one part."""
    n = max(1, min(MOST_PARTS, -(-file_bytes(df) // PART_BYTES)))
    if n == 1:
        return [df]
    return [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k) for k in range(n)]


def in_turn(frames: Iterable[DataFrame], **options: str) -> list[DataFrame]:
    """The frames, each worked off and stored before the next begins; the shuffle files of one are gone
    when it has been stored."""
    return [staged(frame, **options) for frame in frames]


def together(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
