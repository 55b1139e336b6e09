"""Token ids in ORC: stripes with run-length encoded integers, row indexes, and Bloom filters on
document ids.

A file set is one folder. Its rows are documents in ascending order of id, over all files by name;
each has its place among the ids of its own file. Readers take stripes in parallel, and a filter on
document ids skips stripes and row groups by their minima, maxima and Bloom filters.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import wordbpe
from ledgerloom.llm.common import ship_package, staged

END = 1                                     # the id that ends every document
OPTIONS = {"compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "1000",
           "orc.stripe.size": str(64 << 20), "orc.bloom.filter.columns": "doc_id",
           "orc.bloom.filter.fpp": "0.01"}
TEXTS_AT_ONCE = 200
SCHEMA = "doc_id long, part int, place long, n_tokens long, token_ids array<int>"


def _encoded(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    tokenizer, part, place = wordbpe.load(file), TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            few = batch.slice(at, TEXTS_AT_ONCE)
            packed = [p + END.to_bytes(4, "little")
                      for p in tokenizer.encode_all(few.column(1).to_pylist())]
            counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            ends = np.cumsum(counts)
            ids = np.frombuffer(b"".join(packed), "<i4")
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [few.column(0), pa.array(np.full(len(few), part, np.int32)),
                 pa.array(place + ends - counts), pa.array(counts),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                ["doc_id", "part", "place", "n_tokens", "token_ids"])
            place += int(ends[-1])


def write(docs: DataFrame, path: str, tokenizer_file: str, key: str = "doc_id",
          text: str = "text") -> None:
    """Encodes whole texts, ends each document with END and writes them in ascending order of key.

    A null text is empty: one id. Null keys come first; rows that repeat a key are ordered by a
    hash of their texts, and all are kept. Empty input: a folder without rows. The order is made
    by ranges of keys, before encoding, so that no text is encoded twice.
    """
    ship_package(docs.sparkSession)
    ordered = (docs.select(F.col(key).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text), F.lit("")).alias("text"))
               .withColumn("_tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
               .select("doc_id", "text"))
    (ordered.mapInArrow(lambda batches: _encoded(batches, tokenizer_file), SCHEMA)
     .write.options(**OPTIONS).orc(path))


def read(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and token_ids.

    Starts need the sums of files only, which are as many as writing tasks. With `doc_ids`, row
    groups that can't hold them are not read.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0))
                                 .alias("_before")))
    if doc_ids is not None:
        rows = rows.filter(F.col("doc_id").isin(list(doc_ids)))
    # One row per writing task.
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_before") + F.col("place")).alias("start"), "n_tokens", "token_ids")


def crc32_of(ids: Column) -> Column:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers. Null: null."""
    @F.arrow_udf("long")
    def crc32_of_ids(lists: pa.Array) -> pa.Array:
        values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
        view, ends = memoryview(values).cast("B"), lists.offsets.to_pylist()
        return pa.array([None if not ok else zlib.crc32(view[4 * a:4 * b]) for ok, a, b
                         in zip(lists.is_valid().to_pylist(), ends, ends[1:])], pa.int64())
    return crc32_of_ids(ids)
