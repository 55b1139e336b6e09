"""Sorted runs of records as rows: columns packed with zstd, and sorted indexes merged by a heap."""
from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, staged

LEVEL = 3                       # of zstd
BLOCK = 8192                    # records that are packed and read together
FAN_IN = 128                    # indexes that one task merges


def packed_table(batches: list[pa.RecordBatch], schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))
    with pa.ipc.new_stream(sink, schema, options=options) as stream:
        for batch in batches:
            stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def squeeze(blocks: Iterable[tuple[np.ndarray, ...]]) -> bytes:
    """Columns, given in blocks, as one stream of zstd-compressed batches."""
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                          [str(k) for k in range(len(columns))])
               for columns in blocks]
    return packed_table(batches, batches[0].schema) if batches else b""


def unsqueeze(packed: bytes) -> list[np.ndarray]:
    return [c.to_numpy() for c in pa.ipc.open_stream(packed).read_all().columns]


def in_blocks(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for at in range(0, len(columns[0]), BLOCK):
        yield tuple(c[at:at + BLOCK] for c in columns)


# ---- indexes: ascending keys with numbers

def pack_index(blocks: Iterable[tuple[np.ndarray, ...]]) -> bytes:
    """Keys go in as what each adds to the one before, from zero in every block."""
    return squeeze((np.diff(keys, prepend=0), *rest) for keys, *rest in blocks)


def _blocks_of(packed: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    if packed:
        for batch in pa.ipc.open_stream(packed):
            keys, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield np.cumsum(keys), *rest


def unpack_index(packed: bytes) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*_blocks_of(packed))]


def merged(indexes: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in order and the sums of their numbers, in blocks, from indexes of (key, number). A heap
    has the end of the block that each index is at: what is not beyond the smallest end is whole."""
    readers = [_blocks_of(i) for i in indexes]
    blocks: list[tuple[np.ndarray, ...]] = [()] * len(readers)
    heap: list[tuple[int, int]] = []

    def advance(k: int) -> None:
        blocks[k] = next(readers[k], ())
        if blocks[k]:
            heapq.heappush(heap, (int(blocks[k][0][-1]), k))
    for k in range(len(readers)):
        advance(k)
    while heap:
        end, k = heapq.heappop(heap)
        parts = []
        for other, block in enumerate(blocks):
            if block and len(block[0]) and block[0][0] <= end:
                to = int(np.searchsorted(block[0], end, "right"))
                parts.append((block[0][:to], block[1][:to]))
                blocks[other] = block[0][to:], block[1][to:]
        advance(k)
        if parts:
            keys, which = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, which, np.concatenate([n for _, n in parts]))
            yield keys, sums


def _merge_group(group: pa.Table, last) -> pa.Table:
    blocks = merged(group.column("index").to_pylist())
    return pa.table({"section": pa.array([group.column("section")[0].as_py()], pa.int32()),
                     "run": pa.array([group.column("run")[0].as_py()], pa.int64()),
                     "index": pa.array([pack_index(last(blocks) if last else blocks)], pa.binary())})


def counted(indexes: DataFrame, runs: int, last=None) -> DataFrame:
    """(section, index): the sums of all keys of a section, from `indexes` (run, section, index) of
    so many runs, FAN_IN at a time until one is left. `last`: what is made of its blocks."""
    kind = "section int, run long, index binary"
    level = indexes.select("section", "run", "index")
    while runs > FAN_IN:
        runs = -(-runs // FAN_IN)
        level = staged(level.groupBy("section", F.pmod(F.xxhash64("run"), F.lit(runs)))
                       .applyInArrow(lambda group: _merge_group(group, None), kind))
    return level.groupBy("section").applyInArrow(lambda group: _merge_group(group, last), kind)


def answered(indexes: DataFrame, counts: DataFrame, runs: int, each: int) -> DataFrame:
    """(run, section, answer): of every index the counted columns of its keys, in its order. `each`
    indexes of a section share one copy of its counts."""
    shares = max(1, -(-runs // each))
    copies = counts.select("section", "index", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
                           .alias("share"))
    asked = indexes.withColumn("share", F.pmod(F.xxhash64("run"), F.lit(shares)).cast("int"))

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if len(asked):
            keys, *columns = unpack_index(known.column("index")[0].as_py())
            for packed in asked.column("index"):
                at = np.searchsorted(keys, unpack_index(packed.as_py())[0])
                out.append(squeeze([tuple(c[at] for c in columns)]))
        give_back()
        return pa.table({"run": asked.column("run").cast(pa.int64()),
                         "section": asked.column("section").cast(pa.int32()),
                         "answer": pa.array(out, pa.binary())})
    return (asked.groupBy("section", "share").cogroup(copies.groupBy("section", "share"))
            .applyInArrow(answer, "run long, section int, answer binary"))


def answers_of(table: pa.Table) -> list[np.ndarray]:
    """The columns of a run's answers, in the order of its sections."""
    found = [unsqueeze(a.as_py()) for a in table.sort_by("section").column("answer")]
    return [np.concatenate(c) for c in zip(*found)]
