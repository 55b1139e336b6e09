"""Exact top-k by inner product as a Voronoi kNN join.

Inner products become distances by one more coordinate: with M the largest norm of the data, a
vector s goes to (s, sqrt(M^2 - |s|^2)) and a query q to (q, 0); the nearest is then the one with
the largest product. Queries and data are assigned to the nearest of a few pivots. Summaries of the
cells (how far queries reach, the k smallest distances of data) bound the distance of the k-th
neighbour of every query of a cell, and with it which data it can need. Cells are packed into groups
of queries; each group gets the data that one of its cells needs, in blocks, and every block gives
the k best of each query, from which the k best of all are taken.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, staged

PIVOTS = 64
#: Queries and data that one task compares.
QUERY_BLOCK, DATA_BLOCK = 2048, 2048
ROWS_AT_ONCE = 256
SLACK = 1e-6            # bounds are widened by it, so that rounding loses nothing
EXACT = 2.0 ** 53


def _vectors(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows with whole vectors: id, components floor(scale * x) packed as 64-bit integers, and the
    squared length. An empty vector counts; its products are zero."""
    for batch in batches:
        ids, packed, squares = [], [], []
        for vec_id, values in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            if vec_id is None or values is None or None in values:
                continue
            x = np.array(values, dtype=np.float64)
            if not np.isfinite(x).all():
                continue
            whole = np.floor(scale * x)
            ids.append(vec_id)
            packed.append(whole.astype("<i8").tobytes())
            squares.append(float(whole @ whole))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary()),
                                          pa.array(squares, pa.float64())],
                                         ["vec_id", "vec", "square"])


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(packed), width), np.int64)
    for row, values in zip(out, packed):
        v = np.frombuffer(values, "<i8")
        row[:len(v)] = v
    return out


@dataclass
class Space:
    """Pivots with their extra coordinate, the largest squared length, and the width."""
    pivots: np.ndarray
    lift: np.ndarray
    most: float
    width: int

    def distances(self, packed: list[bytes], squares: np.ndarray, query: bool) -> np.ndarray:
        lift = np.zeros(len(squares)) if query else np.sqrt(np.maximum(self.most - squares, 0))
        products = matrix(packed, self.width).astype(np.float64) @ self.pivots.T
        square = (squares[:, None] + (self.pivots ** 2).sum(axis=1) - 2 * products
                  + (lift[:, None] - self.lift) ** 2)
        return np.sqrt(np.maximum(square, 0))

    def between(self) -> np.ndarray:
        gaps = self.pivots[:, None, :] - self.pivots[None, :, :]
        return np.sqrt((gaps ** 2).sum(axis=2) + (self.lift[:, None] - self.lift) ** 2)


def _assigned(vectors: DataFrame, space: Space, query: bool) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(space)     # PIVOTS vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = shared.value.distances(batch.column(1).to_pylist(),
                                         batch.column(2).to_numpy(), query)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)),
                 pa.array(far[np.arange(len(cell)), cell]), batch.column(3)],
                ["vec_id", "vec", "cell", "far", "copies"])
    return vectors.mapInArrow(assign, "vec_id long, vec binary, cell int, far double, copies long")


@dataclass
class Plan:
    """Bounds of the data a query cell needs: in data cell j those at a distance from low[i, j] to
    high[i, j]; the groups of each cell; the lowest and highest bounds of each group."""
    low: np.ndarray
    high: np.ndarray
    groups: list[list[int]]
    group_low: np.ndarray
    group_high: np.ndarray


def plan(space: Space, queries: dict[int, tuple[int, float]], nearest: dict[int, list[float]],
         k: int, block: int) -> Plan:
    """queries: by cell, how many and the largest distance; nearest: by data cell, the k smallest
    distances. k counts the rows of the query's own id too."""
    gaps, n = space.between(), len(space.pivots)
    low, high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    for i, (_, reach) in queries.items():
        bounds = sorted(reach + gaps[i, j] + d for j, ds in nearest.items() for d in ds)
        kth = bounds[k - 1] if len(bounds) >= k else np.inf
        slack = SLACK * (1 + gaps[i] + reach)
        low[i], high[i] = gaps[i] - reach - kth - slack, gaps[i] + reach + kth + slack
    groups: list[list[int]] = [[] for _ in range(n)]
    number, room, left, at = -1, 0, set(queries), min(queries, default=0)
    while left:
        at = min(left, key=lambda j: (gaps[at, j], j))      # the nearest cell that is left
        left.remove(at)
        parts = -(-queries[at][0] // block)
        share = -(-queries[at][0] // parts)
        for _ in range(parts):
            if share > room:
                number, room = number + 1, block
            room -= share
            groups[at].append(number)
    group_low, group_high = np.full((number + 1, n), np.inf), np.full((number + 1, n), -np.inf)
    for i, own in enumerate(groups):
        for g in own:
            group_low[g] = np.minimum(group_low[g], low[i])
            group_high[g] = np.maximum(group_high[g], high[i])
    return Plan(low, high, groups, group_low, group_high)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        place = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))[:k]]


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
          key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS,
          query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows with the highest inner product with
    each query, ties to the smaller id; queries are the rows whose id is divisible by `every`.

    Components are floor(scale * x). Rows whose id or vector is null, or whose vector holds a null
    or a number that isn't finite, take no part. A row that repeats id and vector is searched once, and
    stands in a result as often as it is there. Rows with the query's id are never its neighbours;
    queries that share an id share a result, and the same query again adds nothing. Vectors
    of unlike width are compared over the components both have; components and scores must fit
    64 bits. With fewer candidates than k, all
    are returned; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    vectors = staged(embeddings.select(F.col(key).cast("long"), F.col(vector))
                     .mapInArrow(lambda b: _vectors(b, scale),
                                 "vec_id long, vec binary, square double")
                     .groupBy("vec_id", "vec", "square").agg(F.count("*").alias("copies")))
    rows, most, width = vectors.agg(F.count("*"), F.max("square"),
                                    F.max(F.octet_length("vec"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not rows:
        return empty
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(pivots).collect()
    own = matrix([r["vec"] for r in chosen], width // 8).astype(np.float64)
    space = Space(own, np.sqrt(np.maximum(most - (own ** 2).sum(axis=1), 0)), most, width // 8)

    data = staged(_assigned(vectors, space, False))
    queries = staged(_assigned(vectors.filter(F.col("vec_id") % every == 0), space, True))
    by_cell = {r["cell"]: (r["n"], r["reach"]) for r in queries.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("reach")).collect()}
    if not by_cell:
        return empty
    reach = k + queries.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far"))
    nearest: dict[int, list[float]] = {}
    for r in (data.select("cell", "far").withColumn("place", place)
              .filter(F.col("place") <= reach).collect()):          # pivots * reach numbers
        nearest.setdefault(r["cell"], []).append(r["far"])
    shared = spark.sparkContext.broadcast(plan(space, by_cell, nearest, reach, query_block))

    # A query goes to one group, and there to every block; a row to the groups that may need it.
    blocks = -(-rows // data_block)
    group_of = F.lit(None).cast("array<int>")
    for cell, groups in enumerate(shared.value.groups):
        if groups:
            group_of = F.when(F.col("cell") == cell, F.array(*map(F.lit, groups))).otherwise(group_of)
    asked = (queries.withColumn("groups", group_of)
             .withColumn("g", F.element_at("groups", (F.pmod(F.xxhash64("vec_id", "vec"),
                                                             F.size("groups")) + 1).cast("int")))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select("g", "b", "vec_id", "vec", "cell"))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            cell, far = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for g in range(len(p.group_low)):
                keep = (far >= p.group_low[g, cell]) & (far <= p.group_high[g, cell])
                part = batch.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), g, np.int32)), *part.columns],
                    ["g", "vec_id", "vec", "cell", "far", "copies"])
    needed = (data.mapInArrow(replicate, "g int, vec_id long, vec binary, cell int, far double, "
                                         "copies long")
              .withColumn("b", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int")))
    exact = most < EXACT        # then products and their sums are whole numbers in a double
    kind, wide = (np.float64 if exact else np.int64), width // 8

    def solve(asked: pa.Table, found: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        order = np.argsort(found.column("vec_id").to_numpy(), kind="stable")
        found = found.take(order)
        ids, cell, far, copies = (found.column(c).to_numpy()
                                  for c in ("vec_id", "cell", "far", "copies"))
        them = matrix(found.column("vec").to_pylist(), wide).astype(kind)
        query_ids, query_cell = (asked.column(c).to_numpy() for c in ("vec_id", "cell"))
        us = matrix(asked.column("vec").to_pylist(), wide).astype(kind)
        p = shared.value
        for c in np.unique(query_cell).tolist():
            near = np.flatnonzero((far >= p.low[c, cell]) & (far <= p.high[c, cell]))
            rows_of = np.flatnonzero(query_cell == c)
            for at in range(0, len(rows_of), ROWS_AT_ONCE):
                some = rows_of[at:at + ROWS_AT_ONCE]
                scores = (us[some] @ them[near].T).astype(np.int64)
                for q, line in zip(query_ids[some].tolist(), scores):
                    other = ids[near] != q
                    top = best(line[other], ids[near][other], k)
                    out[0] += [q] * len(top)
                    out[1] += ids[near][other][top].tolist()
                    out[2] += line[other][top].tolist()
                    out[3] += copies[near][other][top].tolist()
        return pa.table({n: pa.array(v, pa.int64())
                         for n, v in zip(("query_id", "vec_id", "score", "copies"), out)})
    partial = (asked.groupBy("g", "b").cogroup(needed.groupBy("g", "b"))
               .applyInArrow(solve, "query_id long, vec_id long, score long, copies long"))
    times = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (partial.withColumn("copy", F.explode(times)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
