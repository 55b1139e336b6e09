"""Hard negatives by inner product, from lists that anchors of a cluster share (MAXIMUS).

Anchors are clustered by direction. With t the widest angle between a cluster's centroid and its
members, a candidate x at the angle a to the centroid scores |u| |x| cos(max(0, a - t)) at most with
any member u. A cluster's candidates are sorted by that bound once, without |u|; every member walks
the list and stops when the bound of what is left cannot change its result, which is thereby exact.

The list is dealt in two turns. First come the candidates that lie nearest to the cluster's own
centroid; what they give is each member's threshold. Then come those of other cells whose bound
reaches the lowest threshold of the cluster. Members and candidates of a cluster are cut into
blocks, and every two meet in a task, so a cluster may hold any share of all rows. Rows with the
same vector and label differ by their ids only; of these the smallest that a result can need are
carried on one row, with the number of their copies.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, staged
from ledgerloom.llm.knn import matrix

CLUSTERS, MEMBERS = 64, 32          # clusters at most, and anchors for each of them at least
SAMPLE, TURNS = 4096, 8             # anchors that centroids are fitted on, and how often
MEMBER_BLOCK, LIST_BLOCK = 512, 16_384
STEP = 256                          # candidates of a list that members look at together
BUCKETS = 16                        # of labels, each with its own threshold
SLACK = 1e-7                        # bounds are widened by it, so that rounding loses nothing
EXACT = 2.0 ** 53
NONE = -(1 << 62)


def _rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows that take part: id, label as text, components floor(scale * x) packed, length."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for vec_id, label, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if None in (vec_id, label, values) or None in values:
                continue
            x = np.array(values, dtype=np.float64)
            if np.isfinite(x).all():
                whole = np.floor(scale * x)
                for column, value in zip(out, (vec_id, label, whole.astype("<i8").tobytes(),
                                               float(np.sqrt(whole @ whole)))):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.string(), pa.binary(), pa.float64()))],
            ["vec_id", "label", "vec", "norm"])


# ---- clusters

class Cells:
    """Unit centroids; the last cell, without one, is for anchors of length zero."""

    def __init__(self, sample: np.ndarray, n: int):
        units = _units(sample)
        self.centroids = units[np.linspace(0, len(units) - 1, n).astype(int)] if len(units) else units
        for _ in range(TURNS if len(units) else 0):
            own = (units @ self.centroids.T).argmax(axis=1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, units)
            lengths = np.linalg.norm(sums, axis=1, keepdims=True)
            self.centroids = np.where(lengths > 0, sums / np.maximum(lengths, 1e-300), self.centroids)
        self.width = sample.shape[1]

    def angles(self, packed: list[bytes]) -> np.ndarray:
        """Of each vector to each centroid; of a zero vector: a right angle, its products are 0."""
        units = _units(matrix(packed, self.width).astype(np.float64))
        return np.arccos(np.clip(units @ self.centroids.T, -1, 1))


def _units(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def bounds(norm: np.ndarray, angle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What candidates can score with members of length 1, at most: by candidate and cell."""
    reach = norm[:, None] * np.cos(np.maximum(0, angle - spread - SLACK))
    return np.c_[np.maximum(reach, 0) * (1 + SLACK), np.zeros(len(norm))]


# ---- walking a list

def walk(us: dict, them: dict, want: int, same: bool, width: int, exact: bool):
    """The best `want` candidates of every question, as arrays (question, score, candidate).

    us: vec and norm by anchor; by question: who (the place of its anchor), vec_id, label, low, high.
    them: one entry a candidate in the order of the list: row (its place in vec),
    bound, vec_id, label. A score counts from low to high, of rows with the question's label, or
    with another one, and another id.
    """
    kind = np.float64 if exact else np.int64
    anchors, rows = (matrix(side["vec"], width).astype(kind) for side in (us, them))
    who, n = us["who"], len(us["who"])
    scores = np.full((n, want), NONE, np.int64)
    found = np.full((n, want), -1, np.int64)
    ids = np.append(them["vec_id"], np.iinfo(np.int64).max)
    # The smallest id from a place of the list on decides whether ties can still count.
    rest = np.minimum.accumulate(ids[::-1])[::-1]
    for at in range(0, len(them["row"]), STEP):
        most = np.floor(us["norm"][who] * them["bound"][at] + SLACK)
        last, last_id = scores[:, -1], ids[found[:, -1]]
        open_ = (most >= us["low"]) & ((most > last) | ((most == last) & (rest[at] < last_id)))
        asking = np.flatnonzero(open_)
        if not len(asking):
            break
        to = slice(at, at + STEP)
        some, place = np.unique(who[asking], return_inverse=True)
        products = (anchors[some] @ rows[them["row"][to]].T).astype(np.int64)[place]
        fits = (us["label"][asking, None] == them["label"][None, to]) == same
        fits &= us["vec_id"][asking, None] != them["vec_id"][None, to]
        fits &= (products >= us["low"][asking, None]) & (products <= us["high"][asking, None])
        new = np.where(fits, products, NONE)
        numbers = np.broadcast_to(np.arange(at, at + new.shape[1]), new.shape)
        both = np.c_[scores[asking], new]
        which = np.c_[found[asking], np.where(fits, numbers, -1)]
        order = np.lexsort((ids[which], -both), axis=1)[:, :want]
        scores[asking] = np.take_along_axis(both, order, axis=1)
        found[asking] = np.take_along_axis(which, order, axis=1)
    question, column = np.nonzero(found >= 0)
    return question, scores[question, column], found[question, column]


FOUND = "anchor long, tag long, score long, vec_id long, copies long"


def _listed(us: pa.Table, them: pa.Table, want: int, same: bool, width: int, exact: bool) -> pa.Table:
    """One block of a cluster's members and one of its list."""
    if not len(us) or not len(them):
        return pa.table({f.split()[0]: pa.array([], pa.int64()) for f in FOUND.split(", ")})
    labels = pa.chunked_array([*us.column("label").chunks, *them.column("label").chunks])
    codes = labels.combine_chunks().dictionary_encode().indices.to_numpy()
    who = np.repeat(np.arange(len(us)), [len(x) for x in us.column("tag").to_pylist()])
    asked = {"vec": us.column("vec").to_pylist(), "norm": us.column("norm").to_numpy(), "who": who,
             "vec_id": us.column("vec_id").to_numpy()[who], "label": codes[:len(us)][who],
             **{c: us.column(c).combine_chunks().flatten().to_numpy() for c in ("low", "high", "tag")}}
    row = np.repeat(np.arange(len(them)), [len(x) for x in them.column("ids").to_pylist()])
    ids, copies = (them.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "copies"))
    bound = them.column("bound").to_numpy()[row]
    order = np.lexsort((ids, -bound))
    listed = {"vec": them.column("vec").to_pylist(), "row": row[order], "bound": bound[order],
              "vec_id": ids[order], "label": codes[len(us):][row[order]]}
    question, score, place = walk(asked, listed, want, same, width, exact)
    return pa.table({"anchor": us.column("anchor").to_numpy()[who[question]],
                     "tag": asked["tag"][question], "score": score,
                     "vec_id": ids[order][place], "copies": copies[order][place]})


class _Search:
    """Candidates with their cells, and the turns of a search over them."""

    def __init__(self, items: DataFrame, cells: Cells, spread: np.ndarray, exact: bool):
        self.items, self.spark, self.exact = items, items.sparkSession, exact
        self.width = cells.width
        self.shared = self.spark.sparkContext.broadcast((cells, spread))    # CLUSTERS vectors

    def _dealt(self, least: np.ndarray | None) -> DataFrame:
        """(cell, bound) and the row, of candidates at home; or in other cells whose least bound, by
        cell and bucket of labels, they reach."""
        shared, fields = self.shared, "cell int, bound double, vec binary, label string, bucket int, " \
                                      "ids array<long>, copies array<long>"

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, spread = shared.value
            for batch in batches:
                norm, bucket = batch.column(1).to_numpy(), batch.column(3).to_numpy()
                angles = cells.angles(batch.column(0).to_pylist())
                bound = bounds(norm, angles, spread)
                home = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(norm), int)
                goes = np.zeros(bound.shape, bool)
                goes[np.arange(len(norm)), home] = True
                if least is not None:
                    goes = ~goes & (bound >= least[:, bucket].T)
                row, cell = np.nonzero(goes)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(bound[row, cell]),
                     *(taken.column(i) for i in (0, 2, 3, 4, 5))],
                    ["cell", "bound", "vec", "label", "bucket", "ids", "copies"])
        return (self.items.select("vec", "norm", "label", "bucket", "ids", "copies")
                .mapInArrow(deal, fields))

    def _turn(self, asked: DataFrame, least: np.ndarray | None, want: int, same: bool) -> DataFrame:
        dealt = self._dealt(least)

        def blocks(frame: DataFrame, size: int) -> DataFrame:
            return frame.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
        # One row a cell: how many blocks its members and its list make.
        cut = staged(blocks(asked, MEMBER_BLOCK).withColumnRenamed("n", "members")
                     .join(blocks(dealt, LIST_BLOCK).withColumnRenamed("n", "lists"), "cell"))

        def spread_over(frame: DataFrame, own: str, other: str, salt: list[str]) -> DataFrame:
            return (frame.join(F.broadcast(cut), "cell")            # CLUSTERS rows
                    .withColumn(f"{own}_block", F.pmod(F.xxhash64(*salt), F.col(own)).cast("int"))
                    .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                    .drop("members", "lists"))
        key, width, exact = ("cell", "members_block", "lists_block"), self.width, self.exact
        us = spread_over(asked, "members", "lists", ["anchor"]).groupBy(*key)
        them = spread_over(dealt, "lists", "members", ["vec", "label"]).groupBy(*key)
        return us.cogroup(them).applyInArrow(
            lambda u, t: _listed(u, t, want, same, width, exact), FOUND)

    def best(self, asked: DataFrame, want: int, same: bool) -> DataFrame:
        """The best `want` rows of every question. asked: anchor, vec_id, label, bucket, cell, vec,
        norm, and arrays low, high and tag, one element a question; tags tell questions apart."""
        first = staged(self._turn(asked, None, want, same))
        place = Window.partitionBy("anchor", "tag").orderBy(F.col("score").desc(), "vec_id")
        full = (first.withColumn("place", F.row_number().over(place)).filter(F.col("place") == want)
                .select("anchor", "tag", "score"))
        asking = asked.select("anchor", "cell", "bucket", "norm", F.explode(
            F.arrays_zip("low", "tag")).alias("q")).select(
                "anchor", "cell", "bucket", "norm", "q.low", "q.tag")
        # The lowest score that still counts, for a member of length 1.
        needed = F.coalesce("score", "low") / F.col("norm")
        lowest = (asking.join(full, ["anchor", "tag"], "left")
                  .groupBy("cell", F.col("bucket") if same else F.lit(0).alias("bucket"))
                  .agg(F.min(F.when(F.col("norm") > 0, needed).otherwise(0.0)).alias("needed")))
        least = np.full((len(self.shared.value[1]) + 1, BUCKETS), np.inf)
        for r in lowest.collect():                                  # CLUSTERS * BUCKETS rows
            least[r["cell"], r["bucket"] if same else slice(None)] = r["needed"] * (1 - SLACK)
        second = self._turn(asked, least, want, same)
        return first.union(second)


def _ranked(found: DataFrame, want: int, *group: str) -> DataFrame:
    """The first `want` rows of each group, copies counted one by one, with their rank."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec_id")
    times = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(want)).cast("int"))
    return (found.withColumn("copy", F.explode(times)).drop("copy", "copies")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want))


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50,
         scale: int = 256, low: int = 50, high: int = 95, key: str = "vec_id",
         vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`. Scores are inner products of components
    floor(scale * x); higher come first, ties by smaller id. An anchor's positives are its first
    `positives` rows of the same label; for each, the negatives are the first `negatives` rows of
    other labels whose score is from `low` to `high` percent of the positive's (none if that is
    negative). Fewer rows give fewer results.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part.
    Rows that share an id with the anchor are never its results. Repeated rows count one by one, as
    anchors too. Vectors of unlike width are compared over the components both have; components and
    scores must fit 64 bits, and 100 times a score too. Other columns aren't looked at, whatever
    their names. An empty table gives no rows.

    Centroids are fitted on SAMPLE anchors, chosen by a hash; they decide about speed only.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    rows = staged(embeddings.select(F.col(key).cast("long"), F.col(label).cast("string"), F.col(vector))
                  .mapInArrow(lambda b: _rows(b, scale), "vec_id long, label string, vec binary, norm double")
                  .withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    chosen = F.col("vec_id") % every == 0
    n, most, width = rows.agg(F.count_if(chosen), F.max("norm"), F.max(F.octet_length("vec"))).first()
    if not n:
        return empty
    # Of rows alike but for their ids, so many as any one result can have, and the anchor's own.
    alike = ["label", "bucket", "vec", "norm"]
    place = Window.partitionBy("label", "vec").orderBy("vec_id")
    items = staged(rows.groupBy(*alike, "vec_id").agg(F.count("*").alias("copies"))
                   .withColumn("place", F.row_number().over(place))
                   .filter(F.col("place") <= max(positives, negatives) + 1)
                   .groupBy(*alike).agg(F.sort_array(F.collect_list(F.struct("vec_id", "copies"))).alias("own"))
                   .select(*alike, F.col("own.vec_id").alias("ids"), F.col("own.copies").alias("copies")))
    anchors = rows.filter(chosen).withColumn("anchor", F.monotonically_increasing_id())
    sample = (anchors.filter("norm > 0").select("vec").distinct().orderBy(F.xxhash64("vec"), "vec")
              .limit(SAMPLE).collect())
    cells = Cells(matrix([r["vec"] for r in sample], width // 8).astype(np.float64),
                  min(CLUSTERS, -(-n // MEMBERS), max(1, len(sample))))
    shared = spark.sparkContext.broadcast(cells)                    # CLUSTERS vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = shared.value.angles(batch.column(2).to_pylist())
            zero = batch.column(3).to_numpy() == 0
            cell = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(zero), int)
            angle = np.where(zero, 0.0, angles[np.arange(len(zero)), cell] if angles.shape[1] else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.where(zero, angles.shape[1], cell).astype(np.int32)),
                 pa.array(angle)], [*batch.schema.names, "cell", "angle"])
    anchors = staged(anchors.mapInArrow(
        assign, "vec_id long, label string, vec binary, norm double, bucket int, anchor long, "
                "cell int, angle double"))
    spread = np.zeros(len(cells.centroids))
    for r in anchors.groupBy("cell").agg(F.max("angle").alias("angle")).collect():   # CLUSTERS rows
        if r["cell"] < len(spread):
            spread[r["cell"]] = r["angle"]
    search = _Search(items, cells, spread, most ** 2 < EXACT)

    whole = anchors.withColumns({"low": F.array(F.lit(NONE + 1)), "high": F.array(F.lit(-NONE)),
                                 "tag": F.array(F.lit(0).cast("long"))})
    likes = staged(_ranked(search.best(whole, positives, True), positives, "anchor")
                   .select("anchor", F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score")))
    # Ends that are whole numbers, inside the two shares; they are not negative.
    share = F.col("positive_score")
    windows = (likes.filter("positive_score >= 0").select(
        "anchor", share.alias("tag"), F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
        F.expr(f"{high} * positive_score div 100").alias("high")).distinct()
        .filter("low <= high").groupBy("anchor")
        .agg(F.collect_list(F.struct("low", "high", "tag")).alias("w"))
        .select("anchor", *[F.col(f"w.{c}").alias(c) for c in ("low", "high", "tag")]))
    asked = staged(anchors.join(windows, "anchor"))
    hard = (_ranked(search.best(asked, negatives, False), negatives, "anchor", "tag")
            .select("anchor", F.col("tag").alias("positive_score"), "rank",
                    F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    named = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (likes.join(hard, ["anchor", "positive_score"]).join(named, "anchor")
            .select(*empty.columns))
