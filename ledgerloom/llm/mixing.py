"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

The mean number of repetitions of a document is the target volume of its source over the volume it
has. Its count inverts the Poisson distribution at a number drawn from a hash of its id, so it is
the same in every run and on every executor. Copies are then dealt out by a hash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import free, quoted, staged, text_or_empty

#: The table of sources is sent to every task up to this many rows; beyond, it is joined.
BROADCAST_SOURCES = 10_000
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / F.lit(float(16 ** DIGITS))


def poisson_steps(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, ... as an array, as far as a double tells it from 1.
    Terms are kept as logarithms, so a large mean does not underflow."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    first = F.struct((-mean).alias("log_p"), F.exp(-mean).alias("at"),
                     F.array(F.exp(-mean)).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.ln(mean / k)
        at = state["at"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), at.alias("at"),
                        F.concat(state["steps"], F.array(at)).alias("steps"))
    return F.aggregate(F.sequence(F.lit(1), most), first, add, lambda s: s["steps"])


def volumes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Characters of each source; every document counts as one at least."""
    size = F.greatest(F.length(text_or_empty(text)), F.lit(1)).cast("long")
    return (docs.select(F.col(quoted(source)).alias("_source"), size.alias("_size"))
            .groupBy("_source").agg(F.sum("_size").alias("_volume")))


def rates(volume: DataFrame, weights: DataFrame | None = None, power: float = 0.5,
          epochs: float = 1.0) -> DataFrame:
    """Mean repetitions of each source. `weights` (source, weight) sets the target shares, a source
    without a row gets none; without it a share is proportional to the volume to `power`. The
    expected volume of the result is `epochs` times that of the input."""
    if weights is None:
        aimed = volume.withColumn("_weight", F.pow(F.col("_volume").cast("double"), F.lit(power)))
    else:
        given = (weights.groupBy(F.col("source").alias("_given"))
                 .agg(F.sum("weight").cast("double").alias("_weight")))
        aimed = (volume.join(given, F.col("_source").eqNullSafe(F.col("_given")), "left")
                 .drop("_given").fillna(0.0, ["_weight"]))
    total = aimed.agg(F.sum("_volume").alias("_all"), F.sum("_weight").alias("_all_weights"))
    rate = F.round(epochs * F.col("_weight") * F.col("_all")
                   / (F.nullif("_all_weights", F.lit(0.0)) * F.col("_volume")), 9)
    return aimed.join(F.broadcast(total)).select(     # an aggregate without keys: one row
        "_source", F.coalesce(rate, F.lit(0.0)).alias("_rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5,
        epochs: float = 1.0, seed: str = "mix", key: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """The documents, each as often as its count says, with `rate`, `copy` (from 0) and
    `shuffle_key`, dealt over partitions by `shuffle_key` and ordered by it inside each.

    Null sources are a source of their own. Null ids draw by the text's hash; repeated rows draw
    alike, and are dealt over partitions one by one. Empty texts count as one character; empty input
    gives no rows. Columns named rate, copy or shuffle_key are replaced, all others stay, whatever
    their names.
    """
    docs = docs.drop("rate", "copy", "shuffle_key")
    own, mean, steps, draw, count, salt = free(docs, "_source", "_rate", "_steps", "_draw", "_count",
                                               "_salt")
    table = staged(rates(staged(volumes(docs, source, text)), weights, power, epochs)
                   .withColumn("_steps", poisson_steps(F.col("_rate"))))
    few = table.count() <= BROADCAST_SOURCES
    table = table.toDF(own, mean, steps)
    identity = F.coalesce(F.col(quoted(key)).cast("string"),
                          F.concat(F.lit("text:"), F.md5(text_or_empty(text))))
    drawn = (docs.join(F.broadcast(table) if few else table,
                       F.col(quoted(source)).eqNullSafe(F.col(own)), "inner").drop(own)
             .withColumn(draw, uniform(F.lit(seed), identity))
             .withColumn(count, F.size(F.filter(steps, lambda c: c <= F.col(draw))))
             .filter(F.col(count) > 0).withColumn("rate", F.col(mean)))
    copies = (drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
              .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), identity,
                                                           F.col("copy").cast("string"))))
              .drop(mean, steps, draw, count)
              # Rows that share an id share all keys; their places tell them apart.
              .withColumn(salt, F.monotonically_increasing_id()))
    return (copies.repartition("shuffle_key", salt).drop(salt)
            .sortWithinPartitions("shuffle_key"))
