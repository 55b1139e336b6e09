"""URL filters: rules by host and path, and for all other URLs logistic regression on hashed
character n-grams of host and path, trained from a small labelled table. DataFrame functions and
Spark's own learner only."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import named, quoted, staged

NGRAM = 3
FEATURES = 1 << 12
ITERATIONS, PENALTY = 30, 0.01
#: Different (host, path) of each verdict that the model may learn from: the first by a hash.
PER_VERDICT = 2_500
ALLOW, BLOCK = "allow", "block"
NEW = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from there
    up to `?`, `#` or the end. Null, or no `://`: both empty."""
    text = F.coalesce(url, F.lit(""))
    place = F.locate("://", text)
    rest = F.when(place > 0, F.substring(text, place + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equally long ones the first by name. A
    rule fits its host and all subdomains, if the path starts with the rule's."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def ngrams(text: Column) -> Column:
    """Character n-grams, repeats included; the text itself if it is shorter."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (NGRAM - 1), F.lit(1)))
    return F.transform(places, lambda at: F.substring(text, at, F.lit(NGRAM)))


def features(df: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """N-grams of host and path are told apart by a prefix, and hashed to FEATURES counts."""
    marked = lambda mark, text: F.transform(       # noqa: E731
        ngrams(F.concat(F.lit("^"), text, F.lit("$"))), lambda g: F.concat(F.lit(mark), g))
    grams = F.concat(marked("h:", F.col(host)), marked("p:", F.col(path)))
    return (HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="_features")
            .transform(df.withColumn("_grams", grams)).drop("_grams"))


def learn(labelled: DataFrame):
    """A model from (host, path, verdict), or the only verdict there is ("allow" if none). Rows are
    told apart first, so a frequent URL is one lesson; PER_VERDICT of each verdict are taken, and
    balanced by weights."""
    rows = (labelled.select("host", "path", "verdict").distinct()
            .withColumn("_order", F.xxhash64("host", "path")))
    taken = [rows.filter(F.col("verdict") == v).orderBy("_order", "host", "path").limit(PER_VERDICT)
             for v in (ALLOW, BLOCK)]
    few = staged(features(taken[0].union(taken[1])
                          .withColumn("label", (F.col("verdict") == BLOCK).cast("double")))
                 .select("_features", "label"))
    counts = {r["label"]: r["count"] for r in few.groupBy("label").count().collect()}
    if len(counts) < 2:
        return BLOCK if counts.get(1.0) else ALLOW
    share = counts[1.0] / sum(counts.values())
    weighted = few.withColumn("weight", F.when(F.col("label") == 1.0, 0.5 / share)
                              .otherwise(0.5 / (1 - share)))
    return LogisticRegression(featuresCol="_features", labelCol="label", weightCol="weight",
                              maxIter=ITERATIONS, regParam=PENALTY, probabilityCol="_chance",
                              rawPredictionCol="_raw", predictionCol="_blocked").fit(weighted)


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None,
          url: str = "url") -> DataFrame:
    """All rows and columns with host, path, rule (its name, or null) and verdict: the rule's, else
    the model's. `labelled` has columns url and verdict; without it, the pages that a rule decides
    teach the model. A URL that has no host is judged by the model on empty strings. Equal URLs have
    equal verdicts. Columns of the input with these four names are replaced; an empty table gives no
    rows.
    """
    given = pages.select(F.struct(*named(pages)).alias("row"), F.col(quoted(url)).alias("url"))
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    ruled = (given.withColumns(dict(zip(("host", "path"), host_and_path(F.col("url")))))
             .withColumn("rule", name).withColumn("verdict", verdict))
    if labelled is None:
        lessons = ruled.filter(F.col("rule").isNotNull()).select("host", "path", "verdict")
    else:
        host, path = host_and_path(F.col("url"))
        lessons = labelled.select(host.alias("host"), path.alias("path"), "verdict")
    model = learn(lessons)
    if isinstance(model, str):
        judged = ruled.withColumn("verdict", F.coalesce("verdict", F.lit(model)))
    else:
        learned = F.when(F.col("_blocked") == 1.0, BLOCK).otherwise(ALLOW)
        judged = (model.transform(features(ruled))
                  .withColumn("verdict", F.coalesce("verdict", learned)))
    kept = [F.col(f"row.{quoted(c)}") for c in pages.columns if c not in NEW]
    return judged.select(*kept, *NEW)
