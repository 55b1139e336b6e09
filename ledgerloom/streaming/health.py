"""Stream health as tables: a progress log, a batch-report log and a run log, and the reports over
them. A log has one row per trigger, batch or run, not per message."""
from __future__ import annotations

import json
import threading
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerloom.functions.columns import moment
from ledgerloom.operators.dedup import first_per
from ledgerloom.operators.tables import Table

PROGRESS_DDL = ("job STRING, query STRING, event STRING, logged_at TIMESTAMP, input_rate DOUBLE, "
                "processed_rate DOUBLE, batch_seconds DOUBLE, source STRING, input_rows BIGINT, "
                "end_offset STRING, latest_offset STRING, error STRING")
REPORT_DDL = "job STRING, batch_id BIGINT, logged_at TIMESTAMP, counter STRING, label STRING, n DOUBLE"
# Readiness, liveness and alert limits.
READY_SECONDS, LIVE_SECONDS = 120, 600
NO_PROGRESS_SECONDS, NO_PROGRESS_HOLD = 120, 300
BACKLOG_LIMIT, BACKLOG_HOLD = 5_000, 60
REPORT_HOUR = 6


class ProgressLog(StreamingQueryListener):
    """Buffers query events, a progress once for every source of the query; `flush` appends them to
    the log table from the caller's thread."""

    def __init__(self, job: str):
        self.job, self._rows, self._names = job, [], {}
        self._lock = threading.Lock()

    def _add(self, query, event, *, error=None, progress=None):
        p = progress or {}
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        seconds = (p.get("durationMs") or {}).get("triggerExecution")
        rows = [(self.job, query, event, now, float(s.get("inputRowsPerSecond") or 0),
                 float(s.get("processedRowsPerSecond") or 0),
                 None if seconds is None else seconds / 1000, s.get("description"),
                 int(s.get("numInputRows") or 0), _text(s.get("endOffset")),
                 _text(s.get("latestOffset")), error) for s in p.get("sources") or [{}]]
        with self._lock:
            self._rows += rows

    def onQueryStarted(self, event):
        self._names[str(event.id)] = event.name or str(event.id)
        self._add(self._names[str(event.id)], "started")

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        self._add(p.get("name") or p["id"], "progress", progress=p)

    def onQueryIdle(self, event):
        self._add(self._names.get(str(event.id), str(event.id)), "idle")

    def onQueryTerminated(self, event):
        self._add(self._names.get(str(event.id), str(event.id)), "terminated",
                  error=event.exception or None)

    def flush(self, table: Table) -> int:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            table.append(table.spark.createDataFrame(rows, PROGRESS_DDL))
        return len(rows)


def _text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value)


def batch_report(spark: SparkSession, job: str, batch_id: int,
                 counts: list[tuple[str, str, float]]) -> DataFrame:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(job, batch_id, now, name, label, float(n)) for name, label, n in counts], REPORT_DDL)


# ------------------------------------------------------------------ reports
def topic_backlog(progress: DataFrame) -> DataFrame:
    """Messages behind per log row and topic: the sum over partitions of latest minus processed
    offset, not below zero; a partition without a processed offset starts at 0. Offsets are JSON
    objects, or JSON objects inside a JSON string."""
    def offsets(c):
        unquoted = F.get_json_object(F.concat(F.lit('{"v":'), F.col(c), F.lit("}")), "$.v")
        return F.from_json(unquoted, "map<string, map<string, bigint>>")

    behind = F.aggregate(
        F.map_entries("parts"), F.lit(0).cast("bigint"),
        lambda acc, e: acc + F.greatest(
            e["value"] - F.coalesce(F.try_element_at(F.col("done"), e["key"]), F.lit(0)),
            F.lit(0)))
    return (progress.withColumns({"_latest": offsets("latest_offset"),
                                  "_end": offsets("end_offset")})
            .select("query", "logged_at", "_end", F.explode("_latest").alias("topic", "parts"))
            .withColumn("done", F.try_element_at(F.col("_end"), F.col("topic")))
            .select("query", "logged_at", "topic", behind.alias("lag")))


def current_backlog(progress: DataFrame) -> DataFrame:
    newest = first_per(progress.filter("latest_offset IS NOT NULL"), ["query", "source"],
                       [F.col("logged_at").desc(), F.col("latest_offset").desc()])
    return topic_backlog(newest).select("query", "topic", "lag")


def query_health(progress: DataFrame, now=None, max_age: int = READY_SECONDS) -> DataFrame:
    """Age of the last sign of life, whether the query runs, and whether it is healthy."""
    at, event = F.col("logged_at"), F.col("event")
    alive = F.when(event != "terminated", at)
    lifecycle = F.when(event.isin("started", "terminated"), at)
    age = F.unix_seconds(moment(now)) - F.unix_seconds(F.col("last_seen").cast("timestamp"))
    healthy = (F.col("active") & F.col("error").isNull() & (F.col("age_s") < max_age))
    return (progress.groupBy("query")
            .agg(F.max(alive).alias("last_seen"),
                 F.coalesce(F.max_by(event, lifecycle) != "terminated", F.lit(True))
                 .alias("active"),
                 F.max("error").alias("error"),
                 F.sum("input_rows").alias("input_rows"))
            .withColumn("age_s", age)
            .withColumn("healthy", F.coalesce(healthy, F.lit(False)))
            .select("query", "last_seen", "age_s", "active", "error", "input_rows", "healthy"))


def all_healthy(health: DataFrame) -> bool:
    """A probe: at least one query, and every one healthy."""
    row = health.agg(F.count("*").alias("n"), F.count_if("healthy").alias("ok")).first()
    return row["n"] > 0 and row["n"] == row["ok"]


def counters(reports: DataFrame) -> DataFrame:
    """Totals of rows, alerts and dead letters; the country lag is a maximum, not a sum. A batch
    that was replayed counts once, with its last report."""
    is_lag = F.col("counter") == "country_lag"
    once = reports.groupBy("job", "counter", "label", "batch_id").agg(
        F.max_by("n", "logged_at").alias("n"))
    return once.withColumn("_lag", is_lag).groupBy("job", "counter", "label").agg(
        F.when(F.first("_lag"), F.max("n")).otherwise(F.sum("n")).alias("value"))


def slo_breaches(progress: DataFrame, runs: DataFrame, now=None) -> DataFrame:
    """The three alert conditions at `now`. "For five minutes" is part of the condition: it must
    have held at every moment of the trailing interval. All are plain aggregations."""
    clock = moment(now)
    seconds = F.unix_seconds(F.col("logged_at").cast("timestamp"))
    now_s = F.unix_seconds(clock)
    past = progress.filter(F.col("logged_at") <= clock)

    silent = past.filter("event <> 'terminated'").groupBy(F.col("query").alias("subject")).agg(
        (now_s - F.max(seconds) > NO_PROGRESS_SECONDS + NO_PROGRESS_HOLD).alias("breached"))

    total = topic_backlog(past).groupBy("query", "logged_at").agg(F.sum("lag").alias("lag"))
    recent = seconds > now_s - BACKLOG_HOLD
    backlog = total.groupBy(F.col("query").alias("subject")).agg(
        (F.coalesce(F.min(F.when(recent, F.col("lag"))) > BACKLOG_LIMIT, F.lit(True))
         & F.coalesce(F.max_by("lag", F.when(~recent, F.col("logged_at"))) > BACKLOG_LIMIT,
                      F.lit(False))).alias("breached"))

    done = F.max(F.when(F.col("status") == "SUCCESS", F.col("logged_at")))
    failed = F.max(F.when(F.col("status") == "FAILED", F.col("logged_at")))
    midnight = F.date_trunc("day", clock)
    late = (F.hour(clock) >= REPORT_HOUR) & (F.coalesce(F.col("done") < midnight, F.lit(True)))
    broken = F.col("failed").isNotNull() & F.coalesce(F.col("failed") > F.col("done"),
                                                      F.lit(True))
    reports = (runs.filter(F.col("logged_at") <= clock).groupBy(F.col("job").alias("subject"))
               .agg(done.alias("done"), failed.alias("failed"))
               .select("subject", (late | broken).alias("breached")))

    named = [("no_progress", silent), ("backlog", backlog), ("report_missing", reports)]
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("slo"), "subject", "breached") for name, df in named])
