from datetime import datetime

from ledgerloom.streaming import health

DDL = ("query STRING, event STRING, logged_at TIMESTAMP, input_rows BIGINT, error STRING, "
       "end_offset STRING, latest_offset STRING")
RUNS = "job STRING, logged_at TIMESTAMP, status STRING"


def at(h, m=0, s=0, d=4):
    return datetime(2026, 5, d, h, m, s)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def offsets(behind):
    return '{"raw-a": {"0": 10}}', f'{{"raw-a": {{"0": {10 + behind}}}}}'


def lag(spark, end, latest):
    rows = health.topic_backlog(log(spark, ("q", "progress", at(1), 0, None, end, latest)))
    return {r["topic"]: r["lag"] for r in rows.collect()}


def test_backlog_sums_partitions(spark):
    assert lag(spark, '{"raw-a": {"0": 10, "1": 5}}', '{"raw-a": {"0": 15, "1": 5, "2": 7}}') == {"raw-a": 12}
    assert lag(spark, '"{\\"raw-a\\": {\\"0\\": 3}}"', '"{\\"raw-a\\": {\\"0\\": 15}}"') == {"raw-a": 12}
    assert lag(spark, None, '{"raw-a": {"0": 4}}') == {"raw-a": 4}
    assert lag(spark, None, None) == {} and lag(spark, "{}", "no json") == {}


def test_health_states(spark):
    rows = health.query_health(log(
        spark, ("ok", "started", at(9), 0, None, None, None), ("ok", "progress", at(9, 59), 5, None, None, None),
        ("old", "progress", at(9, 30), 5, None, None, None),
        ("dead", "progress", at(9, 59), 1, None, None, None), ("dead", "terminated", at(9, 59, 30), 0, "boom", None, None),
        ("back", "terminated", at(9), 0, None, None, None), ("back", "started", at(9, 59), 0, None, None, None)),
        "2026-05-04 10:00:00")
    got = {r["query"]: (r["active"], r["healthy"], r["age_s"]) for r in rows.collect()}
    assert got == {"ok": (True, True, 60), "old": (True, False, 1800), "dead": (False, False, 60),
                   "back": (True, True, 60)}
    assert not health.all_healthy(rows) and not health.all_healthy(rows.limit(0))
    assert health.all_healthy(rows.filter("query = 'ok'"))


def breaches(spark, progress, runs, now):
    frame = health.slo_breaches(log(spark, *progress), spark.createDataFrame(runs, RUNS), now)
    return {(r["slo"], r["subject"]): r["breached"] for r in frame.collect()}


def test_no_progress_must_last(spark):
    rows = [("q", "progress", at(9, 53, 30), 0, None, None, None)]
    assert breaches(spark, rows, [], "2026-05-04 10:00:00")[("no_progress", "q")] is False
    assert breaches(spark, rows, [], "2026-05-04 10:01:00")[("no_progress", "q")] is True


def test_backlog_must_last(spark):
    def p(minute, second, behind):
        return ("event_rules", "progress", at(9, minute, second), 0, None, *offsets(behind))
    high = [p(57, 0, 9000), p(58, 0, 9000), p(59, 30, 9000)]
    assert breaches(spark, high, [], "2026-05-04 10:00:00")[("backlog", "event_rules")] is True
    dip = [p(57, 0, 9000), p(59, 10, 10), p(59, 30, 9000)]
    assert breaches(spark, dip, [], "2026-05-04 10:00:00")[("backlog", "event_rules")] is False
    fresh = [p(57, 0, 10), p(59, 30, 9000)]
    assert breaches(spark, fresh, [], "2026-05-04 10:00:00")[("backlog", "event_rules")] is False


def test_missing_and_failed_reports(spark):
    def state(runs, now):
        return breaches(spark, [], runs, now)[("report_missing", "report")]
    done = [("report", at(0, 40), "SUCCESS")]
    assert state(done, "2026-05-04 07:00:00") is False
    assert state(done, "2026-05-05 05:00:00") is False        # not yet due
    assert state(done, "2026-05-05 06:00:00") is True
    assert state(done + [("report", at(1), "FAILED")], "2026-05-04 02:00:00") is True
    assert state([("report", at(1), "FAILED")], "2026-05-04 02:00:00") is True
