"""Registered queries against their oracle on the given tables. ORACLE_SF picks the scale;
ORACLE_ALL=1 runs all of them (about ten minutes), otherwise one per kind of operator."""
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from ledgerloom.catalog import registry
from ledgerloom.catalog.adapters import TABLES

FOLDER = os.path.join("/root/testdata", os.environ.get("ORACLE_SF", "sf0.001"))
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
CORE = ("skip_ingested_antijoin", "topic_as_table", "merge_insert_only", "merge_upsert_changed",
        "merge_stats", "reject_reasons", "validate_split", "orphan_split", "fx_convert",
        "silver_accounts", "silver_bank_transactions", "silver_insurance", "silver_mobile_money",
        "silver_loans", "dedup_in_batch", "daily_transaction_volume", "npl_ratio", "arpc_monthly",
        "cross_border_weekly", "regulatory_bank_daily", "dq_orphans", "top_products",
        "lambda_merged", "burst_alerts", "liquidity_alerts", "suppress_repeats", "parse_messages",
        "topic_lag", "stream_lag", "slo_breaches", "gold_daily_refreshed", "gold_weekly_refreshed",
        "gold_touched_groups", "active_users_monthly", "active_users_to_date", "claim_times_from_days",
        "csv_to_envelope", "to_message_json", "ingestion_log", "join_fx_broadcast", "pii_leak_scan")
NAMES = sorted(QUERIES) if os.environ.get("ORACLE_ALL") else CORE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def text(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = duck.execute(ORACLES[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    place = [found.index(c) for c in columns]
    want = sorted(tuple(text(row[i]) for i in place) for row in cursor.fetchall())
    got = sorted(tuple(text(row[c]) for c in columns) for row in frame.collect())
    assert got == want
