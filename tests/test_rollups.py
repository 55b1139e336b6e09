"""Months from stored daily states, held against the events themselves."""
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.tables import Warehouse
from ledgerloom.plans import rollups, silver

MAY = datetime(2026, 5, 1, 8)
PAID = ("timestamp TIMESTAMP, txn_date DATE, event_month DATE, country_code STRING, currency STRING, "
        "sender_key STRING, is_aberrant BOOLEAN")
CLAIM = ("timestamp TIMESTAMP, op_month DATE, event_month DATE, country_code STRING, line_family STRING, "
         "processing_days INT, is_claim BOOLEAN")


def payments(spark, seed=1, n=3000, users=400):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        at = MAY + timedelta(days=rng.randrange(60), minutes=rng.randrange(600))
        # One user pays every third payment.
        user = "hot" if rng.random() < 0.33 else f"u{rng.randrange(users)}"
        rows.append((at, at.date(), at.date().replace(day=1), rng.choice(["CI", "SN"]), "XOF",
                     rng.choice([user, user, user, None]), rng.choice([False] * 9 + [True, None])))
    return spark.createDataFrame(rows, PAID), [r for r in rows if r[6] is False and r[5]]


def distinct_by(rows, group):
    found = {}
    for r in rows:
        found.setdefault(group(r), set()).add(r[5])
    return {g: len(users) for g, users in found.items()}


def test_numbers_are_dense_and_stay(spark):
    users = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("user_key")).repartition(7)
    first = rollups.numbered(users.unionByName(users.limit(50)).unionByName(
        spark.createDataFrame([(None,)], "user_key STRING")))
    assert first.agg(F.min("user_no"), F.max("user_no"), F.count_distinct("user_no")).first() == (1, 70_000, 70_000)
    more = rollups.numbered(users.limit(10).unionByName(
        spark.createDataFrame([("x",), ("y",)], "user_key STRING")), first)
    assert sorted(r.user_no for r in more.collect()) == [70_001, 70_002]
    assert rollups.numbered(users.limit(0), first).count() == 0


def test_users_of_months_and_to_date(spark):
    paid, kept = payments(spark)
    numbers = rollups.numbered(paid.select(F.col("sender_key").alias("user_key")))
    # Numbers far apart, so that groups have several blocks.
    far = numbers.withColumn("user_no", F.col("user_no") * 1000)
    states = rollups.daily_users(paid, far)
    assert states.select("block").distinct().count() > 3
    months = {(r.month, r.country_code): r.active_users for r in rollups.monthly_users(states).collect()}
    assert months == distinct_by(kept, lambda r: (r[2], r[3]))
    got = {(r.day, r.country_code): r.active_users for r in rollups.users_to_date(states).collect()}
    want = {}
    for day, land in {(r[1], r[3]) for r in kept}:
        want[day, land] = len({r[5] for r in kept if r[3] == land and r[2] == day.replace(day=1) and r[1] <= day})
    assert got == want
    total = rollups.users_of(states, F.lit("all").alias("g")).first()
    assert total.active_users == len({r[5] for r in kept})


def test_quantiles_of_a_month_from_its_days(spark):
    rng, rows = random.Random(3), []
    for _ in range(20_000):
        at = MAY + timedelta(days=rng.randrange(30))
        rows.append((at, date(2026, 5, 1), date(2026, 5, 1), "CI", "AUTO",
                     int(rng.expovariate(1 / 40)) if rng.random() < 0.95 else None, rng.random() < 0.9))
    frame = spark.createDataFrame(rows, CLAIM)
    month = rollups.monthly_claims(rollups.daily_claims(frame)).first()
    times = sorted(r[5] for r in rows if r[6] and r[5] is not None)
    assert month.nb_claims == len(times) and month.avg_processing_days == round(sum(times) / len(times), 1)
    for value, share in ((month.median_processing_days, 0.5), (month.p90_processing_days, 0.9)):
        low, high = (sum(t < value for t in times) / len(times), sum(t <= value for t in times) / len(times))
        assert low - rollups.RANK_ERROR <= share <= high + rollups.RANK_ERROR
    judged = rollups.within_error(rollups.monthly_claims(rollups.daily_claims(frame)), frame).first()
    assert judged.median_within and judged.p90_within
    wrong = rollups.monthly_claims(rollups.daily_claims(frame)).withColumn("median_processing_days", F.lit(90.0))
    assert not rollups.within_error(wrong, frame).first().median_within


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def put(warehouse, name, rows):
    warehouse.table("silver", name, silver.PARTITIONS[name]).replace_scope(rows, F.lit(True))


def test_stored_states(spark, warehouse):
    """New users and late rows of a stored month; a rerun changes nothing."""
    paid, kept = payments(spark, n=600, users=60)
    claims = spark.createDataFrame([(MAY, date(2026, 5, 1), date(2026, 5, 1), "CI", "AUTO", 9, True)], CLAIM)
    put(warehouse, "insurance_operations", claims)
    put(warehouse, "mobile_money_payments", paid.filter("timestamp < '2026-05-20'"))
    rollups.store(warehouse)
    put(warehouse, "mobile_money_payments", paid)
    rollups.store(warehouse)
    again = rollups.store(warehouse, since="2026-06-10")
    ids, users, times = rollups.tables(warehouse)
    assert again[rollups.USER_IDS] == 0
    numbers = [r.user_no for r in ids.read().collect()]
    assert sorted(numbers) == list(range(1, len({r[5] for r in kept}) + 1))
    months = {(r.month, r.country_code): r.active_users
              for r in rollups.monthly_users(users.read()).collect()}
    assert months == distinct_by(kept, lambda r: (r[2], r[3]))
    assert rollups.monthly_claims(times.read()).first().median_processing_days == 9.0
