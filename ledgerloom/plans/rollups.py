"""Daily states of measures that do not add up: distinct users and quantiles.

Distinct counts of days cannot be summed, and neither can medians. What is stored per day can be
combined for any span of days, so a month is read from some thirty small rows a group and not from
its events:

* users as exact bitmaps. Every user has a dense number; a bitmap covers 32,768 numbers, and bitmaps
  of a group are combined bit by bit. The count of set bits is the exact number of distinct users.
* quantiles as KLL sketches, which merge. A quantile of a merged sketch is off by RANK_ERROR in rank
  at most, in 99 of 100 cases.

Late rows change their own day's state only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import month_of
from ledgerloom.functions.money import exact_ratio
from ledgerloom.operators.tables import Table, Warehouse
from ledgerloom.plans import gold, silver
from ledgerloom.session import durable

SKETCH_SIZE, RANK_ERROR = 800, 0.005
USER_GRAIN = ("country_code", "currency")
CLAIM_GRAIN = ("country_code", "line_family")
USER_IDS = "user_ids"


# ------------------------------------------------------------------ dense numbers
def numbered(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_key, user_no) of the users that `known` has no number for, from its highest number on,
    without gaps. `users`: one column user_key; nulls have no number.

    Rows are numbered where they are, each partition from where the one before ends; only partition
    sizes are gathered. The frame is checkpointed, so a lost executor renumbers nothing."""
    new = users.filter("user_key IS NOT NULL").select("user_key").distinct()
    first = 1
    if known is not None:
        new = new.join(known.select("user_key"), "user_key", "left_anti")
        first += known.agg(F.coalesce(F.max("user_no"), F.lit(0))).first()[0]
    place = durable(new.withColumn("place", F.monotonically_increasing_id()))
    # Spark's ids have the partition above 33 bits, and the place in it below.
    parted = place.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (parted.groupBy("part").agg(F.count("*").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    return parted.join(sizes, "part").select("user_key", (
        F.lit(first) + F.col("ahead") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("user_no"))


# ------------------------------------------------------------------ users
def daily_users(payments: DataFrame, numbers: DataFrame) -> DataFrame:
    """One bitmap per day, country, currency and block of 32,768 users."""
    paid = gold.usable(payments).select(F.col("txn_date").alias("day"), *USER_GRAIN,
                                        F.col("sender_key").alias("user_key"))
    # A user of a day is one row before the lookup, however often they paid.
    once = paid.filter("user_key IS NOT NULL").distinct()
    return (once.join(numbers, "user_key")
            .groupBy("day", *USER_GRAIN, F.bitmap_bucket_number("user_no").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users")))


def users_of(states: DataFrame, *grain: str | Column) -> DataFrame:
    """Distinct users of any grain over daily states: the bitmaps of a block are united, then counted."""
    names = [F.col(g) if isinstance(g, str) else g for g in grain]
    united = states.groupBy(*names, "block").agg(F.bitmap_or_agg("users").alias("users"))
    return (united.withColumn("n", F.bitmap_count("users")).drop("users", "block")
            .groupBy(*[c for c in united.columns if c not in ("block", "users")])
            .agg(F.sum("n").alias("active_users")))


def monthly_users(states: DataFrame) -> DataFrame:
    return users_of(states, month_of("day").alias("month"), *USER_GRAIN)


def users_to_date(states: DataFrame) -> DataFrame:
    """Distinct users from the first of the month to each day on which the group has any."""
    days = states.select("day", *USER_GRAIN).distinct().withColumn("month", month_of("day"))
    earlier = states.withColumn("month", month_of("day")).withColumnRenamed("day", "_day")
    return users_of(days.join(earlier, ["month", *USER_GRAIN]).filter("_day <= day"), "day", *USER_GRAIN)


# ------------------------------------------------------------------ claim times
def daily_claims(operations: DataFrame) -> DataFrame:
    """Number, sum and sketch of processing days by day, country and line."""
    days = F.col("processing_days")
    return (operations.filter(gold.CLAIM_TIME.keep)
            .groupBy(F.to_date("timestamp").alias("day"), *CLAIM_GRAIN)
            .agg(F.count("*").alias("nb_claims"), F.sum(days.cast("bigint")).alias("sum_days"),
                 F.kll_sketch_agg_double(days.cast("double"), SKETCH_SIZE).alias("times")))


def claims_of(states: DataFrame, *grain: str | Column) -> DataFrame:
    """Claims of any grain over daily states; median and ninetieth percentile by merged sketches."""
    merged = states.groupBy(*grain).agg(
        F.sum("nb_claims").alias("nb_claims"), F.sum("sum_days").alias("sum_days"),
        F.kll_merge_agg_double("times", SKETCH_SIZE).alias("times"))
    mean = exact_ratio(F.col("sum_days"), F.col("nb_claims"), 1)
    return merged.withColumns({
        "avg_processing_days": mean.cast("double"),
        **{name: F.kll_sketch_get_quantile_double("times", F.lit(share))
           for name, share in (("median_processing_days", 0.5), ("p90_processing_days", 0.9))},
    }).drop("sum_days", "times")


def monthly_claims(states: DataFrame) -> DataFrame:
    return claims_of(states, month_of("day").alias("month"), *CLAIM_GRAIN)


def within_error(found: DataFrame, operations: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """Of monthly claims whether each quantile's rank among the month's claims is off by `error` at
    most. A value that many claims have covers a span of ranks."""
    own = operations.filter(gold.CLAIM_TIME.keep).select(
        F.col("op_month").alias("month"), *CLAIM_GRAIN, F.col("processing_days").cast("double").alias("t"))
    names = {"median": ("median_processing_days", 0.5), "p90": ("p90_processing_days", 0.9)}
    ranks = own.join(found, ["month", *CLAIM_GRAIN]).groupBy(
        "month", *CLAIM_GRAIN, "nb_claims", "avg_processing_days").agg(*[
        c for name, (column, _) in names.items() for c in (
            F.count_if(F.col("t") < F.col(column)).alias(f"{name}_low"),
            F.count_if(F.col("t") <= F.col(column)).alias(f"{name}_high"))])
    return ranks.select("month", *CLAIM_GRAIN, "nb_claims", "avg_processing_days", *[
        ((F.col(f"{name}_low") <= (share + error) * F.col("nb_claims") + 1)
         & (F.col(f"{name}_high") >= (share - error) * F.col("nb_claims") - 1)).alias(f"{name}_within")
        for name, (_, share) in names.items()])


# ------------------------------------------------------------------ stored states
def tables(warehouse: Warehouse) -> tuple[Table, Table, Table]:
    """Numbers of users, states of users, states of claims. States lie by month."""
    return (warehouse.table("audit", USER_IDS),
            warehouse.table("gold", "mobile_users_daily", ("month",)),
            warehouse.table("gold", "claim_times_daily", ("month",)))


def store(warehouse: Warehouse, since: str | None = None, until: str | None = None) -> dict[str, int]:
    """Writes the states of the months from `since` to `until` (all by default); rows per table.

    New users get their numbers first: a run cut short leaves numbers that nothing uses yet, and the
    next one goes on from them. Months are replaced whole, so a rerun changes nothing."""
    def read(name: str) -> DataFrame:
        rows = warehouse.table("silver", name, silver.PARTITIONS[name]).read()
        month = F.col("event_month")
        for limit, test in ((since, month.__ge__), (until, month.__le__)):
            if limit:
                rows = rows.filter(test(F.trunc(F.lit(limit).cast("date"), "month")))
        return rows
    ids, users, claims = tables(warehouse)
    payments = read("mobile_money_payments")
    new = durable(numbered(gold.usable(payments).select(F.col("sender_key").alias("user_key")),
                           ids.read_or_none()))
    written = {USER_IDS: new.count()}
    if written[USER_IDS] or ids.read_or_none() is None:
        ids.append(new)
    states = {users: daily_users(payments, ids.read()), claims: daily_claims(read("insurance_operations"))}
    for table, rows in states.items():
        written[table.path.rsplit("/", 1)[-1]] = table.overwrite_partitions(
            rows.withColumn("month", month_of("day")))
    return written
