"""Gold without recomputing history: what changed since the last run, and only that.

Silver is summarised by digests, in one scan without joins that sends a row per day from each task: per table, country and day the number of rows and an order-free hash
of their contents. Two sets of digests differ exactly where rows came late, were corrected, or left
for the quarantine and came back; a silver run that writes the same rows again changes nothing. The
groups of an indicator that such a day belongs to are computed anew from silver, in the months that
hold them, and replace the groups of the stored table, also where no row is left.

Digests are kept per gold table as they were when it was built, written after it, so a run that is cut
short is repeated. Two indicators look beyond their own groups: the weekly corridors compare with the
week before, which is done over the stored totals, and the loan ratio needs the last repayment of
every loan and is of a date, so every run rebuilds it. Revenue per customer reads the
segment of customers, of any country, and is rebuilt when customers changed."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import moment
from ledgerloom.operators.tables import Warehouse, align
from ledgerloom.plans import gold, silver
from ledgerloom.session import durable

#: Columns that follow the clock of a run and not what a row holds; no indicator reads them.
STAMPS = ("_silver_processed_at", "_bronze_ingested_at", "tenure_days")
DIGEST_KEY = ("dataset", "country_code", "day")
DIGESTS = ("dataset STRING, country_code STRING, day DATE, nb BIGINT, low BIGINT, high BIGINT", ("dataset",))


def digests(rows: DataFrame, dataset: str) -> DataFrame:
    """One row per country and day of an event table, or per country of a referential (day NULL). The
    two hashes are sums and exclusive ors of unlike halves, so swapped or repeated rows show."""
    held = [F.col(f"`{c}`") for c in sorted(rows.columns) if c not in STAMPS]
    day = F.to_date("timestamp") if "timestamp" in rows.columns else F.lit(None).cast("date")
    content = F.xxhash64(*held)
    return (rows.select(F.col("country_code"), day.alias("day"), content.alias("h"))
            .groupBy("country_code", "day")
            .agg(F.count("*").alias("nb"), F.bit_xor("h").alias("low"),
                 F.sum(F.shiftrightunsigned("h", 34)).alias("high"))
            .select(F.lit(dataset).alias("dataset"), "country_code", "day", "nb", "low", "high"))


def touched(before: DataFrame | None, now: DataFrame) -> DataFrame:
    """(dataset, country_code, day) whose rows differ, on either side. The digests are as many as
    days and countries, whatever the rows."""
    if before is None:
        return now.select(*DIGEST_KEY)
    one, two = (side.select(*DIGEST_KEY, F.struct("nb", "low", "high").alias("mark"), F.lit(k).alias("side"))
                for k, side in enumerate((before, now)))
    return (one.unionByName(two).groupBy(*DIGEST_KEY)
            .agg(F.count("*").alias("sides"), F.min("mark").alias("least"), F.max("mark").alias("most"))
            .filter((F.col("sides") < 2) | (F.col("least") != F.col("most"))).select(*DIGEST_KEY))


@dataclass(frozen=True)
class Refresh:
    """How a gold table follows its inputs. `period`: the column of its groups and the unit of time
    that they span, none if it is rebuilt whole; `finish` is applied to all totals together."""
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    period: tuple[str, str] | None = None
    whole_if: tuple[str, ...] = ()
    finish: Callable[[DataFrame], DataFrame] | None = None

    @property
    def events(self) -> tuple[str, ...]:
        return tuple(n for n in self.inputs if n in silver.EVENTS)


def _of(name: str, *period: str, whole_if: tuple[str, ...] = ()) -> Refresh:
    table = gold.TABLES[name]
    return Refresh(table.build, table.inputs, period or None, whole_if)


TABLES = {
    "daily_transaction_volume": _of("daily_transaction_volume", "txn_date", "day"),
    "mobile_money_daily_flow": _of("mobile_money_daily_flow", "transaction_date", "day"),
    "loss_ratio_by_product": _of("loss_ratio_by_product", "month", "month"),
    "claims_processing_time": _of("claims_processing_time", "month", "month"),
    "customer_arpu_monthly": _of("customer_arpu_monthly", "month", "month", whole_if=("customers",)),
    "cross_border_transfers": Refresh(
        gold.corridor_totals, gold.TABLES["cross_border_transfers"].inputs, ("week_start", "week"),
        finish=gold.with_week_before),
    "npl_ratio_by_country": _of("npl_ratio_by_country"),
}


def groups(changed: DataFrame, refresh: Refresh) -> DataFrame:
    """(country_code, period) of the groups that changed days belong to."""
    unit = refresh.period[1]
    return (changed.filter(F.col("dataset").isin(*refresh.events) & F.col("day").isNotNull())
            .select("country_code", F.to_date(F.date_trunc(unit, "day")).alias("period")).distinct())


def _period(at: Column, unit: str) -> Column:
    return F.to_date(F.date_trunc(unit, at))


def of_groups(rows: DataFrame, wanted: DataFrame, unit: str) -> DataFrame:
    """The rows of an event table that fall in these groups; of any other table all."""
    if "timestamp" not in rows.columns:
        return rows
    there = rows.withColumn("_period", _period(F.col("timestamp"), unit))
    return there.join(wanted.withColumnRenamed("period", "_period"), ["country_code", "_period"],
                      "left_semi").drop("_period")


def recomputed(refresh: Refresh, frames: dict[str, DataFrame], wanted: DataFrame) -> DataFrame:
    """The groups' totals from silver. Built before `finish`."""
    return refresh.build(*[of_groups(frames[n], wanted, refresh.period[1]) for n in refresh.inputs])


def replaced(stored: DataFrame, new: DataFrame, wanted: DataFrame, refresh: Refresh) -> DataFrame:
    """A stored table after its groups were computed anew: groups without rows are gone."""
    column = refresh.period[0]
    others = (stored.join(wanted.withColumnRenamed("period", column), ["country_code", column], "left_anti")
              .select(*new.columns))
    whole = others.unionByName(new)
    return refresh.finish(whole) if refresh.finish else whole


def with_country(df: DataFrame) -> DataFrame:
    """Totals by corridor belong to the sender's country."""
    return df if "country_code" in df.columns else df.withColumn("country_code", F.col("sender_country"))


def run_gold(warehouse: Warehouse, names: list[str] | None = None, as_of=None) -> dict[str, int]:
    """Brings the gold tables up to date; the number of groups computed anew of each (-1: whole).

    Only digests reach the driver, as a list of months, by which silver's folders are pruned. The
    partitions of a gold table are its countries, of which the touched ones are rewritten beside the
    table and switched."""
    now = {n: durable(digests(warehouse.table("silver", n, silver.PARTITIONS[n]).read(), n))
           for n in {i for name in names or TABLES for i in TABLES[name].inputs}}
    written = {}
    for name in names or TABLES:
        refresh = TABLES[name]
        marks = warehouse.table("audit", f"gold_digests/{name}", DIGESTS[1])
        current = reduce(DataFrame.unionByName, [now[n] for n in refresh.inputs])
        changed = durable(touched(marks.read_or_none(), current))
        table = warehouse.table("gold", name, ("country_code",))
        stored = table.read_or_none()
        own = changed.filter(F.col("dataset").isin(*refresh.whole_if)).limit(1).count() \
            if refresh.whole_if else 0
        frames = {n: warehouse.table("silver", n, silver.PARTITIONS[n]) for n in refresh.inputs}
        dated = gold.TABLES[name].dated         # says its date in every row, so it is never kept
        if not dated and changed.isEmpty():
            written[name] = 0
            continue
        stamp = moment(as_of)
        if stored is None or own or refresh.period is None:
            built = gold.build(name, {n: t.read() for n, t in frames.items()}, as_of)
            table.replace_scope(built.withColumn("_gold_computed_at", stamp), F.lit(True))
            written[name] = -1
        else:
            wanted = durable(groups(changed, refresh))
            months = [r[0] for r in wanted.select(F.trunc("period", "month")).union(
                # A week may end in the next month.
                wanted.select(F.trunc(F.date_add("period", 6), "month"))).distinct().collect()]
            read = {n: t.read() for n, t in frames.items()}
            read = {n: df.filter(F.col("event_month").isin(months)) if "event_month" in df.columns else df
                    for n, df in read.items()}
            new = with_country(recomputed(refresh, read, wanted)).withColumn("_gold_computed_at", stamp)
            lands = [r[0] for r in wanted.select("country_code").distinct().collect()]
            here = stored.filter(F.col("country_code").isin(*lands))
            after = replaced(here, new, wanted, refresh)
            table.rewrite(align(after, stored.schema), {(c,) for c in lands})
            written[name] = wanted.count()
        # After the table: a run cut short before this finds the same changes again.
        marks.replace_scope(current, F.lit(True))
    return written
