"""Batch jobs: bronze to silver, silver to gold, regulatory reports. Reruns replace the same
partitions."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, moment, month_of
from ledgerloom.functions.money import fx_rates
from ledgerloom.operators.tables import Warehouse
from ledgerloom.plans import gold, regulatory, silver
from ledgerloom.rules import COUNTRIES, DEFAULT_RULES, Rules
from ledgerloom.session import durable

QUARANTINE_PARTITIONS = ("dataset", "country_code")


def known_countries(countries: list[str] | None) -> list[str]:
    unknown = sorted(set(countries or ()) - set(COUNTRIES))
    if unknown:
        raise ValueError(f"unknown countries {unknown}, expected some of {COUNTRIES}")
    return list(countries or COUNTRIES)


def _by_country(df: DataFrame, countries: list[str] | None) -> DataFrame:
    return df.filter(F.col("country_code").isin(*countries)) if countries else df


def run_silver(warehouse: Warehouse, secret: str, countries: list[str] | None = None,
               names: tuple[str, ...] = tuple(silver.TABLES), as_of=None,
               rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Rows written per table. `names` may be a subset, `countries` limits the result.

    Each table's joins run once: the rows are staged with the reasons against them, and clean rows
    and quarantine are written from there. Keys are unique by construction (`latest`);
    `quality.assert_unique` is there for a check on its own."""
    spark = warehouse.spark
    scope = known_countries(countries)
    rates = warehouse.table("silver", "fx_rates")
    rates.replace(fx_rates(spark).coalesce(1))
    looked_up = {i for n in names for i in silver.TABLES[n].inputs}
    bronze = {n: warehouse.table("bronze", n).read() for n in {*names, *looked_up}}
    ctx = silver.Context(rates.read(), secret, as_of, rules)
    place = F.col("country_code").isin(*scope) if countries else F.lit(True)
    written, held = {}, []
    for name in names:
        built = silver.build_one(name, bronze[name], bronze, ctx)
        once = silver.Split(durable(built.rows), name, as_of)
        clean = once.clean.filter(place).withColumn("_silver_processed_at", moment(as_of))
        if "event_month" in silver.PARTITIONS[name]:
            clean = clean.withColumn("event_month", month_of("timestamp"))
        written[name] = warehouse.table("silver", name, silver.PARTITIONS[name]).replace_scope(
            clean, place)
        if silver.TABLES[name].checks:
            held.append(once.quarantine.filter(place))
    if held:
        checked = [n for n in names if silver.TABLES[n].checks]
        written["silver_quarantine"] = warehouse.table(
            "audit", "silver_quarantine", QUARANTINE_PARTITIONS).replace_scope(
                reduce(DataFrame.unionByName, held), F.col("dataset").isin(*checked) & place)
    return written


def run_gold(warehouse: Warehouse, countries: list[str] | None = None,
             names: list[str] | None = None, as_of=None) -> dict[str, int]:
    """Events are read for the asked countries only (partition pruning), referentials whole."""
    scope = countries and known_countries(countries)
    names = names or list(gold.TABLES)
    referential = {"customers", "accounts"}
    frames = {n: warehouse.table("silver", n, silver.PARTITIONS[n]).read(
        countries=None if n in referential else scope)
        for n in {i for name in names for i in gold.TABLES[name].inputs}}
    written = {}
    for name in names:
        df = _by_country(gold.build(name, frames, as_of), scope)
        written[name] = warehouse.table("gold", name, ("country_code",)).replace_scope(
            df.withColumn("_gold_computed_at", moment(as_of)),
            F.col("country_code").isin(*scope) if scope else F.lit(True))
    return written


def report_inputs(warehouse: Warehouse, report_date) -> dict[str, DataFrame]:
    """Silver as far as a report of that day needs it: payments of the day, insurance from the first
    of the month, repayments up to the day. Months are partitions, so the rest is not read."""
    first = f"{str(report_date)[:7]}-01"
    last = str(report_date)[:10]
    spans = {"bank_transactions": (last, last), "mobile_money_payments": (last, last),
             "insurance_operations": (first, last), "loan_repayments": (None, last),
             "accounts": (None, None)}
    return {n: warehouse.table("silver", n, silver.PARTITIONS[n]).read(since=since, until=until)
            for n, (since, until) in spans.items()}


def run_regulatory(warehouse: Warehouse, export_root: str, report_date,
                   countries: list[str] | None = None,
                   rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Both reports of day D as tables and as one CSV file per report date and country. The
    reports are aggregates per country and product, so one task per country writes them."""
    scope = countries and known_countries(countries)
    frames = report_inputs(warehouse, report_date)
    if frames["accounts"].isEmpty():
        raise ValueError("silver.accounts is empty: nothing to report")
    written = {}
    reports = {"bceao": regulatory.bank_daily(frames, report_date, rules),
               "cima": regulatory.insurance_month_to_date(frames, report_date, rules)}
    for regulator, df in reports.items():
        df = _by_country(df, scope).withColumn("generated_at", F.current_timestamp()).persist()
        partitions = ("report_date", "country_code")
        scoped = F.col("report_date") == day(report_date)
        if scope:
            scoped = scoped & F.col("country_code").isin(*scope)
        written[regulator] = warehouse.table(
            "gold", f"regulatory_{regulator}_daily", partitions).replace_scope(df, scoped)
        (df.repartition("country_code").write.mode("overwrite").partitionBy(*partitions)
         .option("header", "true").option("partitionOverwriteMode", "dynamic")
         .csv(f"{export_root}/{regulator}"))
        df.unpersist()
    return written


def export_inventory(warehouse: Warehouse, export_root: str) -> DataFrame:
    return (warehouse.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true").load(export_root).select("path", "length"))
