"""The given tables as bronze, silver and gold frames, built lazily for one query."""
from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ledgerloom.catalog import adapters
from ledgerloom.catalog.adapters import AS_OF, REPORT_DATE, SECRET
from ledgerloom.contracts import CONTRACTS
from ledgerloom.functions.money import fx_rates
from ledgerloom.operators.slices import in_turn, parts_of, together
from ledgerloom.plans import gold, regulatory, silver
from ledgerloom.session import discard, staged

TODAY = AS_OF[:10]


class Lake:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._bronze: dict[str, DataFrame] = {}
        self._silver: dict[str, silver.Split] = {}
        self._looked_up: dict[str, DataFrame] = {}

    @cached_property
    def context(self) -> silver.Context:
        return silver.Context(fx_rates(self.spark), SECRET, AS_OF)

    def adapter(self, name: str) -> DataFrame:
        return adapters.adapt(self.spark, self.folder, name)

    def bronze(self, name: str) -> DataFrame:
        if name not in self._bronze:
            self._bronze[name] = self.adapter(adapters.BRONZE[name])
        return self._bronze[name]

    def split(self, name: str) -> silver.Split:
        if name not in self._silver:
            lookups = {n: self.bronze(n) for n in silver.TABLES[name].inputs}
            self._silver[name] = silver.build_one(name, self.bronze(name), lookups, self.context)
        return self._silver[name]

    def silver(self, name: str) -> DataFrame:
        return self.split(name).clean.drop("_bronze_ingested_at")

    def looked_up(self, name: str) -> DataFrame:
        """A bronze table that the parts of another are joined to, made once."""
        if name not in self._looked_up:
            self._looked_up[name] = staged(self.bronze(name))
        return self._looked_up[name]

    def parts(self, name: str) -> Iterator[silver.Split]:
        """`split`, in parts by the table's key."""
        parts = parts_of(self.bronze(name), CONTRACTS[name].key)
        if len(parts) == 1:
            yield self.split(name)
            return
        lookups = {n: self.looked_up(n) for n in silver.TABLES[name].inputs}
        for part in parts:
            yield silver.build_one(name, part, lookups, self.context)

    def silver_parts(self, name: str) -> Iterator[DataFrame]:
        return (part.clean.drop("_bronze_ingested_at") for part in self.parts(name))

    def stored(self, name: str, *columns: str) -> list[DataFrame]:
        """The silver table (these columns of it; all), made part by part and stored. Keys in it are
        hashes as text, of which zstd takes half."""
        return in_turn((part.select(*(columns or ["*"])) for part in self.silver_parts(name)),
                       compression="zstd")

    def quarantine(self) -> DataFrame:
        held = [self.split(n).quarantine for n in silver.TABLES if silver.TABLES[n].checks]
        out = held[0]
        for df in held[1:]:
            out = out.unionByName(df)
        return out

    def gold(self, name: str) -> DataFrame:
        return gold.build(name, {n: self.silver(n) for n in gold.TABLES[name].inputs}, TODAY)

    def gold_stored(self, name: str) -> DataFrame:
        """`gold` from stored silver of the columns that it reads, and stored in its turn."""
        inputs = {n: self.stored(n, *gold.TABLES[name].reads.get(n, ())) for n in gold.TABLES[name].inputs}
        out = staged(gold.build(name, {n: together(parts) for n, parts in inputs.items()}, TODAY))
        discard(*[part for parts in inputs.values() for part in parts])
        return out

    def bank_report(self, date: str = REPORT_DATE) -> DataFrame:
        names = ("bank_transactions", "mobile_money_payments", "accounts", "loan_repayments")
        return regulatory.bank_daily({n: self.silver(n) for n in names}, date)

    def insurance_report(self, date: str = REPORT_DATE) -> DataFrame:
        return regulatory.insurance_month_to_date(
            {"insurance_operations": self.silver("insurance_operations")}, date)

    def wallet_flows(self) -> DataFrame:
        """Mobile payments in the shape of bank transactions: the only given events with times
        inside the day, which sliding windows need."""
        kinds = {"P2P": "TRANSFER", "MERCHANT_PAYMENT": "PAYMENT", "BILL_PAYMENT": "WITHDRAWAL",
                 "AIRTIME": "DEPOSIT", "CROSS_BORDER_TRANSFER": "INTERNATIONAL_WIRE"}
        kind = F.coalesce(*[F.when(F.col("payment_type") == k, v) for k, v in kinds.items()])
        return self.silver("mobile_money_payments").select(
            F.col("payment_id").alias("transaction_id"), "timestamp", "country_code",
            F.col("sender_key").alias("account_key"), kind.alias("transaction_type"), "amount",
            "currency", "amount_eur", "is_success")


def zoneless(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables have them."""
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
