"""Serving: batch and speed layers merged, and role-scoped views."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import full_outer_hot
from ledgerloom.plans.gold import TABLES
from ledgerloom.rules import COUNTRIES

# Which roles may read which tables.
KPI_TABLES = tuple(TABLES)
COMPLIANCE_TABLES = ("regulatory_bceao_daily", "regulatory_cima_daily", "aml_events",
                     "fraud_alerts", "liquidity_alerts", "npl_ratio_by_country",
                     "loss_ratio_by_product", "claims_processing_time")
MASKED_SILVER = ("bank_transactions", "mobile_money_payments", "loan_repayments", "accounts",
                 "insurance_operations")
KEY_COLUMNS = ("account_key", "customer_key", "beneficiary_account_key", "sender_key",
               "receiver_key")


# ------------------------------------------------------------------ batch + speed
def lambda_naive(daily: DataFrame, messages: DataFrame) -> DataFrame:
    """Daily aggregates full-outer-joined to single messages. The batch amount repeats for every
    message of the day: kept for comparison, use `lambda_merged`."""
    speed = messages.select("country_code", F.to_date("event_time").alias("txn_date"),
                            "streaming_amount_eur")
    batch = daily.select("country_code", "txn_date", "total_amount_eur")
    both = full_outer_hot(speed, batch, ["country_code", "txn_date"])
    amount = (F.coalesce("total_amount_eur", F.lit(0))
              + F.coalesce("streaming_amount_eur", F.lit(0)))
    return both.select(F.col("country_code").alias("country"), F.col("txn_date").alias("date"),
                       amount.cast("decimal(20,2)").alias("total_eur"))


def lambda_merged(daily: DataFrame, messages: DataFrame) -> DataFrame:
    """Both layers summed per country and day; the speed layer counts only days after the last
    batch day of its country, so nothing is counted twice. Messages are summed before they meet
    the batch side, so every join is between small daily aggregates."""
    batch = daily.groupBy("country_code", "txn_date").agg(
        F.sum("total_amount_eur").cast("decimal(20,2)").alias("batch_eur"))
    last = daily.groupBy("country_code").agg(F.max("txn_date").alias("last_day"))
    per_day = (messages.filter("is_success AND NOT is_aberrant")
               .groupBy("country_code", F.to_date("event_time").alias("txn_date"))
               .agg(F.sum("streaming_amount_eur").cast("decimal(20,2)").alias("speed_eur"),
                    F.count("*").alias("speed_events")))
    fresh = (per_day.join(last, "country_code", "left")
             .filter(F.col("last_day").isNull() | (F.col("txn_date") > F.col("last_day")))
             .drop("last_day"))
    old, new = (F.coalesce(c, F.lit(0)).cast("decimal(20,2)") for c in ("batch_eur", "speed_eur"))
    return (batch.join(fresh, ["country_code", "txn_date"], "full_outer")
            .select(F.col("country_code").alias("country"), F.col("txn_date").alias("date"),
                    old.alias("batch_eur"), new.alias("realtime_eur"),
                    F.coalesce("speed_events", F.lit(0)).alias("realtime_events"),
                    (old + new).cast("decimal(20,2)").alias("total_eur")))


# ------------------------------------------------------------------ roles
class AccessDenied(PermissionError):
    pass


@dataclass(frozen=True)
class Reader:
    """A user's roles: group_admin, compliance_officer, viewer, country_<code>."""
    roles: frozenset[str]

    @classmethod
    def of(cls, *roles: str) -> Reader:
        return cls(frozenset(roles))

    @property
    def countries(self) -> list[str]:
        return [c for c in COUNTRIES if f"country_{c}" in self.roles]


def masked(df: DataFrame, table: str) -> DataFrame:
    out = df.withColumns({c: F.lit("***") for c in KEY_COLUMNS if c in df.columns})
    if table == "insurance_operations":
        out = out.withColumns({c: F.when(F.col("is_claim"), None).otherwise(F.col(c))
                               for c in ("amount", "amount_eur")})
    return out


def secure_view(df: DataFrame, layer: str, table: str, reader: Reader) -> DataFrame:
    """The rows and columns of a table the reader may see; denied unless a role allows it.
    The most permissive role is listed first, as the filters and masks are projections that
    Catalyst pushes into the scan."""
    if "group_admin" in reader.roles:
        return df
    if "compliance_officer" in reader.roles and layer == "gold" and table in COMPLIANCE_TABLES:
        return df
    if reader.countries and layer in ("silver", "gold"):
        if (layer, table) == ("silver", "fx_rates"):
            return df
        return df.filter(F.col("country_code").isin(*reader.countries))
    if "viewer" in reader.roles:
        if layer == "gold" and table in KPI_TABLES:
            return df
        if layer == "silver" and table in MASKED_SILVER:
            return masked(df, table)
    raise AccessDenied(f"{sorted(reader.roles)} may not read {layer}.{table}")


def register_views(tables: dict[tuple[str, str], DataFrame], reader: Reader) -> list[str]:
    """Temp views `<layer>_<table>` for everything the reader may see."""
    names = []
    for (layer, table), df in tables.items():
        try:
            view = secure_view(df, layer, table, reader)
        except AccessDenied:
            continue
        view.createOrReplaceTempView(f"{layer}_{table}")
        names.append(f"{layer}_{table}")
    return names
