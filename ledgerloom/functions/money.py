"""Exact money: reference rates, EUR conversion, guarded ratios. All in DECIMAL, so that
the results do not depend on summation order or on binary rounding."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.rules import XOF_PER_EUR

MONEY = "decimal(20,2)"
RATE = "decimal(12,10)"


def fx_rates(spark: SparkSession, first: str = "2020-01-01",
             last: str = "2030-12-01") -> DataFrame:
    """EUR per unit, one row per currency and month: the fixed XOF peg and a synthetic
    GHS series (trend plus seasonality) standing in for a quoted rate feed."""
    months = spark.sql(
        f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 MONTH)) AS rate_month")
    t = (F.year("rate_month") - 2020) * 12 + F.month("rate_month") - 1
    ghs_per_eur = F.round(F.lit(11.5) + F.lit(0.03) * t + F.lit(0.25) * F.sin(t / F.lit(3.0)), 4)
    quotes = F.array(
        F.struct(F.lit("XOF").alias("currency"), F.lit(float(XOF_PER_EUR)).alias("per_eur"),
                 F.lit("BCEAO_FIXED_PEG").alias("source")),
        F.struct(F.lit("GHS").alias("currency"), ghs_per_eur.alias("per_eur"),
                 F.lit("SYNTHETIC_REFERENCE").alias("source")))
    return (months.select("rate_month", F.explode(quotes).alias("q"))
            .select("q.currency", "rate_month",
                    F.round(1 / F.col("q.per_eur"), 10).cast(RATE).alias("eur_per_unit"),
                    "q.source"))


def in_eur(amount: Column, rate: Column) -> Column:
    return F.round(amount.cast(MONEY) * rate.cast(RATE), 2).cast(MONEY)


def convert_to_eur(df: DataFrame, fx: DataFrame, at: str | Column,
                   columns: dict[str, str], currency: str = "currency") -> DataFrame:
    """Adds `{source: target}` EUR columns at the rate of the month of `at`; no rate, NULL.

    One row per currency and month is far below Spark's broadcast limit, and Spark checks that
    from the table's size. There is no hint: a rate table that outgrew the limit would be joined
    by sort-merge, with its hot months split by AQE."""
    at = F.col(at) if isinstance(at, str) else at
    quotes = fx.select(F.col("currency").alias("_fx_currency"),
                       F.col("rate_month").alias("_fx_month"),
                       F.col("eur_per_unit").alias("_fx_rate"))
    same_month = F.trunc(at.cast("date"), "month") == F.col("_fx_month")
    joined = df.join(quotes, (F.col(currency) == F.col("_fx_currency")) & same_month, "left")
    converted = {target: in_eur(F.col(source), F.col("_fx_rate"))
                 for source, target in columns.items()}
    return joined.withColumns(converted).drop("_fx_currency", "_fx_month", "_fx_rate")


def total(amount: Column) -> Column:
    """Zero-defaulted exact sum."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY)


def total_if(condition: Column, amount: str) -> Column:
    return total(F.when(condition, F.col(amount)))


def count_where(condition: Column) -> Column:
    """Counts TRUE only; NULL when the group has no non-NULL condition, as SUM over a cast."""
    return F.sum(condition.cast("int"))


def exact_ratio(num: Column, den: Column, scale: int = 4) -> Column:
    """num / den rounded half-up in DECIMAL, NULL unless den > 0."""
    quotient = num.cast(MONEY) / den.cast(MONEY)
    return F.when(den > 0, F.round(quotient, scale).cast(f"decimal(28,{scale})"))


def ratio(num: Column, den: Column, scale: int = 4) -> Column:
    return exact_ratio(num, den, scale).cast("double")


def mean(amount: Column, scale: int = 2) -> Column:
    """Average of the non-NULL values, rounded once (avg() would round to 6 digits first)."""
    quotient = F.sum(amount).cast(MONEY) / F.count(amount).cast("decimal(18,0)")
    return F.when(F.count(amount) > 0, F.round(quotient, scale)).cast(f"decimal(20,{scale})")
