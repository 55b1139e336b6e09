"""Data-quality checks that return small report tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.contracts import expected_currency_sql
from ledgerloom.operators.lookup import growing

# Columns that must not exist in silver, and the identifier pattern.
CLEAR_IDS = ("customer_id", "account_id", "sender_id", "receiver_id", "beneficiary_account",
             "loan_account_id")


def _stack(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphans(facts: DataFrame, fact_key: str, dimension: DataFrame, key: str,
            label: str) -> DataFrame:
    """Rows with a key that the dimension lacks (a NULL key counts as orphan, as a left join
    would show it); filter NULLs before when the key is optional. The facts are counted per key
    first, so a hot key joins as one row."""
    per_key = facts.groupBy(fact_key).agg(F.count("*").alias("n"))
    known = dimension.select(F.col(key).alias("_key")).distinct()
    missing = per_key.join(growing(known), F.col(fact_key) == F.col("_key"), "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans")).select(
        F.lit(label).alias("check"), "orphans")


def orphan_report(bronze: dict[str, DataFrame]) -> DataFrame:
    customers, accounts = bronze["customers"], bronze["accounts"]
    bank, insurance = bronze["bank_transactions"], bronze["insurance_operations"]
    mobile, loans = bronze["mobile_money_payments"], bronze["loan_repayments"]
    credits = accounts.filter("account_type = 'LOAN'")
    given = bank.filter("beneficiary_account IS NOT NULL")
    return _stack([
        orphans(bank, "account_id", accounts, "account_id", "bank.account_id"),
        orphans(given, "beneficiary_account", accounts, "account_id", "bank.beneficiary_account"),
        orphans(bank, "branch_id", bronze["branches"], "branch_id", "bank.branch_id"),
        orphans(insurance, "customer_id", customers, "customer_id", "insurance.customer_id"),
        orphans(insurance, "account_id", accounts, "account_id", "insurance.account_id"),
        orphans(mobile, "sender_id", customers, "customer_id", "mobile_money.sender_id"),
        orphans(mobile, "receiver_id", customers, "customer_id", "mobile_money.receiver_id"),
        orphans(loans, "loan_account_id", credits, "account_id", "loan.loan_account_id"),
        orphans(loans, "customer_id", customers, "customer_id", "loan.customer_id"),
        orphans(accounts, "customer_id", customers, "customer_id", "accounts.customer_id")])


def duplicate_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows minus distinct keys per table; 0 everywhere is expected. Counting distinct keys
    is combined map-side, so a hot key is one row after the shuffle."""
    return _stack([
        df.agg((F.count("*") - F.countDistinct(key)).alias("duplicates"))
        .select(F.lit(name).alias("table_name"), "duplicates")
        for name, (df, key) in tables.items()])


def assert_unique(df: DataFrame, key: str, what: str) -> None:
    repeats = df.agg((F.count("*") - F.countDistinct(key)).alias("d")).first()["d"]
    if repeats:
        raise ValueError(f"{repeats} duplicate {key} in {what}")


def currency_report(tables: dict[str, DataFrame]) -> DataFrame:
    expected = F.expr(expected_currency_sql("country_code"))
    return _stack([
        df.agg(F.count_if(F.col("currency") != expected).alias("mismatches"))
        .select(F.lit(name).alias("table_name"), "mismatches") for name, df in tables.items()])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([df.agg(F.count("*").alias("row_count"))
                   .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """One row per dataset, one count column per layer."""
    parts = [row_counts(tables).withColumn("layer", F.lit(layer))
             for layer, tables in layers.items()]
    return (_stack(parts).groupBy(F.col("table_name").alias("dataset"))
            .pivot("layer", list(layers)).agg(F.sum("row_count")))


def partition_counts(layers: dict[str, DataFrame]) -> DataFrame:
    return _stack([df.groupBy("country_code").agg(F.count("*").alias("row_count"))
                   .select(F.lit(layer).alias("layer"), "country_code", "row_count")
                   for layer, df in layers.items()])


def changed_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables whose row count differs between two `row_counts` frames; empty after a replay."""
    old = before.withColumnRenamed("row_count", "before")
    new = after.withColumnRenamed("row_count", "after")
    return (old.join(new, "table_name", "full_outer")
            .filter(~F.col("before").eqNullSafe(F.col("after"))))


def forbidden_columns(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    return [(name, c) for name, df in tables.items() for c in df.columns if c in CLEAR_IDS]


def leak_report(tables: dict[str, DataFrame], pattern: str) -> DataFrame:
    """Values holding a clear identifier, per table and string column: one pass per table."""
    parts = []
    for name, df in tables.items():
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        counts = df.agg(*[F.count_if(F.col(f"`{c}`").rlike(pattern)).alias(c) for c in text])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                   F.col(f"`{c}`").alias("leaks")) for c in text])
        parts.append(counts.select(F.explode(cells).alias("cell")).select(
            F.lit(name).alias("table_name"), "cell.column_name", "cell.leaks"))
    return _stack(parts)


def leaks_together(reports: list[DataFrame]) -> DataFrame:
    """Leak reports of tables and of parts of them as one."""
    return _stack(reports).groupBy("table_name", "column_name").agg(F.sum("leaks").alias("leaks"))


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("dataset", "reject_reason").agg(F.count("*").alias("nb"))


def journal_by_batch(journal: DataFrame, limit: int = 20) -> DataFrame:
    return (journal.groupBy("dataset", "batch_id", "status")
            .agg(F.count("*").alias("files"), F.sum("rows_read").alias("rows_read"),
                 F.sum("rows_valid").alias("rows_valid"),
                 F.sum("rows_rejected").alias("rows_rejected"),
                 F.max("processed_at").alias("processed_at"))
            .orderBy(F.desc("processed_at"), "dataset", "batch_id", "status").limit(limit))


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("dataset", "reason").agg(F.count("*").alias("nb"))
