"""Analytical and dashboard queries over bronze, silver, gold and message tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.money import MONEY, mean
from ledgerloom.operators.lookup import growing
from ledgerloom.plans.gold import usable
from ledgerloom.rules import DEFAULT_RULES, Rules


def money_sum(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY)


def percent(num: Column, den: Column, digits: int) -> Column:
    """100 num / den, exact, NULL when den is 0."""
    exact = num.cast(MONEY) * 100 / den.cast(MONEY)
    return F.when(den != 0, F.round(exact, digits)).cast(f"decimal(20,{digits})")


# ------------------------------------------------------------------ bronze analytics
def balances_by_country(accounts: DataFrame) -> DataFrame:
    open_accounts = accounts.filter("status = 'ACTIVE' AND account_type <> 'LOAN'")
    return open_accounts.groupBy("country_code", "currency").agg(
        F.count("*").alias("nb_accounts"), money_sum("balance").alias("balance_total"),
        mean(F.col("balance")).alias("balance_avg"),
        F.percentile_approx("balance", 0.5).alias("balance_median"))


def loans_by_country(accounts: DataFrame) -> DataFrame:
    return (accounts.filter("account_type = 'LOAN'")
            .groupBy("country_code", "entity_type", "currency")
            .agg(F.count("*").alias("nb_loans"),
                 money_sum(-F.col("balance")).alias("outstanding_total"),
                 money_sum("credit_limit").alias("granted_total")))


def monthly_volumes(bank: DataFrame) -> DataFrame:
    status = F.col("transaction_status")
    return (bank.groupBy("country_code", C.month_of("timestamp").alias("month"), "currency")
            .agg(F.count("*").alias("nb_transactions"),
                 F.count_if(status == "SUCCESS").alias("nb_success"),
                 percent(F.count_if(status == "FAILED"), F.count("*"), 2).alias("failed_pct"),
                 money_sum(F.when(status == "SUCCESS", F.col("amount"))).alias("success_amount")))


def volumes_by_type_and_channel(bank: DataFrame, country: str, since: str) -> DataFrame:
    """On a partitioned table both conditions should reach partition columns: read it with
    `Table.read(countries=[country], since=since)`, which adds them."""
    return (bank.filter((F.col("country_code") == country)
                        & (F.col("timestamp") >= F.lit(since).cast("timestamp")))
            .groupBy("transaction_type", "channel")
            .agg(F.count("*").alias("nb"), money_sum("amount").alias("amount"))
            .orderBy(F.desc("nb"), "transaction_type", "channel"))


def entity_counts(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers and their accounts per entity and country. Accounts are counted per customer
    before the join: one row per customer meets the left side."""
    owned = accounts.groupBy("customer_id").agg(F.count("account_id").alias("n"))
    return (customers.select("customer_id", "entity_type", "country_code")
            .groupBy("customer_id", "entity_type", "country_code").agg(F.count("*").alias("rows"))
            .join(growing(owned), "customer_id", "left")
            .groupBy("entity_type", "country_code")
            .agg(F.count("customer_id").alias("nb_customers"),
                 F.coalesce(F.sum(F.col("rows") * F.col("n")), F.lit(0)).alias("nb_accounts")))


def consolidated_activity(*event_tables: DataFrame) -> DataFrame:
    """Each table is counted before the union: the shuffle carries a handful of rows."""
    parts = [df.groupBy("country_code", "entity_type").agg(F.count("*").alias("n"))
             for df in event_tables]
    return (reduce(DataFrame.unionByName, parts).groupBy("country_code", "entity_type")
            .agg(F.sum("n").alias("nb_operations")))


def corridors_raw(mobile: DataFrame) -> DataFrame:
    return (mobile.filter("payment_type = 'CROSS_BORDER_TRANSFER' AND status = 'SUCCESS'")
            .groupBy("sender_country", "receiver_country", "currency")
            .agg(F.count("*").alias("nb"), money_sum("amount").alias("amount")))


def claims_by_product(operations: DataFrame) -> DataFrame:
    def when(operation):
        return F.when(F.col("operation_type") == operation, F.col("amount"))
    known = F.when(F.col("claim_status").isNotNull(), F.col("processing_days"))
    return operations.groupBy("country_code", "product_line").agg(
        money_sum(when("PREMIUM_PAYMENT")).alias("premiums"),
        money_sum(when("CLAIM_PAYMENT")).alias("claims_paid"),
        mean(known, 4).alias("avg_processing_days"))


def repayment_share(repayments: DataFrame) -> DataFrame:
    """The window runs over the aggregated statuses of one group, a few rows."""
    group = Window.partitionBy("country_code", "entity_type")
    return (repayments.groupBy("country_code", "entity_type", "repayment_status")
            .agg(F.count("*").alias("nb"))
            .withColumn("pct", percent(F.col("nb"), F.sum("nb").over(group), 1)))


# ------------------------------------------------------------------ silver reports
def currency_totals(bank: DataFrame) -> DataFrame:
    return bank.groupBy("currency").agg(
        F.count("*").alias("nb"), money_sum("amount").alias("amount_local"),
        money_sum("amount_eur").alias("amount_eur"),
        F.count_if("is_aberrant").alias("nb_aberrant"),
        F.count_if("is_high_value").alias("nb_high_value"))


def revenue_by_line(bank: DataFrame, loans: DataFrame, insurance: DataFrame,
                    mobile: DataFrame) -> DataFrame:
    """Monthly revenue per business line; bank fees and loan interest stay separate rows."""
    def line(df, month, label, amount):
        return (usable(df).groupBy(month.alias("month"), "country_code")
                .agg(money_sum(amount).alias("revenue_eur"))
                .select("month", "country_code", F.lit(label[0]).alias("business_line"),
                        F.lit(label[1]).alias("source"), "revenue_eur"))
    parts = [
        line(bank.filter("is_success"), C.month_of("timestamp"), ("BANK", "fees"),
             "fee_amount_eur"),
        line(loans, F.col("event_month"), ("BANK", "interest"), "interest_received_eur"),
        line(insurance.filter("is_premium"), F.col("op_month"), ("INSURANCE", "premiums"),
             "amount_eur"),
        line(mobile.filter("is_success"), C.month_of("timestamp"), ("MOBILE_MONEY", "fees"),
             "fee_amount_eur")]
    return reduce(DataFrame.unionByName, parts)


def top_products(accounts: DataFrame, n: int = 10) -> DataFrame:
    """Most subscribed products per country; the rank limit is applied before the shuffle."""
    counts = (accounts.filter("entity_type IN ('BANK', 'INSURANCE') AND status = 'ACTIVE'")
              .groupBy("country_code", "entity_type", "product_name")
              .agg(F.count("*").alias("nb_subscriptions")))
    order = Window.partitionBy("country_code").orderBy(
        F.desc("nb_subscriptions"), "product_name", "entity_type")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def payments_by_hour(mobile: DataFrame) -> DataFrame:
    return mobile.groupBy("country_code", F.hour("timestamp").alias("hour")).agg(
        F.count("*").alias("nb_payments"), money_sum("amount_eur").alias("amount_eur"))


def failures_by_operator(mobile: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAILED")
    return mobile.groupBy("country_code", "operator").agg(
        F.count("*").alias("nb_payments"), failed.alias("nb_failed"),
        percent(failed, F.count("*"), 2).alias("failure_pct"))


# ------------------------------------------------------------------ gold reports
def npl_sorted(npl: DataFrame) -> DataFrame:
    """Country total first, then loan types."""
    pct = F.round(F.col("npl_ratio").cast("decimal(20,4)") * 100, 2).cast("decimal(20,2)")
    return npl.select("country_code", "loan_type", "nb_loans", "nb_loans_npl",
                      "outstanding_total_eur", "outstanding_npl_eur", pct.alias("npl_pct"),
                      "is_above_threshold").orderBy(
        "country_code", (F.col("loan_type") == "ALL").desc(), "loan_type")


def _newest(rows: DataFrame, date: str) -> DataFrame:
    """Rows of the last date. `rows` is a report, a few hundred rows a date, and is computed once."""
    last = F.max(date).over(Window.partitionBy())
    return rows.withColumn("_last", last).filter(F.col(date) == F.col("_last")).drop("_last")


def npl_latest(npl: DataFrame) -> DataFrame:
    """Totals of the last snapshot, with the group-wide weighted ratio."""
    return (_newest(npl.filter("loan_type = 'ALL'"), "as_of_date")
            .select("country_code", "as_of_date",
                    F.round(F.col("npl_ratio").cast("decimal(20,4)") * 100, 2)
                    .cast("decimal(20,2)").alias("npl_pct"),
                    "nb_loans", "nb_loans_npl", "outstanding_total_eur", "outstanding_npl_eur"))


def daily_volume_top(daily: DataFrame, country: str, n: int = 20) -> DataFrame:
    return (daily.filter(F.col("country_code") == country)
            .select("txn_date", "country_code", "entity_type", "transaction_type",
                    "nb_transactions", "total_amount_eur", "failure_rate")
            .orderBy(F.desc("txn_date"), F.desc("total_amount_eur"), "entity_type",
                     "transaction_type").limit(n))


def mobile_flow_last_days(flow: DataFrame, country: str, n: int = 15) -> DataFrame:
    pct = F.round(F.col("failure_rate").cast("decimal(20,4)") * 100, 2).cast("decimal(20,2)")
    return (flow.filter(F.col("country_code") == country)
            .select("transaction_date", "country_code", "currency", "nb_transactions",
                    "amount_total_eur", pct.alias("failure_pct"), "active_users", "fees_eur")
            .orderBy(F.desc("transaction_date"), "currency").limit(n))


def weekly_corridors_top(transfers: DataFrame, n: int = 20) -> DataFrame:
    return (transfers.filter("is_uemoa_corridor")
            .select("week_start", "corridor", "channel", "nb_transfers", "amount_total_eur",
                    "avg_amount_eur", "wow_change_pct")
            .orderBy(F.desc("week_start"), F.desc("amount_total_eur"), "corridor", "channel")
            .limit(n))


def loss_ratio_by_country(loss: DataFrame) -> DataFrame:
    return loss.groupBy("country_code").agg(
        percent(F.sum("claims_paid_eur"), F.sum("premiums_eur"), 4).alias("loss_ratio_pct"))


def loss_ratio_total(loss: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    limit = int(rules.loss_ratio_limit * 100)
    paid, earned = F.sum("claims_paid_eur"), F.sum("premiums_eur")
    return loss.groupBy("country_code", "product_line", "line_family").agg(
        percent(paid, earned, 1).alias("loss_ratio_pct"), F.lit(limit).alias("threshold_pct"),
        earned.cast(MONEY).alias("premiums_eur"), paid.cast(MONEY).alias("claims_paid_eur"))


def country_in_out(transfers: DataFrame) -> DataFrame:
    """Outgoing and incoming amounts per country, each corridor counted in both roles."""
    zero = F.lit(0).cast(MONEY)
    out = transfers.select(F.col("sender_country").alias("country"),
                           F.col("amount_total_eur").alias("o"), zero.alias("i"))
    into = transfers.select(F.col("receiver_country").alias("country"), zero.alias("o"),
                            F.col("amount_total_eur").alias("i"))
    return out.unionByName(into).groupBy("country").agg(
        money_sum("o").alias("outgoing_eur"), money_sum("i").alias("incoming_eur"))


def corridor_totals(transfers: DataFrame) -> DataFrame:
    return (transfers.filter("sender_country <> receiver_country")
            .groupBy("corridor", F.col("sender_country").alias("country_code"),
                     "receiver_country", "channel")
            .agg(F.sum("nb_transfers").alias("nb_transfers"),
                 money_sum("amount_total_eur").alias("amount_eur")))


def top_corridors(transfers: DataFrame, n: int = 5) -> DataFrame:
    return (corridor_totals(transfers).groupBy("corridor")
            .agg(money_sum("amount_eur").alias("amount_eur"))
            .orderBy(F.desc("amount_eur"), "corridor").limit(n))


def weighted_metrics(arpc: DataFrame, npl: DataFrame, claims: DataFrame,
                     rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Group-wide figures rebuilt from aggregates: ratios of sums and a weighted mean. Never
    averages of averages."""
    def row(df, name, value, limit=None):
        return df.agg(value.cast("decimal(20,4)").alias("value")).select(
            F.lit(name).alias("metric"), "value", F.lit(limit).cast("int").alias("target"))

    def over(num, den):
        return F.when(den != 0, F.round(num.cast(MONEY) / den.cast(MONEY), 4))

    weighted = F.sum(F.col("avg_processing_days").cast("decimal(20,1)") * F.col("nb_claims"))
    return reduce(DataFrame.unionByName, [
        row(arpc, "arpc_eur", over(F.sum("revenue_eur"), F.sum("active_customers"))),
        row(npl.filter("loan_type = 'ALL'"), "npl_pct",
            over(F.sum("outstanding_npl_eur") * 100, F.sum("outstanding_total_eur"))),
        row(claims, "avg_processing_days", over(weighted, F.sum("nb_claims")),
            rules.claim_sla_days)])


def report_dates(bank_reports: DataFrame) -> DataFrame:
    return bank_reports.groupBy("report_date").agg(
        F.count("*").alias("countries"), F.count_if("npl_breach").alias("npl_breaches"))


def latest_report(reports: DataFrame) -> DataFrame:
    """Rows of the last report date."""
    return _newest(reports, "report_date")


# ------------------------------------------------------------------ alerts and messages
def aml_daily(alerts: DataFrame, as_of, days: int = 30) -> DataFrame:
    since = C.day(as_of) - F.expr(f"INTERVAL {days} DAYS")
    return (alerts.filter(F.col("event_time") >= since)
            .groupBy(F.to_date("event_time").alias("alert_date"), "country_code", "currency")
            .agg(F.count("*").alias("nb_alerts"), money_sum("amount_eur").alias("amount_eur")))


def alerts_by_rule(fraud: DataFrame, aml: DataFrame, liquidity: DataFrame) -> DataFrame:
    def counted(df, topic, label):
        return (df.groupBy(label.alias("rule"), "severity")
                .agg(F.count("*").alias("alerts"), F.max("detected_at").alias("last"))
                .select(F.lit(topic).alias("topic"), "rule", "severity", "alerts", "last"))
    rule = F.col("rule")
    return reduce(DataFrame.unionByName, [
        counted(fraud, "gold-fraud-alerts", rule),
        counted(aml, "gold-aml-events", F.concat(rule, F.lit(" ("), "currency", F.lit(")"))),
        counted(liquidity, "gold-liquidity-alerts", rule)])


def latest_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (alerts.orderBy(F.desc("detected_at"), F.desc("event_time"), "alert_id").limit(n)
            .select("rule", "country_code", "subject_key", "event_time", "amount_eur",
                    "threshold", "details"))


def dead_letters_by_reason(letters: DataFrame) -> DataFrame:
    first = F.split_part("reject_reason", F.lit(";"), F.lit(1))
    return letters.groupBy("stage", "dataset", first.alias("reason")).agg(
        F.count("*").alias("messages"))


def topic_lag(topics: dict[str, DataFrame]) -> DataFrame:
    """Seconds from landing to arrival per topic: maximum and 95th percentile."""
    parts = []
    for topic, df in topics.items():
        lag = F.timestamp_diff("SECOND", F.col("landed_at"), F.col("_timestamp"))
        parts.append(df.filter("landed_at IS NOT NULL").agg(
            F.count("*").alias("messages"), F.max(lag).alias("max_lag_s"),
            F.percentile_approx(lag, 0.95).alias("p95_lag_s"))
            .select(F.lit(topic).alias("topic"), "messages", "max_lag_s", "p95_lag_s"))
    return reduce(DataFrame.unionByName, parts)


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("n"), F.max(c).alias("last_update"))
        .select(F.lit(name).alias("source"), "n", "last_update")
        for name, (df, c) in tables.items()])
