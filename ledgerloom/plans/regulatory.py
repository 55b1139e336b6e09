"""Daily regulatory reports: bank activity of day D, insurance month to date."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.money import MONEY, count_where, exact_ratio, mean, total_if
from ledgerloom.plans.gold import npl_ratio_by_country, usable
from ledgerloom.rules import DEFAULT_RULES, Rules

REGULATORS = {"bceao": True, "cima": False}      # True: a file per country is mandatory


def bank_daily(silver: dict[str, DataFrame], report_date,
               rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per country that has accounts; quiet countries show zeros.

    Everything is aggregated to the country before joining, and one pass over accounts gives
    both the list of countries and the stocks."""
    on = C.day(report_date)
    paid, abroad = F.col("is_success"), F.col("is_cross_border")
    bank = usable(silver["bank_transactions"]).filter(F.col("txn_date") == on)
    mobile = usable(silver["mobile_money_payments"]).filter(F.col("txn_date") == on)
    active = F.col("status") == "ACTIVE"
    deposits = active & F.col("account_type").isin("CURRENT", "SAVINGS")
    stocks = silver["accounts"].groupBy("country_code").agg(
        total_if(deposits, "balance_eur").alias("total_deposits_eur"),
        total_if(active, "outstanding_eur").alias("total_loans_outstanding_eur"))
    activity = bank.groupBy("country_code").agg(
        F.count("*").alias("nb_bank_transactions"),
        total_if(paid, "amount_eur").alias("bank_amount_eur"),
        count_where(F.col("is_high_value") & paid).alias("nb_high_value_transactions"),
        total_if(abroad & paid, "amount_eur").alias("_bank_out"))
    wallets = mobile.groupBy("country_code").agg(
        F.count("*").alias("nb_mobile_money_transactions"),
        total_if(paid, "amount_eur").alias("mobile_money_amount_eur"),
        total_if(abroad & paid, "amount_eur").alias("_mobile_out"))
    npl = (npl_ratio_by_country(silver["loan_repayments"], silver["accounts"], report_date, rules)
           .filter("loan_type = 'ALL'")
           .select("country_code", "npl_ratio", "is_above_threshold", "outstanding_npl_eur"))
    joined = reduce(lambda a, b: a.join(b, "country_code", "left"),
                    [stocks, activity, wallets, npl])

    def amount(c):
        return C.or_zero(c, MONEY).alias(c)

    def number(c):
        return C.or_zero(c, "bigint").alias(c)

    outflow = (C.or_zero("_bank_out") + C.or_zero("_mobile_out")).cast(MONEY)
    return joined.select(
        on.alias("report_date"), F.lit("BCEAO").alias("regulator"), "country_code",
        number("nb_bank_transactions"), amount("bank_amount_eur"),
        number("nb_high_value_transactions"), number("nb_mobile_money_transactions"),
        amount("mobile_money_amount_eur"), outflow.alias("cross_border_outflows_eur"),
        amount("total_deposits_eur"), amount("total_loans_outstanding_eur"),
        amount("outstanding_npl_eur"), "npl_ratio",
        F.lit(float(rules.npl_limit)).alias("npl_threshold"),
        C.or_false("is_above_threshold").alias("npl_breach"))


def insurance_month_to_date(silver: dict[str, DataFrame], report_date,
                            rules: Rules = DEFAULT_RULES) -> DataFrame:
    on = C.day(report_date)
    month = usable(silver["insurance_operations"]).filter(
        F.col("op_date").between(F.trunc(on, "month"), on))
    share = exact_ratio(F.col("claims_paid_mtd_eur"), F.col("premiums_mtd_eur"))
    return (month.groupBy("country_code", "line_family", "product_line")
            .agg(total_if(F.col("is_premium"), "amount_eur").alias("premiums_mtd_eur"),
                 total_if(F.col("is_claim_paid"), "amount_eur").alias("claims_paid_mtd_eur"),
                 count_where(F.col("claim_status") == "PENDING").alias("nb_claims_pending"),
                 mean(F.col("processing_days"), 1).cast("double").alias("avg_processing_days"))
            .withColumn("_share", share)
            .select(on.alias("report_date"), F.lit("CIMA").alias("regulator"), "country_code",
                    "line_family", "product_line", "premiums_mtd_eur", "claims_paid_mtd_eur",
                    F.col("_share").cast("double").alias("loss_ratio_mtd"),
                    F.lit(float(rules.loss_ratio_limit)).alias("loss_ratio_threshold"),
                    C.or_false(F.col("_share") > F.lit(rules.loss_ratio_limit))
                    .alias("loss_ratio_alert"),
                    "nb_claims_pending", "avg_processing_days"))


def missing_exports(files: DataFrame, countries: list[str], report_date: str,
                    mandatory: dict[str, bool] = REGULATORS) -> DataFrame:
    """Mandatory (regulator, country) pairs without a CSV file for the date. `files` has `path`."""
    spark = files.sparkSession
    rows = [(r, c) for r, needed in mandatory.items() if needed for c in countries]
    expected = spark.createDataFrame(rows, "regulator STRING, country_code STRING")
    pattern = f"([a-z]+)/report_date={report_date}/country_code=([A-Z]{{2}})/.*[.]csv$"
    produced = files.select(F.regexp_extract("path", pattern, 1).alias("regulator"),
                            F.regexp_extract("path", pattern, 2).alias("country_code"))
    return expected.join(produced.distinct(), ["regulator", "country_code"], "left_anti")
