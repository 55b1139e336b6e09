"""Registered queries, part 2: analytical reports, serving views, alert rules, messages and
health. Each has its oracle SQL beside it."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerloom.catalog import oracle_parts as P
from ledgerloom.catalog.adapters import AS_OF, REPORT_DATE, SECRET
from ledgerloom.catalog.lake import TODAY
from ledgerloom.catalog.queries import _bank_topic
from ledgerloom.catalog.registry import query
from ledgerloom.contracts import BANK_TRANSACTIONS
from ledgerloom.functions import columns as C
from ledgerloom.operators.slices import in_turn, parts_of, together
from ledgerloom.plans import analytics as R
from ledgerloom.plans import serving, silver
from ledgerloom.rules import Rules
from ledgerloom.sources import topics
from ledgerloom.streaming import alerts as A
from ledgerloom.streaming import health, messages

NOW = f"timestamp '{AS_OF}'"
# Wallet payments stand in for bank transactions in the window rules; they are smaller.
SMALL = Rules(large_txn_xof=100_000)
SMALL_EUR = "152.45"
half_up, mean, money = P.half_up, P.mean, P.money


def pct(num: str, den: str, digits: int) -> str:
    return (f"cast(case when ({den}) <> 0 then {half_up(f'({num}) * 100', den, digits)} end "
            f"as decimal(20,{digits}))")


def dec(expr: str) -> str:
    return f"cast({expr} as decimal(20,2))"


# ------------------------------------------------------------------ bronze analytics
@query(f"""
select country_code, currency, count(*) as nb_accounts, {dec('sum(balance)')} as balance_total,
       {mean('balance')} as balance_avg, quantile_disc(balance, 0.5) as balance_median
from b_accounts where status = 'ACTIVE' and account_type <> 'LOAN' group by 1, 2""", "b_accounts")
def balances_by_country(lake):
    return R.balances_by_country(lake.bronze("accounts"))


@query(f"""
select country_code, entity_type, currency, count(*) as nb_loans, {dec('-sum(balance)')} as outstanding_total,
       {dec('sum(credit_limit)')} as granted_total
from b_accounts where account_type = 'LOAN' group by 1, 2, 3""", "b_accounts")
def loans_by_country(lake):
    return R.loans_by_country(lake.bronze("accounts"))


@query(f"""
select country_code, cast(date_trunc('month', event_ts) as date) as month, currency,
       count(*) as nb_transactions, count(*) filter (transaction_status = 'SUCCESS') as nb_success,
       {pct("count(*) filter (transaction_status = 'FAILED')", 'count(*)', 2)} as failed_pct,
       {dec("sum(amount) filter (transaction_status = 'SUCCESS')")} as success_amount
from b_bank group by 1, 2, 3""", "b_bank")
def monthly_volumes(lake):
    return R.monthly_volumes(lake.bronze("bank_transactions"))


@query(f"""
select transaction_type, channel, count(*) as nb, {dec('sum(amount)')} as amount from b_bank
where country_code = 'CI' and event_ts >= timestamp '2022-04-01' group by 1, 2""", "b_bank")
def volumes_type_channel(lake):
    return R.volumes_by_type_and_channel(lake.bronze("bank_transactions"), "CI", "2022-04-01")


@query("""
select c.entity_type, c.country_code, count(distinct c.customer_id) as nb_customers,
       count(a.account_id) as nb_accounts
from b_customers c left join b_accounts a on a.customer_id = c.customer_id group by 1, 2""",
       "b_customers", "b_accounts")
def entity_counts(lake):
    return R.entity_counts(lake.bronze("customers"), lake.bronze("accounts"))


@query("""
select country_code, entity_type, count(*) as nb_operations from (
  select country_code, entity_type from b_bank union all select country_code, entity_type from b_insurance
  union all select sender_country, entity_type from b_mm union all select country_code, entity_type from b_loans)
group by 1, 2""", "b_bank", "b_insurance", "b_mm", "b_loans")
def consolidated_activity(lake):
    mobile = lake.bronze("mobile_money_payments").withColumnRenamed("sender_country",
                                                                    "country_code")
    return R.consolidated_activity(lake.bronze("bank_transactions"),
                                   lake.bronze("insurance_operations"), mobile,
                                   lake.bronze("loan_repayments"))


@query(f"""
select sender_country, receiver_country, currency, count(*) as nb, {dec('sum(amount)')} as amount from b_mm
where payment_type = 'CROSS_BORDER_TRANSFER' and status = 'SUCCESS' group by 1, 2, 3""", "b_mm")
def corridors_raw(lake):
    return R.corridors_raw(lake.bronze("mobile_money_payments"))


@query(f"""
select country_code, product_line, {dec("sum(amount) filter (operation_type = 'PREMIUM_PAYMENT')")} as premiums,
       {dec("sum(amount) filter (operation_type = 'CLAIM_PAYMENT')")} as claims_paid,
       {mean('case when claim_status is not null then processing_days end', 4, 'decimal(20,4)')} as avg_processing_days
from b_insurance group by 1, 2""", "b_insurance")
def claims_by_product(lake):
    return R.claims_by_product(lake.bronze("insurance_operations"))


@query(f"""
select country_code, entity_type, repayment_status, nb, {pct('nb', 'tot', 1)} as pct from (
  select *, sum(nb) over (partition by country_code, entity_type) as tot from (
    select country_code, entity_type, repayment_status, count(*) as nb from b_loans group by 1, 2, 3))""",
       "b_loans")
def repayment_share(lake):
    return R.repayment_share(lake.bronze("loan_repayments"))


# ------------------------------------------------------------------ silver and gold reports
@query(f"""
select currency, count(*) as nb, {dec('sum(amount)')} as amount_local, {dec('sum(amount_eur)')} as amount_eur,
       count(*) filter (is_aberrant) as nb_aberrant, count(*) filter (is_high_value) as nb_high_value
from s_bank group by 1""", "s_bank")
def currency_totals(lake):
    return R.currency_totals(lake.silver("bank_transactions"))


@query(f"""
select cast(date_trunc('month', "timestamp") as date) as month, country_code, 'BANK' as business_line,
       'fees' as source, {dec('sum(fee_amount_eur)')} as revenue_eur
from s_bank where is_success and not is_aberrant group by 1, 2
union all select event_month, country_code, 'BANK', 'interest', {dec('sum(interest_received_eur)')}
from s_loans where not is_aberrant group by 1, 2
union all select op_month, country_code, 'INSURANCE', 'premiums', {dec('sum(amount_eur)')}
from s_insurance where is_premium and not is_aberrant group by 1, 2
union all select cast(date_trunc('month', "timestamp") as date), country_code, 'MOBILE_MONEY', 'fees',
       {dec('sum(fee_amount_eur)')} from s_mm where is_success and not is_aberrant group by 1, 2""",
       "s_bank", "s_loans", "s_insurance", "s_mm")
def revenue_by_line(lake):
    return R.revenue_by_line(lake.silver("bank_transactions"), lake.silver("loan_repayments"),
                             lake.silver("insurance_operations"),
                             lake.silver("mobile_money_payments"))


@query("""
select * from (
  select country_code, entity_type, product_name, nb_subscriptions, row_number() over (
    partition by country_code order by nb_subscriptions desc, product_name, entity_type)::int as rank
  from (select country_code, entity_type, product_name, count(*) as nb_subscriptions from s_accounts
        where entity_type in ('BANK', 'INSURANCE') and status = 'ACTIVE' group by 1, 2, 3))
where rank <= 10""", "s_accounts")
def top_products(lake):
    return R.top_products(lake.silver("accounts"))


@query(f"""
select country_code, cast(hour("timestamp") as int) as hour, count(*) as nb_payments,
       {dec('sum(amount_eur)')} as amount_eur from s_mm group by 1, 2""", "s_mm")
def payments_by_hour(lake):
    return R.payments_by_hour(lake.silver("mobile_money_payments"))


@query(f"""
select country_code, operator, count(*) as nb_payments, count(*) filter (status = 'FAILED') as nb_failed,
       {pct("count(*) filter (status = 'FAILED')", 'count(*)', 2)} as failure_pct from s_mm group by 1, 2""", "s_mm")
def failures_by_operator(lake):
    return R.failures_by_operator(lake.silver("mobile_money_payments"))


_NPL_PCT = "cast(round(cast(npl_ratio as decimal(20,4)) * 100, 2) as decimal(20,2))"


@query(f"""
select country_code, loan_type, nb_loans, nb_loans_npl, outstanding_total_eur, outstanding_npl_eur,
       {_NPL_PCT} as npl_pct, is_above_threshold from g_npl""", "g_npl")
def npl_sorted(lake):
    return R.npl_sorted(lake.gold("npl_ratio_by_country"))


@query(f"""
select country_code, as_of_date, {_NPL_PCT} as npl_pct, nb_loans, nb_loans_npl, outstanding_total_eur,
       outstanding_npl_eur from g_npl
where loan_type = 'ALL' and as_of_date = (select max(as_of_date) from g_npl)""", "g_npl")
def npl_latest(lake):
    return R.npl_latest(lake.gold("npl_ratio_by_country"))


@query("""
select txn_date, country_code, entity_type, transaction_type, nb_transactions, total_amount_eur, failure_rate
from g_daily where country_code = 'CI'
order by txn_date desc, total_amount_eur desc, entity_type, transaction_type limit 20""", "g_daily")
def topk_daily_volume(lake):
    return R.daily_volume_top(lake.gold("daily_transaction_volume"), "CI")


@query("""
select transaction_date, country_code, currency, nb_transactions, amount_total_eur,
       cast(round(cast(failure_rate as decimal(20,4)) * 100, 2) as decimal(20,2)) as failure_pct, active_users, fees_eur
from g_mobile where country_code = 'CI' order by transaction_date desc, currency limit 15""", "g_mobile")
def mobile_flow_last_days(lake):
    return R.mobile_flow_last_days(lake.gold("mobile_money_daily_flow"), "CI")


@query("""
select week_start, corridor, channel, nb_transfers, amount_total_eur, avg_amount_eur, wow_change_pct
from g_weekly where is_uemoa_corridor
order by week_start desc, amount_total_eur desc, corridor, channel limit 20""", "g_weekly")
def weekly_corridors_top(lake):
    return R.weekly_corridors_top(lake.gold("cross_border_transfers"))


@query(f"""
select country_code, {pct('sum(claims_paid_eur)', 'sum(premiums_eur)', 4)} as loss_ratio_pct
from g_loss group by 1""", "g_loss")
def loss_ratio_by_country(lake):
    return R.loss_ratio_by_country(lake.gold("loss_ratio_by_product"))


@query(f"""
select country_code, product_line, line_family, {pct('sum(claims_paid_eur)', 'sum(premiums_eur)', 1)} as loss_ratio_pct,
       70 as threshold_pct, {dec('sum(premiums_eur)')} as premiums_eur, {dec('sum(claims_paid_eur)')} as claims_paid_eur
from g_loss group by 1, 2, 3""", "g_loss")
def loss_ratio_total(lake):
    return R.loss_ratio_total(lake.gold("loss_ratio_by_product"))


@query(f"""
select country, {dec('sum(o)')} as outgoing_eur, {dec('sum(i)')} as incoming_eur from (
  select sender_country as country, amount_total_eur as o, 0 as i from g_weekly
  union all select receiver_country, 0, amount_total_eur from g_weekly) group by 1""", "g_weekly")
def country_in_out(lake):
    return R.country_in_out(lake.gold("cross_border_transfers"))


@query(f"""
select corridor, sender_country as country_code, receiver_country, channel,
       cast(sum(nb_transfers) as bigint) as nb_transfers, {dec('sum(amount_total_eur)')} as amount_eur
from g_weekly where sender_country <> receiver_country group by 1, 2, 3, 4""", "g_weekly")
def corridor_totals(lake):
    return R.corridor_totals(lake.gold("cross_border_transfers"))


@query(f"""
select corridor, {dec('sum(amount_total_eur)')} as amount_eur from g_weekly
where sender_country <> receiver_country group by 1 order by 2 desc, 1 limit 5""", "g_weekly")
def top_corridors(lake):
    return R.top_corridors(lake.gold("cross_border_transfers"))


def _over(num, den):
    return f"cast({half_up(num, den, 4)} as decimal(20,4))"


@query(f"""
select 'arpc_eur' as metric, {_over('sum(revenue_eur)', 'sum(active_customers)')} as value, cast(null as int) as target from g_arpc
union all select 'npl_pct', {_over('sum(outstanding_npl_eur) * 100', 'sum(outstanding_total_eur)')}, null from g_npl where loan_type = 'ALL'
union all select 'avg_processing_days',
       {_over('sum(cast(avg_processing_days as decimal(20,1)) * nb_claims)', 'sum(nb_claims)')}, 30 from g_claims""",
       "g_arpc", "g_npl", "g_claims")
def weighted_metrics(lake):
    return R.weighted_metrics(lake.gold_stored("customer_arpu_monthly"),
                              lake.gold_stored("npl_ratio_by_country"),
                              lake.gold_stored("claims_processing_time"))


EARLIER = "2023-12-31"
for _name in ("g_cima", "g_bceao", *P.DATED):
    _needs, _text = P.PARTS[_name]
    for _other in P.DATED:
        _text = re.sub(rf"\b{_other}\b", f"{_other}_before", _text)
    P.PARTS[f"{_name}_before"] = (tuple(f"{n}_before" if n in P.DATED else n for n in _needs),
                                  _text.replace(REPORT_DATE, EARLIER))


@query("""
select report_date, count(*) as countries, count(*) filter (npl_breach) as npl_breaches
from (select * from g_bceao union all select * from g_bceao_before) group by 1""",
       "g_bceao", "g_bceao_before")
def report_dates(lake):
    return R.report_dates(lake.bank_report().unionByName(lake.bank_report(EARLIER)))


@query("""
select * exclude (last_date)
from (select *, max(report_date) over () as last_date
      from (select * from g_cima union all select * from g_cima_before))
where report_date = last_date""",
       "g_cima", "g_cima_before")
def latest_report(lake):
    return R.latest_report(lake.insurance_report(EARLIER).unionByName(lake.insurance_report()))


# ------------------------------------------------------------------ serving
P.PARTS["batch_days"] = (("s_bank",), f"""
select country_code, transaction_type, txn_date, {money('sum(amount_eur)')} as total_amount_eur
from s_bank where not is_aberrant and "timestamp" < timestamp '2023-07-01' group by 1, 2, 3""")


def _batch_days(lake):
    bank = lake.silver("bank_transactions").filter("timestamp < '2023-07-01' AND NOT is_aberrant")
    return bank.groupBy("country_code", "transaction_type", "txn_date").agg(
        F.coalesce(F.sum("amount_eur"), F.lit(0)).cast("decimal(20,2)").alias("total_amount_eur"))


@query(f"""
select coalesce(b.country_code, s.country_code) as country, coalesce(b.txn_date, s.txn_date) as date,
       {dec('coalesce(b.total_amount_eur, 0) + coalesce(s.amount_eur, 0)')} as total_eur
from batch_days b full outer join s_bank s on s.country_code = b.country_code and s.txn_date = b.txn_date""",
       "batch_days", "s_bank")
def lambda_naive(lake):
    return serving.lambda_naive(_batch_days(lake), _bank_topic(lake).withColumn(
        "streaming_amount_eur", F.col("streaming_amount_eur").cast("decimal(20,2)")))


@query(f"""
with batch as (select country_code, txn_date, sum(total_amount_eur) as eur from batch_days group by 1, 2),
last_batch as (select country_code, max(txn_date) as last_day from batch group by 1),
speed as (select s.country_code, s.txn_date, sum(s.amount_eur) as eur, count(*) as n
          from s_bank s left join last_batch l on l.country_code = s.country_code
          where s.is_success and not s.is_aberrant and (l.last_day is null or s.txn_date > l.last_day)
          group by 1, 2)
select coalesce(b.country_code, s.country_code) as country, coalesce(b.txn_date, s.txn_date) as date,
       {money('b.eur')} as batch_eur, {money('s.eur')} as realtime_eur, coalesce(s.n, 0) as realtime_events,
       {dec('coalesce(b.eur, 0) + coalesce(s.eur, 0)')} as total_eur
from batch b full outer join speed s on s.country_code = b.country_code and s.txn_date = b.txn_date"""
       .replace("with batch", ", batch", 1), "batch_days", "s_bank")
def lambda_merged(lake):
    return serving.lambda_merged(_batch_days(lake), _bank_topic(lake).withColumn(
        "streaming_amount_eur", F.col("streaming_amount_eur").cast("decimal(20,2)")))


@query("select * from s_mm where country_code in ('CI', 'ML')", "s_mm")
def view_country(lake):
    return serving.secure_view(lake.silver("mobile_money_payments"), "silver",
                               "mobile_money_payments",
                               serving.Reader.of("country_analyst", "country_CI", "country_ML"))


@query("""
select * replace ('***' as account_key, '***' as customer_key,
                  case when is_claim then null else amount end as amount,
                  case when is_claim then null else amount_eur end as amount_eur) from s_insurance""",
       "s_insurance")
def view_masked(lake):
    return serving.secure_view(lake.silver("insurance_operations"), "silver",
                               "insurance_operations", serving.Reader.of("viewer"))


# ------------------------------------------------------------------ alert rules
def alert(rule, severity, *, ident, subject, country, entity, at, amount, details, source,
          start="cast(null as timestamp)", end="cast(null as timestamp)",
          local="cast(null as decimal(20,2))", currency="cast(null as varchar)",
          limit="cast(null as decimal(20,2))", where="true"):
    return f"""select sha256('{rule}|' || {ident}) as alert_id, '{rule}' as rule, '{severity}' as severity,
       {country} as country_code, {entity} as entity_type, {subject} as subject_key,
       {start} as window_start, {end} as window_end, {at} as event_time, {dec(amount)} as amount_eur,
       {local} as amount_local, {currency} as currency, {limit} as threshold, {details} as details
from {source} where {where}"""


def obj(**pairs):
    """JSON object text; values are SQL expressions, text ones wrapped by `q`."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs.items()) + " || '}'"


def q(c):
    return f"'\"' || {c} || '\"'"


P.PARTS["wallet"] = (("s_mm",), """
select payment_id as transaction_id, "timestamp", country_code, sender_key as account_key,
       case payment_type when 'P2P' then 'TRANSFER' when 'MERCHANT_PAYMENT' then 'PAYMENT'
            when 'BILL_PAYMENT' then 'WITHDRAWAL' when 'AIRTIME' then 'DEPOSIT'
            else 'INTERNATIONAL_WIRE' end as transaction_type, amount, currency, amount_eur, is_success
from s_mm""")
P.PARTS["wallet_windows"] = (("wallet",), """
select w.*, date_trunc('minute', "timestamp") - to_minutes(k) as w_start,
       date_trunc('minute', "timestamp") - to_minutes(k) + interval 5 minutes as w_end
from wallet w cross join (select unnest([0, 1, 2, 3, 4]) as k)""")
P.PARTS["bursts"] = (("wallet_windows",), alert(
    "MULTIPLE_LARGE_TXN", "HIGH", ident="account_key || '|' || cast(epoch_us(first_ts) as varchar)",
    subject="account_key", country="country_code", entity="'BANK'", at="last_ts", amount="total",
    start="w_start", end="w_end", limit=f"cast({SMALL_EUR} as decimal(20,2))",
    details=obj(nb_transactions="cast(nb as varchar)", threshold_xof_per_txn="'100000'"),
    source=f"""(select w_start, w_end, account_key, country_code, count(*) as nb, sum(amount_eur) as total,
            min("timestamp") as first_ts, max("timestamp") as last_ts from wallet_windows
            where amount_eur > {SMALL_EUR} group by 1, 2, 3, 4)""", where="nb >= 2"))


@query("select * from bursts", "bursts")
def burst_alerts(lake):
    return A.burst_alerts(lake.wallet_flows(), AS_OF, SMALL).drop("detected_at")


@query(f"""
select b.alert_id, b.window_start, w.transaction_id from bursts b
join wallet_windows w on w.account_key = b.subject_key and w.country_code = b.country_code
     and w.w_start = b.window_start where w.amount_eur > {SMALL_EUR}""", "bursts", "wallet_windows")
def burst_members(lake):
    flows = lake.wallet_flows()
    return A.burst_members(A.burst_alerts(flows, AS_OF, SMALL), flows, SMALL)


@query(f"""
select b.alert_id, b.window_start, b.details, count(*) as members
from bursts b join wallet_windows w on w.account_key = b.subject_key and w.country_code = b.country_code
     and w.w_start = b.window_start where w.amount_eur > {SMALL_EUR}
group by b.alert_id, b.window_start, b.details""", "bursts", "wallet_windows")
def burst_alert_details(lake):
    """Alerts beside the number of their member rows, which `nb_transactions` must equal."""
    flows = lake.wallet_flows()
    alerts = A.burst_alerts(flows, AS_OF, SMALL)
    members = A.burst_members(alerts, flows, SMALL).groupBy("alert_id", "window_start").agg(
        F.count("*").alias("members"))
    return alerts.join(members, ["alert_id", "window_start"]).select(
        "alert_id", "window_start", "details", "members")


P.PARTS["unusual"] = (("s_mm",), alert(
    "UNUSUAL_COUNTRY", "MEDIUM", ident="payment_id", subject="sender_key",
    country="sender_home_country", entity="'MOBILE_MONEY'", at='"timestamp"', amount="amount_eur",
    local="amount", currency="currency", source="s_mm",
    details=obj(payment_id=q("payment_id"), sender_country=q("sender_country"),
                sender_home_country=q("sender_home_country"), payment_type=q("payment_type")),
    where="sender_country <> sender_home_country"))


@query("select * from unusual", "unusual")
def unusual_country(lake):
    return A.unusual_country(lake.silver("mobile_money_payments"), AS_OF).drop("detected_at")


P.PARTS["premiums"] = (("s_insurance",), f"""
select account_key, {dec('sum(amount_eur)')} as annual_premium_eur from s_insurance
where is_premium and "timestamp" > {NOW} - interval 365 days group by 1""")
P.PARTS["excess_claims"] = (("s_insurance", "premiums"), alert(
    "CLAIM_EXCEEDS_PREMIUM", "HIGH", ident="operation_id", subject="account_key",
    country="country_code", entity="'INSURANCE'", at='"timestamp"', amount="amount_eur",
    local="amount", currency="currency", limit="cast(annual_premium_eur * 3 as decimal(20,2))",
    source="s_insurance join premiums using (account_key)",
    details=obj(operation_id=q("operation_id"), operation_type=q("operation_type"),
                product_line=q("product_line"),
                annual_premium_eur="cast(annual_premium_eur as varchar)",
                claim_to_premium_ratio="cast(cast("
                + half_up("amount_eur", "annual_premium_eur", 2) + " as decimal(20,2)) as varchar)"),
    where="is_claim and annual_premium_eur > 0 and amount_eur > 3 * annual_premium_eur"))


@query("select * from premiums", "premiums")
def annual_premium(lake):
    return A.annual_premiums(lake.silver("insurance_operations"), AS_OF)


@query("select * from excess_claims", "excess_claims")
def claims_over_premium(lake):
    operations = lake.silver("insurance_operations")
    return A.claims_over_premium(operations, A.annual_premiums(operations, AS_OF),
                                 AS_OF).drop("detected_at")


_AML_LIMIT = "case currency when 'XOF' then 1000000 when 'GHS' then 5000 end"
P.PARTS["aml"] = (("s_bank", "s_mm"), alert(
    "AML_THRESHOLD_EXCEEDED", "HIGH", ident="event_id", subject="subject", country="country_code",
    entity="entity", at='"timestamp"', amount="amount_eur", local="amount", currency="currency",
    limit=f"cast({_AML_LIMIT} as decimal(20,2))",
    details=obj(event_id=q("event_id"), operation=q("operation")),
    source="""(select transaction_id as event_id, 'BANK' as entity, transaction_type as operation,
        account_key as subject, "timestamp", country_code, amount, currency, amount_eur from s_bank
        where transaction_type in ('TRANSFER', 'INTERNATIONAL_WIRE')
        union all select payment_id, 'MOBILE_MONEY', payment_type, sender_key, "timestamp", country_code,
        amount, currency, amount_eur from s_mm where payment_type in ('P2P', 'CROSS_BORDER_TRANSFER'))""",
    where=f"amount >= {_AML_LIMIT}"))


def _aml(lake):
    return A.aml_events(lake.silver("bank_transactions"), lake.silver("mobile_money_payments"), AS_OF)


@query("select * from aml", "aml")
def aml_events(lake):
    return _aml(lake).drop("detected_at")


P.PARTS["flows"] = (("wallet_windows",), f"""
select w_start, w_end, country_code,
       {money("sum(amount_eur) filter (transaction_type in ('WITHDRAWAL', 'TRANSFER', 'INTERNATIONAL_WIRE'))")} as outflows_eur,
       {money("sum(amount_eur) filter (transaction_type = 'DEPOSIT')")} as inflows_eur, count(*) as nb_transactions
from wallet_windows where is_success group by 1, 2, 3""")
P.PARTS["reserves"] = (("s_accounts",), f"""
select country_code, {dec('sum(greatest(balance_eur, 0))')} as deposits_eur,
       cast({dec('sum(greatest(balance_eur, 0))')} * 0.03 as decimal(24,4)) as reserve_eur
from s_accounts where status = 'ACTIVE' and entity_type = 'BANK' and account_type in ('CURRENT', 'SAVINGS')
group by 1""")
P.PARTS["liquidity"] = (("flows", "reserves"), alert(
    "LIQUIDITY_COVERAGE_BREACH", "CRITICAL", subject="country_code", country="country_code",
    ident="country_code || '|' || cast(epoch_us(w_start) as varchar)", entity="'BANK'", at="w_end",
    amount="net", start="w_start", end="w_end",
    limit="cast(round(reserve_eur * 0.5, 2) as decimal(20,2))",
    details=obj(outflows_eur="cast(outflows_eur as varchar)", inflows_eur="cast(inflows_eur as varchar)",
                reserve_eur="cast(cast(round(reserve_eur, 2) as decimal(20,2)) as varchar)",
                share_of_reserve="cast(cast("
                + half_up("net * 100", "reserve_eur * 100", 4) + " as decimal(20,4)) as varchar)"),
    source="""(select *, outflows_eur - inflows_eur as net from flows join reserves using (country_code))""",
    where="net > reserve_eur * 0.5"))


@query("select w_start, w_end, country_code, outflows_eur, inflows_eur, nb_transactions, "
       "cast(outflows_eur - inflows_eur as decimal(20,2)) as net_outflow_eur from flows", "flows")
def liquidity_flows(lake):
    return A.liquidity_flows(lake.wallet_flows()).select(
        F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), "country_code",
        "outflows_eur", "inflows_eur", "nb_transactions", "net_outflow_eur")


@query("select * from reserves", "reserves")
def liquidity_reserves(lake):
    return A.liquidity_reserves(lake.silver("accounts"))


def _liquidity(lake):
    return A.liquidity_alerts(A.liquidity_flows(lake.wallet_flows()),
                              A.liquidity_reserves(lake.silver("accounts")), AS_OF)


@query("select * from liquidity", "liquidity")
def liquidity_alerts(lake):
    return _liquidity(lake).drop("detected_at")


@query("""
select * exclude (rn) from (select *, row_number() over (partition by rule, subject_key
  order by amount_eur desc, alert_id, window_start) as rn
  from (select * from bursts union all select * from unusual)) where rn = 1""", "bursts", "unusual")
def dedupe_alerts(lake):
    both = A.burst_alerts(lake.wallet_flows(), AS_OF, SMALL).unionByName(
        A.unusual_country(lake.silver("mobile_money_payments"), AS_OF))
    return A.dedupe_alerts(both).drop("detected_at")


@query("""
select * from aml a where not exists (select 1 from aml r
  where r.rule = a.rule and r.subject_key = a.subject_key and r.alert_id <> a.alert_id
    and abs(epoch_us(date_trunc('second', a.event_time)) - epoch_us(date_trunc('second', r.event_time))) < 300000000)""",
       "aml")
def suppress_repeats(lake):
    found = _aml(lake)
    return A.suppress_repeats(found, found).drop("detected_at")


@query(f"""
select cast(event_time as date) as alert_date, country_code, currency, count(*) as nb_alerts,
       {dec('sum(amount_eur)')} as amount_eur
from aml where event_time >= {P.TODAY} - interval 30 days group by 1, 2, 3""", "aml")
def aml_daily_30d(lake):
    return R.aml_daily(_aml(lake), TODAY)


@query(f"""
select 'gold-fraud-alerts' as topic, rule, severity, count(*) as alerts, {NOW} as last from unusual group by 2, 3
union all select 'gold-aml-events', rule || ' (' || currency || ')', severity, count(*), {NOW} from aml group by 2, 3
union all select 'gold-liquidity-alerts', rule, severity, count(*), {NOW} from liquidity group by 2, 3""",
       "unusual", "aml", "liquidity")
def alerts_by_rule(lake):
    return R.alerts_by_rule(A.unusual_country(lake.silver("mobile_money_payments"), AS_OF),
                            _aml(lake), _liquidity(lake))


@query("""
select rule, country_code, subject_key, event_time, amount_eur, threshold, details from unusual
order by event_time desc, alert_id limit 10""", "unusual")
def latest_alerts(lake):
    return R.latest_alerts(A.unusual_country(lake.silver("mobile_money_payments"), AS_OF))


# ------------------------------------------------------------------ messages
def _raw_messages(rows):
    """The dirty bank rows as topic messages: text fields, some broken JSON, some words in place
    of an amount. Each order's first copy takes offset = order key."""
    fields = [F.col(c).cast("string").alias(c) for c in BANK_TRANSACTIONS.columns if c != "amount"]
    number = F.col("fee_amount").cast("string")
    words = F.when(F.col("transaction_type") == "GIFT", "many").otherwise(
        F.col("amount").cast("string"))
    body = F.to_json(F.struct(*fields, words.alias("amount"), number.alias("ignored")))
    broken = F.when(F.col("_corrupt_record").isNotNull(), F.substring(body, F.lit(2), F.length(body)))
    key = F.hash("transaction_id", "account_id", "amount", "fee_amount").cast("bigint")
    return rows.select(F.coalesce(broken, body).alias("value"),
                       F.lit("raw-bank-transactions").alias("topic"),
                       F.col("copy").alias("partition"), key.alias("offset"),
                       C.moment(AS_OF).alias("kafka_ts"), "_source_file", "copy")


@query("""
select _source_file, copy, case when _corrupt_record is not null or transaction_id is null then 'position'
       else transaction_id end as event_key from d_bank""", "d_bank")
def event_key(lake):
    keyed = _raw_messages(lake.adapter("d_bank")).withColumn("event_key", messages.event_key())
    fallback = F.col("event_key").startswith("raw-bank-transactions:")
    return keyed.select("_source_file", "copy", F.when(fallback, "position").otherwise(
        F.col("event_key")).alias("event_key"))


_STREAM_REASONS = """case when _corrupt_record is not null then
  'MALFORMED_ROW;MISSING_TRANSACTION_ID;MISSING_TIMESTAMP;MISSING_ACCOUNT_ID;MISSING_BRANCH_ID;MISSING_COUNTRY_CODE;MISSING_TRANSACTION_TYPE;MISSING_AMOUNT;MISSING_CURRENCY;MISSING_TRANSACTION_STATUS;MISSING_ENTITY_TYPE'
  else concat_ws(';', case when transaction_type = 'GIFT' then 'MALFORMED_ROW' end,
  case when transaction_id is null then 'MISSING_TRANSACTION_ID' end,
  case when transaction_type = 'GIFT' then 'MISSING_AMOUNT' end,
  case when country_code = 'XX' then 'INVALID_COUNTRY' end,
  case when entity_type = 'SHOP' then 'INVALID_ENTITY' end,
  case when currency = 'EUR' then 'INVALID_CURRENCY' end,
  case when currency in ('XOF', 'GHS') and currency <> case when country_code = 'GH' then 'GHS'
       when country_code <> 'XX' then 'XOF' end then 'CURRENCY_COUNTRY_MISMATCH' end,
  case when transaction_type = 'GIFT' then 'INVALID_TRANSACTION_TYPE' end,
  case when channel = 'FAX' then 'INVALID_CHANNEL' end,
  case when amount < 0 and transaction_type <> 'GIFT' then 'NEGATIVE_AMOUNT' end,
  case when transaction_id = 'T-1' then 'INVALID_KEY_FORMAT' end) end"""
P.PARTS["d_stream"] = (("d_bank",), f"select *, {_STREAM_REASONS} as stream_reason from d_bank")


@query("""
select 'valid' as side, transaction_id as record_key, '' as reject_reason, 1 as nb
from d_stream where stream_reason = '' group by transaction_id
union all
select 'rejected', case when _corrupt_record is null then transaction_id end, stream_reason, count(*)
from d_stream where stream_reason <> '' group by 2, 3""", "d_stream")
def parse_messages(lake):
    """Valid rows once per key; rejected ones with their reasons, repeats not reported."""
    batch = messages.check_messages(_raw_messages(lake.adapter("d_bank")), BANK_TRANSACTIONS, 7, AS_OF)
    return batch.sides.groupBy("side", "record_key", "reject_reason").agg(F.count("*").alias("nb"))


def _letters(lake):
    """All letters, in parts: what copies are looked for among, and what is joined, is a part's."""
    for rows in parts_of(lake.adapter("d_bank"), "transaction_id"):
        rejected = messages.check_messages(_raw_messages(rows), BANK_TRANSACTIONS, 7, AS_OF).rejected
        yield messages.letters(rejected, "raw", AS_OF)
    for name, table in silver.TABLES.items():
        if table.checks:
            for part in lake.parts(name):
                yield messages.letters(part.quarantine, "silver")


@query(f"""
select record_key as key, {obj(stage="'\"silver\"'", dataset=q('dataset'), record_key=q('record_key'),
       country_code=q('country_code'), reject_reason=q('reason'),
       detected_at="'\"2024-01-20T00:00:00.000\"'")} as value from quarantine""", "quarantine")
def dlq_records(lake):
    return messages.letters(lake.quarantine(), "silver")


@query("""
select 'raw' as stage, 'bank_transactions' as dataset, split_part(stream_reason, ';', 1) as reason, count(*) as messages
from d_stream where stream_reason <> '' group by 3
union all select 'silver', dataset, split_part(reason, ';', 1), count(*) from quarantine group by 2, 3""",
       "d_stream", "quarantine")
def dlq_by_reason(lake):
    counts = in_turn(R.dead_letters_by_reason(topics.topic_view(
        letters.withColumn("timestamp", C.moment(AS_OF)), topics.DLQ_TOPIC)) for letters in _letters(lake))
    return together(counts).groupBy("stage", "dataset", "reason").agg(F.sum("messages").alias("messages"))


@query("""
select operation_id, date_trunc('millisecond', "timestamp") as "timestamp", country_code, operation_type,
       product_line, amount, currency, amount_eur, account_key, customer_key from s_insurance""", "s_insurance")
def parse_silver(lake):
    sent = messages.to_messages(lake.silver("insurance_operations"), "operation_id").withColumn(
        "timestamp", C.moment(AS_OF))
    return messages.silver_rows(sent, "insurance_operations").drop("kafka_ts")


_SECONDS = "epoch_us(date_trunc('millisecond', arrived)) - epoch_us(date_trunc('millisecond', landed))"


@query(f"""
select topic, count(*) as messages, max(lag) as max_lag_s, quantile_disc(lag, 0.95) as p95_lag_s from (
  select 'raw-mobile-money-payments' as topic, cast(({_SECONDS}) // 1000000 as bigint) as lag
  from (select event_ts as landed, event_ts + to_milliseconds(cast(amount as bigint) % 40000) as arrived from b_mm)
  union all
  select 'raw-bank-transactions', cast(({_SECONDS}) // 1000000 as bigint)
  from (select event_ts as landed, event_ts + to_milliseconds(cast(amount as bigint) % 25000) as arrived from b_bank))
group by 1""", "b_mm", "b_bank")
def topic_lag(lake):
    def arrived(name, topic, spread):
        rows = lake.bronze(name)
        landed = F.date_format("timestamp", C.ISO_MILLIS)
        at = F.timestamp_millis(F.unix_millis(F.col("timestamp").cast("timestamp"))
                                + F.col("amount").cast("bigint") % spread)
        return topics.topic_view(rows.select(
            F.to_json(F.struct(landed.alias("landed_at"))).alias("value"),
            at.alias("timestamp")), topic)
    return R.topic_lag({
        "raw-mobile-money-payments": arrived("mobile_money_payments",
                                             "raw-mobile-money-payments", 40_000),
        "raw-bank-transactions": arrived("bank_transactions", "raw-bank-transactions", 25_000)})


@query("""
select 'silver.bank_transactions' as source, count(*) as n, max("timestamp") as last_update from s_bank
union all select 'silver.mobile_money_payments', count(*), max("timestamp") from s_mm""", "s_bank", "s_mm")
def table_freshness(lake):
    return R.freshness({f"silver.{n}": (lake.silver(n), "timestamp")
                        for n in ("bank_transactions", "mobile_money_payments")})


# ------------------------------------------------------------------ health
P.PARTS["backlog"] = (("p_log",), """
select query, logged_at, topic, cast(sum(greatest(latest - done, 0)) as bigint) as lag from (
  select query, logged_at, t.topic, t.part,
         cast(json_extract_string(latest_offset, '$."' || t.topic || '"."' || t.part || '"') as bigint) as latest,
         coalesce(cast(json_extract_string(end_offset, '$."' || t.topic || '"."' || t.part || '"') as bigint), 0) as done
  from p_log cross join (values ('raw-a', '0'), ('raw-a', '1'), ('raw-b', '0'), ('raw-b', '2')) t(topic, part)
  where latest_offset is not null)
group by 1, 2, 3""")


@query("select * from backlog", "backlog")
def stream_lag(lake):
    return health.topic_backlog(lake.adapter("p_log"))


@query("""
select query, topic, lag from backlog b
where logged_at = (select max(logged_at) from p_log p where p.query = b.query and latest_offset is not null)""", "backlog")
def stream_lag_current(lake):
    return health.current_backlog(lake.adapter("p_log"))


@query("""
select query, max(logged_at) filter (event <> 'terminated') as last_seen,
       cast(epoch(timestamp '2024-01-31 00:00:00') as bigint)
         - cast(floor(epoch(max(logged_at) filter (event <> 'terminated'))) as bigint) as age_s,
       coalesce(arg_max(event, logged_at) filter (event in ('started', 'terminated')) <> 'terminated', true) as active,
       max(error) as error, cast(sum(input_rows) as bigint) as input_rows,
       coalesce(arg_max(event, logged_at) filter (event in ('started', 'terminated')) <> 'terminated', true)
         and max(error) is null
         and cast(epoch(timestamp '2024-01-31 00:00:00') as bigint)
           - cast(floor(epoch(max(logged_at) filter (event <> 'terminated'))) as bigint) < 900 as healthy
from p_log group by 1""", "p_log")
def stream_health(lake):
    return health.query_health(lake.adapter("p_log"), "2024-01-31 00:00:00", max_age=900)


@query("""
select job, counter, label, case when counter = 'country_lag' then max(n) else sum(n) end as value
from c_log group by 1, 2, 3""", "c_log")
def stream_counters(lake):
    return health.counters(lake.adapter("c_log"))


_CLOCK = "timestamp '2024-01-20 07:30:00'"


@query(f"""
select 'no_progress' as slo, query as subject,
       cast(epoch({_CLOCK}) as bigint) - max(cast(floor(epoch(logged_at)) as bigint)) > 420 as breached
from p_log where logged_at <= {_CLOCK} and event <> 'terminated' group by 2
union all
select 'backlog', query,
       coalesce(min(lag) filter (sec > cast(epoch({_CLOCK}) as bigint) - 60) > 5000, true)
       and coalesce(arg_max(lag, logged_at) filter (sec <= cast(epoch({_CLOCK}) as bigint) - 60) > 5000, false)
from (select query, logged_at, cast(floor(epoch(logged_at)) as bigint) as sec, sum(lag) as lag from backlog
      where logged_at <= {_CLOCK} group by 1, 2, 3) group by 2
union all
select 'report_missing', job,
       coalesce(max(logged_at) filter (status = 'SUCCESS') < timestamp '2024-01-20', true)
       or (max(logged_at) filter (status = 'FAILED') is not null
           and coalesce(max(logged_at) filter (status = 'FAILED') > max(logged_at) filter (status = 'SUCCESS'), true))
from r_log where logged_at <= {_CLOCK} group by 2""", "p_log", "backlog", "r_log")
def slo_breaches(lake):
    return health.slo_breaches(lake.adapter("p_log"), lake.adapter("r_log"),
                               "2024-01-20 07:30:00")


# ------------------------------------------------------------------ scalar families
@query(f"""
select transaction_id, upper(trim(channel)) as code, concat_ws('-', account_id, beneficiary_account) as pair,
       split_part(_source_file, '/', 2) as folder, regexp_matches(account_id, '^A-[0-9]+$') as well_formed,
       sha256('{SECRET}|' || account_id) as digest, country_code || ':' || currency as joined
from b_bank""", "b_bank")
def scalar_strings(lake):
    return lake.bronze("bank_transactions").select(
        "transaction_id", C.code("channel").alias("code"),
        F.concat_ws("-", "account_id", "beneficiary_account").alias("pair"),
        F.split_part("_source_file", F.lit("/"), F.lit(2)).alias("folder"),
        F.col("account_id").rlike("^A-[0-9]+$").alias("well_formed"),
        C.pseudonym("account_id", SECRET).alias("digest"),
        F.concat("country_code", F.lit(":"), "currency").alias("joined"))


@query(f"""
select payment_id, cast(event_ts as date) as day, cast(date_trunc('week', event_ts) as date) as week,
       cast(date_trunc('month', event_ts) as date) as month, cast(date_trunc('quarter', event_ts) as date) as quarter,
       cast(hour(event_ts) as int) as hour, cast({P.TODAY} - cast(event_ts as date) as int) as days_ago,
       strftime(event_ts, '{"%Y-%m-%dT%H:%M:%S.%g"}') as iso, event_ts + interval 5 minutes as later,
       cast((epoch_us(_ingested_at) - epoch_us(event_ts)) // 1000000 as bigint) as delay_s
from b_mm""", "b_mm")
def scalar_dates(lake):
    ts = F.col("timestamp")
    return lake.bronze("mobile_money_payments").select(
        "payment_id", F.to_date(ts).alias("day"), F.to_date(F.date_trunc("week", ts)).alias("week"),
        C.month_of(ts).alias("month"), F.to_date(F.date_trunc("quarter", ts)).alias("quarter"),
        F.hour(ts).alias("hour"), F.datediff(C.day(TODAY), ts).alias("days_ago"),
        F.date_format(ts, C.ISO_MILLIS).alias("iso"),
        (ts + F.expr("INTERVAL 5 MINUTES")).alias("later"),
        F.timestamp_diff("SECOND", ts, F.col("_ingested_at")).alias("delay_s"))


@query("""
select account_id, cast(greatest(-balance, 0) as decimal(20,2)) as owed, cast(least(balance, 100000) as decimal(20,2)) as capped,
       abs(balance) as size, -balance as negated, cast(round(balance, 0) as decimal(20,0)) as rounded,
       coalesce(credit_limit, 0) as credit_limit, nullif(status, 'DORMANT') as status
from b_accounts""", "b_accounts")
def scalar_math(lake):
    b = F.col("balance")
    return lake.bronze("accounts").select(
        "account_id", C.debt("balance").alias("owed"),
        F.least(b, F.lit(100000)).cast("decimal(20,2)").alias("capped"), F.abs(b).alias("size"),
        (-b).alias("negated"), F.round(b, 0).cast("decimal(20,0)").alias("rounded"),
        C.or_zero("credit_limit").alias("credit_limit"), F.nullif("status", F.lit("DORMANT")).alias("status"))


@query("""
select event_id, cast(json_extract_string(props, '$.k') as int) as k,
       cast(json_extract_string(props, '$.k') as int) is not distinct from cast(user_id % 100 as int) as same
from events""")
def scalar_json(lake):
    rows = lake.spark.read.parquet(f"{lake.folder}/events.parquet")
    parsed = F.from_json("props", "k INT")
    return rows.select("event_id", parsed["k"].alias("k"),
                       F.get_json_object("props", "$.k").try_cast("int").eqNullSafe(
                           (F.col("user_id") % 100).cast("int")).alias("same"))
