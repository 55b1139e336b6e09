"""Common table expressions for the oracle SQL, written for DuckDB independently of the
DataFrame code: the adapters, cleaned versions, silver tables and gold tables.

Money is checked in integer or decimal arithmetic; ratios are half-up integer divisions."""
from __future__ import annotations

from ledgerloom.catalog.adapters import ADAPTERS, AS_OF, REPORT_DATE, SECRET, duckdb_text

HORIZON = "timestamp '2024-01-21 00:00:00'"      # the fixed clock plus one day
TODAY = f"date '{AS_OF[:10]}'"
ZONE = "('CI', 'SN', 'ML', 'BF', 'GN', 'TG', 'BJ')"


def key(c: str) -> str:
    return f"case when {c} is not null then sha256('{SECRET}|' || {c}) end"


def eur(c: str, rate: str = "fx.eur_per_unit") -> str:
    return f"cast(round(cast({c} as decimal(20,2)) * {rate}, 2) as decimal(20,2))"


def rate(currency: str, at: str, alias: str = "fx") -> str:
    return (f"left join fx {alias} on {alias}.currency = {currency} "
            f"and {alias}.rate_month = date_trunc('month', cast({at} as date))")


def money(expr: str) -> str:
    return f"cast(coalesce({expr}, 0) as decimal(20,2))"


def half_up(num: str, den: str, scale: int) -> str:
    """num / den rounded half-up to `scale` digits by integer division; both are decimal(.,2)
    or integers. Works for negative numerators."""
    n = f"cast(({num}) * 100 as hugeint)"
    d = f"cast(({den}) * 100 as hugeint)"
    q = f"((2 * abs({n}) * {10 ** scale} + abs({d})) // (2 * abs({d})))"
    return f"(cast(sign({n}) * sign({d}) * {q} as decimal(38,0)) / cast({10 ** scale} as double))"


def ratio(num: str, den: str, scale: int = 4) -> str:
    return f"case when ({den}) > 0 then {half_up(num, den, scale)} end"


def mean(c: str, scale: int = 2, sql_type: str = "decimal(20,2)") -> str:
    return f"cast(case when count({c}) > 0 then {half_up(f'sum({c})', f'count({c})', scale)} end as {sql_type})"


def latest(source: str, k: str) -> str:
    return f"""select * exclude (rn) from (
  select *, row_number() over (partition by {k} order by _ingested_at desc nulls last,
                               _source_file desc nulls last) as rn from {source}) where rn = 1"""


ABERRANT = "{a} > 1000000 or {a} <= 0 or event_ts > " + HORIZON

# name -> (names it uses, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    n: ((), duckdb_text(n)) for n in ADAPTERS}
PARTS["fx"] = ((), """
select currency, rate_month, cast(round(1 / per_eur, 10) as decimal(12,10)) as eur_per_unit, source
from (select 'XOF' as currency, cast(m as date) as rate_month, cast(655.957 as double) as per_eur,
             'BCEAO_FIXED_PEG' as source
      from generate_series(timestamp '2020-01-01', timestamp '2030-12-01', interval 1 month) g(m)
      union all
      select 'GHS', cast(m as date),
             round(11.5::double + 0.03::double * t + 0.25::double * sin(t / 3.0::double), 4),
             'SYNTHETIC_REFERENCE'
      from (select m, (year(m) - 2020) * 12 + month(m) - 1 as t
            from generate_series(timestamp '2020-01-01', timestamp '2030-12-01', interval 1 month) g(m)))""")
for _n, _k in (("customers", "customer_id"), ("branches", "branch_id"), ("products", "product_id"),
               ("accounts", "account_id"), ("bank", "transaction_id"),
               ("insurance", "operation_id"), ("mm", "payment_id"), ("loans", "repayment_id")):
    PARTS[f"v_{_n}"] = ((f"b_{_n}",), latest(f"b_{_n}", _k))

PARTS["s_customers"] = (("v_customers",), f"""
select {key('customer_id')} as customer_key, upper(trim(country_code)) as country_code,
       upper(trim(entity_type)) as entity_type, coalesce(upper(trim(segment)), 'UNKNOWN') as segment,
       coalesce(upper(trim(kyc_level)), 'UNKNOWN') as kyc_level, onboarding_date,
       coalesce(trim(region), 'UNKNOWN') as region, coalesce(is_active, false) as is_active,
       cast({TODAY} - onboarding_date as int) as tenure_days
from v_customers""")
PARTS["s_branches"] = (("v_branches",), """
select branch_id, upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       coalesce(trim(city), 'UNKNOWN') as city, coalesce(trim(region), 'UNKNOWN') as region,
       coalesce(upper(trim(branch_type)), 'UNKNOWN') as branch_type,
       coalesce(is_active, false) as is_active
from v_branches""")
PARTS["s_products"] = (("v_products", "fx"), f"""
select product_id, trim(product_name) as product_name, upper(trim(product_category)) as product_category,
       upper(trim(entity_type)) as entity_type, upper(trim(country_code)) as country_code,
       p.currency, cast(coalesce(interest_rate, 0) as decimal(6,2)) as interest_rate,
       cast(coalesce(monthly_fee, 0) as decimal(20,2)) as monthly_fee,
       {eur('monthly_fee')} as monthly_fee_eur, launch_date, coalesce(is_active, false) as is_active
from v_products p {rate('p.currency', TODAY)}""")
PARTS["c_accounts"] = (("v_accounts", "v_customers", "v_products", "fx"), f"""
select a.*, c.segment as customer_segment, c.kyc_level, p.product_name, p.interest_rate,
       {eur('a.balance')} as balance_eur, {eur('a.credit_limit')} as credit_limit_eur,
       case when c.customer_id is null then 'ORPHAN_CUSTOMER' else '' end as reason
from v_accounts a left join v_customers c on c.customer_id = a.customer_id
     left join v_products p on p.product_id = a.product_id {rate('a.currency', TODAY)}""")
PARTS["s_accounts"] = (("c_accounts",), f"""
select {key('account_id')} as account_key, {key('customer_id')} as customer_key,
       upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       upper(trim(account_type)) as account_type, product_id,
       coalesce(product_name, 'UNKNOWN') as product_name,
       cast(coalesce(interest_rate, 0) as decimal(6,2)) as interest_rate, currency, balance,
       cast(coalesce(credit_limit, 0) as decimal(20,2)) as credit_limit, balance_eur,
       cast(coalesce(credit_limit_eur, 0) as decimal(20,2)) as credit_limit_eur,
       cast(case when account_type = 'LOAN' then -balance_eur else 0 end as decimal(20,2)) as outstanding_eur,
       opened_date, upper(trim(status)) as status,
       coalesce(customer_segment, 'UNKNOWN') as customer_segment,
       coalesce(kyc_level, 'UNKNOWN') as kyc_level
from c_accounts where reason = ''""")
PARTS["c_bank"] = (("v_bank", "v_accounts", "v_customers", "v_branches", "fx"), f"""
select t.*, a.account_type, a.customer_id, p.country_code as beneficiary_country,
       c.segment as customer_segment, b.city as branch_city, b.region as branch_region, b.branch_type,
       {eur('t.amount')} as amount_eur, {eur('t.fee_amount')} as fee_eur,
       concat_ws(';', case when a.account_id is null then 'ORPHAN_ACCOUNT' end,
                 case when t.beneficiary_account is not null and p.account_id is null
                      then 'ORPHAN_BENEFICIARY' end,
                 case when b.branch_id is null then 'ORPHAN_BRANCH' end) as reason
from v_bank t left join v_accounts a on a.account_id = t.account_id
     left join v_accounts p on p.account_id = t.beneficiary_account
     left join v_branches b on b.branch_id = t.branch_id
     left join v_customers c on c.customer_id = a.customer_id {rate('t.currency', 't.event_ts')}""")
PARTS["s_bank"] = (("c_bank",), f"""
select transaction_id, event_ts as "timestamp", cast(event_ts as date) as txn_date,
       upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       upper(trim(transaction_type)) as transaction_type,
       coalesce(upper(trim(channel)), 'UNKNOWN') as channel,
       upper(trim(transaction_status)) as transaction_status,
       transaction_status = 'SUCCESS' as is_success, amount,
       cast(coalesce(fee_amount, 0) as decimal(20,2)) as fee_amount, currency, amount_eur,
       cast(coalesce(fee_eur, 0) as decimal(20,2)) as fee_amount_eur,
       {key('account_id')} as account_key, {key('customer_id')} as customer_key,
       {key('beneficiary_account')} as beneficiary_account_key, beneficiary_country, account_type,
       coalesce(customer_segment, 'UNKNOWN') as customer_segment, branch_id, branch_city,
       branch_region, branch_type,
       transaction_type = 'INTERNATIONAL_WIRE' or beneficiary_country <> country_code as is_cross_border,
       amount_eur >= 15244.90 as is_high_value, {ABERRANT.format(a='amount_eur')} as is_aberrant
from c_bank where reason = ''""")
PARTS["c_insurance"] = (("v_insurance", "v_accounts", "v_customers", "fx"), f"""
select o.*, c.segment as customer_segment, {eur('o.amount')} as amount_eur,
       concat_ws(';', case when a.account_id is null then 'ORPHAN_POLICY_ACCOUNT' end,
                 case when c.customer_id is null then 'ORPHAN_CUSTOMER' end,
                 case when a.customer_id <> o.customer_id then 'POLICY_OWNER_MISMATCH' end) as reason
from v_insurance o left join v_accounts a on a.account_id = o.account_id
     left join v_customers c on c.customer_id = o.customer_id {rate('o.currency', 'o.event_ts')}""")
PARTS["s_insurance"] = (("c_insurance",), f"""
select operation_id, event_ts as "timestamp", cast(event_ts as date) as op_date,
       cast(date_trunc('month', event_ts) as date) as op_month,
       upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       upper(trim(operation_type)) as operation_type, upper(trim(product_line)) as product_line,
       case when product_line in ('VIE', 'PREVOYANCE') then 'VIE' else 'IARD' end as line_family,
       amount, currency, amount_eur,
       case when operation_type like 'CLAIM%' then upper(trim(claim_status)) end as claim_status,
       case when operation_type like 'CLAIM%' then processing_days end as processing_days,
       operation_type in ('PREMIUM_PAYMENT', 'POLICY_RENEWAL') as is_premium,
       operation_type like 'CLAIM%' as is_claim, operation_type = 'CLAIM_PAYMENT' as is_claim_paid,
       {key('customer_id')} as customer_key, {key('account_id')} as account_key,
       coalesce(customer_segment, 'UNKNOWN') as customer_segment,
       {ABERRANT.format(a='amount_eur')} as is_aberrant
from c_insurance where reason = ''""")
PARTS["c_mm"] = (("v_mm", "v_customers", "fx"), f"""
select p.*, s.segment as customer_segment, s.country_code as sender_home_country,
       {eur('p.amount')} as amount_eur, {eur('p.fee_amount')} as fee_eur,
       concat_ws(';', case when s.customer_id is null then 'ORPHAN_SENDER' end,
                 case when r.customer_id is null then 'ORPHAN_RECEIVER' end) as reason
from v_mm p left join v_customers s on s.customer_id = p.sender_id
     left join v_customers r on r.customer_id = p.receiver_id {rate('p.currency', 'p.event_ts')}""")
PARTS["s_mm"] = (("c_mm",), f"""
select payment_id, event_ts as "timestamp", cast(event_ts as date) as txn_date,
       upper(trim(sender_country)) as country_code, upper(trim(sender_country)) as sender_country,
       upper(trim(receiver_country)) as receiver_country, sender_home_country,
       upper(trim(entity_type)) as entity_type, upper(trim(payment_type)) as payment_type,
       coalesce(upper(trim(operator)), 'UNKNOWN') as operator, upper(trim(status)) as status,
       status = 'SUCCESS' as is_success, amount,
       cast(coalesce(fee_amount, 0) as decimal(20,2)) as fee_amount, currency, amount_eur,
       cast(coalesce(fee_eur, 0) as decimal(20,2)) as fee_amount_eur,
       {key('sender_id')} as sender_key, {key('receiver_id')} as receiver_key,
       coalesce(customer_segment, 'UNKNOWN') as customer_segment,
       upper(trim(sender_country)) <> upper(trim(receiver_country)) as is_cross_border,
       upper(trim(sender_country)) || '-' || upper(trim(receiver_country)) as corridor,
       upper(trim(sender_country)) in {ZONE} and upper(trim(receiver_country)) in {ZONE} as is_uemoa_corridor,
       {ABERRANT.format(a='amount_eur')} as is_aberrant
from c_mm where reason = ''""")
PARTS["c_loans"] = (("v_loans", "v_accounts", "v_customers", "v_products", "fx"), f"""
select r.*, c.segment as customer_segment, p.interest_rate, {eur('r.amount_due')} as amount_due_eur,
       {eur('r.amount_paid')} as amount_paid_eur,
       cast(greatest(-{eur('a.balance')}, 0) as decimal(20,2)) as outstanding_eur,
       concat_ws(';', case when a.account_id is null then 'ORPHAN_LOAN_ACCOUNT' end,
                 case when a.account_type <> 'LOAN' then 'NOT_A_LOAN_ACCOUNT' end,
                 case when c.customer_id is null then 'ORPHAN_CUSTOMER' end) as reason
from v_loans r left join v_accounts a on a.account_id = r.loan_account_id
     left join v_products p on p.product_id = a.product_id
     left join v_customers c on c.customer_id = r.customer_id {rate('r.currency', 'r.event_ts')}""")
# greatest/least skip NULL in both engines, so a row without a rate owes 0 and earned 0.
PARTS["s_loans"] = (("c_loans",), f"""
select repayment_id, event_ts as "timestamp", cast(date_trunc('month', event_ts) as date) as event_month,
       upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       upper(trim(loan_type)) as loan_type, upper(trim(repayment_status)) as repayment_status,
       due_date, payment_date, cast(coalesce(days_overdue, 0) as int) as days_overdue, amount_due,
       amount_paid, currency, amount_due_eur, amount_paid_eur, outstanding_eur,
       cast(coalesce(interest_rate, 0) as decimal(6,2)) as interest_rate,
       cast(least(amount_paid_eur, cast(
         (2 * cast(outstanding_eur * 100 as hugeint) * cast(coalesce(interest_rate, 0) * 100 as hugeint)
          + 120000) // 240000 as decimal(20,0)) * 0.01) as decimal(20,2)) as interest_received_eur,
       upper(trim(repayment_status)) = 'DEFAULT' or days_overdue > 90 as is_non_performing,
       {key('loan_account_id')} as account_key, {key('customer_id')} as customer_key,
       coalesce(customer_segment, 'UNKNOWN') as customer_segment,
       {ABERRANT.format(a='amount_due_eur')} as is_aberrant
from c_loans where reason = ''""")
PARTS["quarantine"] = (("c_accounts", "c_bank", "c_insurance", "c_mm", "c_loans"), """
select 'accounts' as dataset, account_id as record_key, country_code, reason from c_accounts where reason <> ''
union all select 'bank_transactions', transaction_id, country_code, reason from c_bank where reason <> ''
union all select 'insurance_operations', operation_id, country_code, reason from c_insurance where reason <> ''
union all select 'mobile_money_payments', payment_id, sender_country, reason from c_mm where reason <> ''
union all select 'loan_repayments', repayment_id, country_code, reason from c_loans where reason <> ''""")

# ------------------------------------------------------------------ gold
PARTS["g_daily"] = (("s_bank", "s_mm"), f"""
select txn_date, country_code, entity_type, transaction_type, currency, count(*) as nb_transactions,
       cast(count(*) filter (is_success) as bigint) as nb_success,
       {money('sum(amount)')} as total_amount_local, {money('sum(amount_eur)')} as total_amount_eur,
       {money('sum(amount_eur) filter (is_success)')} as amount_success_eur,
       {mean('amount_eur')} as avg_amount_eur,
       {ratio('count(*) filter (not is_success)', 'count(*)')} as failure_rate
from (select txn_date, country_code, entity_type, transaction_type, currency, is_success, amount,
             amount_eur from s_bank where not is_aberrant
      union all
      select txn_date, country_code, entity_type, payment_type, currency, is_success, amount,
             amount_eur from s_mm where not is_aberrant)
group by all""")


def loan_book(as_of: str) -> str:
    return f"""select l.account_key, l.country_code, l.entity_type, l.loan_type, l.is_non_performing,
       a.outstanding_eur
from (select *, row_number() over (partition by account_key order by "timestamp" desc, repayment_id desc) as rn
      from s_loans where not is_aberrant and cast("timestamp" as date) <= {as_of}) l
     join s_accounts a on a.account_key = l.account_key and a.account_type = 'LOAN'
where rn = 1"""


def npl(book: str, as_of: str) -> str:
    bad = "coalesce(sum(outstanding_eur) filter (is_non_performing), 0)"
    total = "coalesce(sum(outstanding_eur), 0)"
    return f"""select {as_of} as as_of_date, country_code, loan_type, count(*) as nb_loans,
       cast(count(*) filter (is_non_performing) as bigint) as nb_loans_npl,
       {money('sum(outstanding_eur)')} as outstanding_total_eur,
       {money('sum(outstanding_eur) filter (is_non_performing)')} as outstanding_npl_eur,
       {ratio(bad, total)} as npl_ratio, cast(0.05 as double) as bceao_threshold,
       {ratio(bad, total)} >= 0.05 as is_above_threshold
from (select country_code, loan_type, is_non_performing, outstanding_eur from {book}
      union all select country_code, 'ALL', is_non_performing, outstanding_eur from {book})
group by country_code, loan_type"""


PARTS["loan_book"] = (("s_loans", "s_accounts"), loan_book(TODAY))
PARTS["g_npl"] = (("loan_book",), npl("loan_book", TODAY))
PARTS["loan_book_d"] = (("s_loans", "s_accounts"), loan_book(f"date '{REPORT_DATE}'"))
PARTS["g_npl_d"] = (("loan_book_d",), npl("loan_book_d", f"date '{REPORT_DATE}'"))
PARTS["g_arpc"] = (("s_bank", "s_mm", "s_loans", "s_customers"), f"""
select month, country_code, customer_segment, commissions_eur, interest_eur, active_customers,
       cast(commissions_eur + interest_eur as decimal(20,2)) as revenue_eur,
       cast(case when active_customers > 0 then {half_up('commissions_eur + interest_eur', 'active_customers', 2)} end
            as decimal(20,4)) as arpc_eur
from (select month, e.country_code, coalesce(c.segment, 'UNKNOWN') as customer_segment,
             {money('sum(fee)')} as commissions_eur, {money('sum(interest)')} as interest_eur,
             count(distinct e.customer_key) as active_customers
      from (select cast(date_trunc('month', "timestamp") as date) as month, country_code, customer_key,
                   case when is_success then fee_amount_eur end as fee, null as interest
            from s_bank where not is_aberrant
            union all
            select cast(date_trunc('month', "timestamp") as date), country_code, sender_key,
                   case when is_success then fee_amount_eur end, null from s_mm where not is_aberrant
            union all
            select event_month, country_code, customer_key, null, interest_received_eur
            from s_loans where not is_aberrant) e
           left join s_customers c on c.customer_key = e.customer_key
      group by 1, 2, 3)""")
PARTS["g_loss"] = (("s_insurance",), f"""
select *, {ratio('claims_paid_eur', 'premiums_eur')} as loss_ratio, cast(0.7 as double) as cima_threshold,
       {ratio('claims_paid_eur', 'premiums_eur')} > 0.7 as is_above_threshold
from (select op_month as month, country_code, line_family, product_line,
             {money('sum(amount_eur) filter (is_premium)')} as premiums_eur,
             {money('sum(amount_eur) filter (is_claim_paid)')} as claims_paid_eur,
             cast(count(*) filter (is_premium) as bigint) as nb_premiums,
             cast(count(*) filter (is_claim_paid) as bigint) as nb_claims_paid
      from s_insurance where not is_aberrant group by 1, 2, 3, 4)""")
PARTS["g_claims"] = (("s_insurance",), f"""
select op_month as month, country_code, line_family, count(*) as nb_claims,
       {mean('processing_days', 1, 'double')} as avg_processing_days,
       quantile_disc(processing_days, 0.5) as median_processing_days,
       quantile_disc(processing_days, 0.9) as p90_processing_days,
       cast(count(*) filter (claim_status = 'PENDING') as bigint) as nb_pending,
       cast(count(*) filter (claim_status = 'PAID') as bigint) as nb_paid
from s_insurance where is_claim and processing_days is not null group by 1, 2, 3""")
PARTS["g_mobile"] = (("s_mm",), f"""
select txn_date as transaction_date, country_code, currency, count(*) as nb_transactions,
       cast(count(*) filter (is_success) as bigint) as nb_success,
       cast(count(*) filter (status = 'FAILED') as bigint) as nb_failed,
       cast(count(*) filter (status = 'PENDING') as bigint) as nb_pending,
       {money('sum(amount)')} as amount_total_local, {money('sum(amount_eur)')} as amount_total_eur,
       {money('sum(amount_eur) filter (is_success)')} as amount_success_eur,
       {money('sum(fee_amount_eur) filter (is_success)')} as fees_eur,
       count(distinct sender_key) as active_users,
       cast(count(*) filter (is_cross_border) as bigint) as nb_cross_border,
       {ratio("count(*) filter (status = 'FAILED')", 'count(*)')} as failure_rate
from s_mm where not is_aberrant group by 1, 2, 3""")
PARTS["g_weekly"] = (("s_bank", "s_mm"), f"""
select *, sender_country || '-' || receiver_country as corridor,
       sender_country in {ZONE} and receiver_country in {ZONE} as is_uemoa_corridor,
       sender_country as country_code,
       cast(case when prev_week_amount_eur <> 0
            then {half_up('(amount_total_eur - prev_week_amount_eur) * 100', 'prev_week_amount_eur', 2)} end
            as decimal(20,2)) as wow_change_pct
from (select week_start, sender_country, receiver_country, channel, nb_transfers, amount_total_eur,
             avg_amount_eur, lag(amount_total_eur) over (partition by sender_country, receiver_country,
             channel order by week_start) as prev_week_amount_eur
      from (select cast(date_trunc('week', "timestamp") as date) as week_start, sender_country,
                   receiver_country, channel, count(*) as nb_transfers,
                   {money('sum(amount_eur)')} as amount_total_eur, {mean('amount_eur')} as avg_amount_eur
            from (select "timestamp", country_code as sender_country, beneficiary_country as receiver_country,
                         'BANK_WIRE' as channel, amount_eur from s_bank
                  where is_cross_border and is_success and not is_aberrant and beneficiary_country is not null
                  union all
                  select "timestamp", sender_country, receiver_country, 'MOBILE_MONEY', amount_eur
                  from s_mm where is_cross_border and is_success and not is_aberrant)
            group by 1, 2, 3, 4))""")
# What the bank report needs as of its own date.
DATED = ("loan_book_d", "g_npl_d")
PARTS["g_bceao"] = (("s_bank", "s_mm", "s_accounts", "g_npl_d"), f"""
select date '{REPORT_DATE}' as report_date, 'BCEAO' as regulator, k.country_code,
       coalesce(b.n, 0) as nb_bank_transactions, {money('b.amount')} as bank_amount_eur,
       coalesce(b.high, 0) as nb_high_value_transactions, coalesce(m.n, 0) as nb_mobile_money_transactions,
       {money('m.amount')} as mobile_money_amount_eur,
       cast(coalesce(b.abroad, 0) + coalesce(m.abroad, 0) as decimal(20,2)) as cross_border_outflows_eur,
       {money('s.deposits')} as total_deposits_eur, {money('s.loans')} as total_loans_outstanding_eur,
       {money('n.outstanding_npl_eur')} as outstanding_npl_eur, n.npl_ratio,
       cast(0.05 as double) as npl_threshold, coalesce(n.npl_ratio >= 0.05, false) as npl_breach
from (select distinct country_code from s_accounts) k
left join (select country_code, count(*) as n, sum(amount_eur) filter (is_success) as amount,
                  count(*) filter (is_success and is_high_value) as high,
                  sum(amount_eur) filter (is_success and is_cross_border) as abroad
           from s_bank where not is_aberrant and txn_date = date '{REPORT_DATE}' group by 1) b using (country_code)
left join (select country_code, count(*) as n, sum(amount_eur) filter (is_success) as amount,
                  sum(amount_eur) filter (is_success and is_cross_border) as abroad
           from s_mm where not is_aberrant and txn_date = date '{REPORT_DATE}' group by 1) m using (country_code)
left join (select country_code, sum(balance_eur) filter (account_type in ('CURRENT', 'SAVINGS')) as deposits,
                  sum(outstanding_eur) as loans
           from s_accounts where status = 'ACTIVE' group by 1) s using (country_code)
left join (select * from g_npl_d where loan_type = 'ALL') n using (country_code)""")
PARTS["g_cima"] = (("s_insurance",), f"""
select date '{REPORT_DATE}' as report_date, 'CIMA' as regulator, country_code, line_family, product_line,
       premiums_mtd_eur, claims_paid_mtd_eur, {ratio('claims_paid_mtd_eur', 'premiums_mtd_eur')} as loss_ratio_mtd,
       cast(0.7 as double) as loss_ratio_threshold,
       coalesce({ratio('claims_paid_mtd_eur', 'premiums_mtd_eur')} > 0.7, false) as loss_ratio_alert,
       nb_claims_pending, avg_processing_days
from (select country_code, line_family, product_line,
             {money('sum(amount_eur) filter (is_premium)')} as premiums_mtd_eur,
             {money('sum(amount_eur) filter (is_claim_paid)')} as claims_paid_mtd_eur,
             cast(sum(case when claim_status = 'PENDING' then 1 when claim_status is not null then 0 end) as bigint) as nb_claims_pending,
             {mean('processing_days', 1, 'double')} as avg_processing_days
      from s_insurance where not is_aberrant
        and op_date between date_trunc('month', date '{REPORT_DATE}') and date '{REPORT_DATE}'
      group by 1, 2, 3)""")


def statement(body: str, *needs: str) -> str:
    """`body` after the WITH clause of everything it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dep in PARTS[name][0]:
                visit(dep)
            order.append(name)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} as materialized ({PARTS[n][1]})" for n in order)
    return f"with {head}\n{body}" if order else body
