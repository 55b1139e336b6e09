"""The given tables seen as bronze tables. One text serves Spark SQL and DuckDB (but for the
spelling of "one row per array element"); it only shapes inputs, the operators under test are
written twice and independently.

Dates are shifted by whole days so that facts fall in 2018-2024: rates start in 2020 (earlier
rows have no rate) and the fixed clock 2024-01-20 leaves rows in the future."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-20 00:00:00"
REPORT_DATE = "2024-01-10"
SECRET = "fixture-secret"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def country(k: str) -> str:
    codes = ("CI", "SN", "ML", "BF", "GN", "TG", "BJ", "GH")
    return (f"case ({k}) % 8 " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(codes))
            + " end")


def currency(k: str) -> str:
    return f"case when ({k}) % 8 = 7 then 'GHS' else 'XOF' end"


def serial(prefix: str, k: str) -> str:
    return f"concat('{prefix}-', lpad(cast({k} as string), 9, '0'))"


# Lines belong to a customer through their order number; the divisor is the customer count.
LINE_CUSTOMER = "line_customer"
LINES = """(select *, l_orderkey % (select count(*) from customer) as line_customer
            from lineitem) as lines"""
SHIFT = "interval '8400' day"

ADAPTERS = {
    "b_customers": f"""
select {serial('C', 'c_custkey')} as customer_id, {country('c_custkey')} as country_code,
       case c_custkey % 4 when 0 then ' bank' when 1 then 'INSURANCE'
            when 2 then 'MOBILE_MONEY' else 'MICROFINANCE ' end as entity_type,
       c_mktsegment as segment,
       case c_custkey % 7 when 0 then null when 1 then 'standard ' else 'ENHANCED' end as kyc_level,
       cast('2020-01-01' as date) + cast(c_custkey % 1000 as int) as onboarding_date,
       case when c_nationkey % 5 = 0 then null
            else concat(' region_', cast(c_nationkey as string), ' ') end as region,
       case when c_custkey % 11 = 0 then null else c_custkey % 10 <> 0 end as is_active,
       'referentials/customers/full.csv' as _source_file,
       cast('2024-01-02 00:00:00' as timestamp) as _ingested_at
from customer""",
    "b_branches": f"""
select {serial('B', 's_suppkey')} as branch_id, {country('s_suppkey')} as country_code,
       'bank' as entity_type, s_name as city,
       case when s_nationkey % 3 = 0 then null
            else concat('region ', cast(s_nationkey as string)) end as region,
       case s_suppkey % 4 when 0 then 'full_service' when 1 then 'DIGITAL_ONLY'
            when 2 then 'AGENCY_BANKING' else 'ATM_POINT' end as branch_type,
       s_suppkey % 6 <> 0 as is_active,
       'referentials/branches/full.csv' as _source_file,
       cast('2024-01-02 00:00:00' as timestamp) as _ingested_at
from supplier""",
    "b_products": f"""
select {serial('P', 'p_partkey')} as product_id, concat(' ', p_name) as product_name,
       p_type as product_category, 'BANK' as entity_type, {country('p_partkey')} as country_code,
       {currency('p_partkey')} as currency,
       case when p_partkey % 13 = 0 then null
            else cast(p_size * 0.5 as decimal(6,2)) end as interest_rate,
       cast(p_retailprice as decimal(20,2)) as monthly_fee,
       cast('2019-01-01' as date) + cast(p_partkey % 700 as int) as launch_date,
       p_partkey % 9 <> 0 as is_active,
       'referentials/products/full.csv' as _source_file,
       cast('2024-01-02 00:00:00' as timestamp) as _ingested_at
from part""",
    "b_accounts": f"""
select {serial('A', 'c_custkey * 5 + k')} as account_id,
       case when (c_custkey * 5 + k) % 307 = 0 then 'C-999999999'
            else {serial('C', 'c_custkey')} end as customer_id,
       {country('c_custkey')} as country_code,
       case k when 3 then 'INSURANCE' when 4 then 'MOBILE_MONEY' else 'BANK' end as entity_type,
       case k when 0 then 'CURRENT' when 1 then 'SAVINGS' when 2 then 'LOAN'
              when 3 then 'INSURANCE_POLICY' else 'MOBILE_WALLET' end as account_type,
       case when (c_custkey + k) % 17 = 0 then null
            else {serial('P', '(c_custkey * 5 + k) % (select count(*) from part)')} end as product_id,
       {currency('c_custkey')} as currency,
       cast(case when k = 2 then -abs(cast(c_acctbal as decimal(18,2))) * 100
                 else cast(c_acctbal as decimal(18,2)) * 100 end as decimal(20,2)) as balance,
       cast(case when k = 2 then 5000000 else null end as decimal(20,2)) as credit_limit,
       cast('2021-03-01' as date) + cast(c_custkey % 900 as int) as opened_date,
       case when (c_custkey + k) % 9 = 0 then 'DORMANT' else 'ACTIVE' end as status,
       'referentials/accounts/full.csv' as _source_file,
       cast('2024-01-02 00:00:00' as timestamp) as _ingested_at
from customer EACH k IN 0, 1, 2, 3, 4""",
    "b_bank": f"""
select {serial('T', 'o_orderkey')} as transaction_id, o_orderdate + {SHIFT} as event_ts,
       case when o_orderkey % 97 = 0 then 'A-999999999'
            else {serial('A', 'o_custkey * 5 + o_orderkey % 2')} end as account_id,
       case when o_orderkey % 3 = 0 then null when o_orderkey % 89 = 0 then 'A-999999998'
            else {serial('A', '((o_custkey * 7 + o_orderkey) % (select count(*) from customer)) * 5')}
            end as beneficiary_account,
       case when o_orderkey % 101 = 0 then 'B-999999999'
            else {serial('B', 'o_orderkey % (select count(*) from supplier)')} end as branch_id,
       {country('o_custkey')} as country_code,
       case o_orderkey % 5 when 0 then 'TRANSFER' when 1 then 'PAYMENT' when 2 then 'WITHDRAWAL'
            when 3 then 'DEPOSIT' else 'INTERNATIONAL_WIRE' end as transaction_type,
       cast(cast(o_totalprice as decimal(18,2)) * 30 as decimal(20,2)) as amount,
       {currency('o_custkey')} as currency,
       case when o_orderkey % 20 = 0 then null else lower(o_orderpriority) end as channel,
       case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'FAILED' else 'REVERSED' end
            as transaction_status,
       case when o_orderkey % 31 = 0 then null
            else cast(cast(o_totalprice as decimal(18,2)) * 0.03 as decimal(20,2)) end as fee_amount,
       'BANK' as entity_type,
       concat('landing/', {country('o_custkey')}, '/bank_transactions/part-',
              cast(o_orderkey % 16 as string), '.csv') as _source_file,
       o_orderdate + {SHIFT} + interval '6' hour as _ingested_at
from orders""",
    "b_insurance": f"""
select concat('O-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as operation_id,
       l_shipdate + {SHIFT} as event_ts,
       case when l_orderkey % 199 = 0 then 'C-999999999'
            else {serial('C', LINE_CUSTOMER)} end as customer_id,
       case when l_orderkey % 197 = 0 then 'A-999999999'
            when l_orderkey % 193 = 0 then {serial('A', f'(({LINE_CUSTOMER} + 1) % (select count(*) from customer)) * 5 + 3')}
            else {serial('A', f'{LINE_CUSTOMER} * 5 + 3')} end as account_id,
       {country(LINE_CUSTOMER)} as country_code,
       case l_partkey % 5 when 0 then 'PREMIUM_PAYMENT' when 1 then 'CLAIM_SUBMISSION'
            when 2 then 'CLAIM_PAYMENT' when 3 then 'POLICY_RENEWAL'
            else 'POLICY_CANCELLATION' end as operation_type,
       case l_suppkey % 5 when 0 then 'VIE' when 1 then 'IARD_AUTO' when 2 then 'IARD_HABITATION'
            when 3 then 'IARD_SANTE' else 'PREVOYANCE' end as product_line,
       cast(cast(l_extendedprice as decimal(18,2)) * 100 as decimal(20,2)) as amount,
       {currency(LINE_CUSTOMER)} as currency,
       case l_returnflag when 'A' then 'paid' when 'N' then 'PENDING' else 'REJECTED' end
            as claim_status,
       case when l_partkey % 23 = 0 then null else cast(l_quantity as int) end as processing_days,
       'INSURANCE' as entity_type,
       concat(lpad(cast(l_partkey as string), 9, '0'), '-', lpad(cast(l_suppkey as string), 9, '0'),
              '-', lpad(cast(cast(l_quantity as int) as string), 4, '0'), '-',
              cast(cast(l_extendedprice as decimal(20,2)) as string), l_returnflag) as _source_file,
       l_shipdate + {SHIFT} as _ingested_at
from {LINES}""",
    "b_mm": f"""
select {serial('M', 'event_id')} as payment_id, ts as event_ts,
       {serial('C', 'user_id')} as sender_id,
       case when event_id % 89 = 0 then 'C-999999999'
            else {serial('C', '(user_id * 7 + event_id) % (select count(*) from customer)')} end
            as receiver_id,
       case when event_id % 20 = 0 then 'sn ' else {country('user_id')} end as sender_country,
       {country('(user_id * 7 + event_id) % (select count(*) from customer)')} as receiver_country,
       cast(cast(value as decimal(18,2)) * 10000 as decimal(20,2)) as amount,
       case when event_id % 20 = 0 then 'XOF' else {currency('user_id')} end as currency,
       case event_type when 'click' then 'P2P' when 'view' then 'MERCHANT_PAYMENT'
            when 'error' then 'BILL_PAYMENT' when 'signup' then 'AIRTIME'
            else 'CROSS_BORDER_TRANSFER' end as payment_type,
       case event_id % 4 when 0 then 'OP_A' when 1 then 'OP_B' when 2 then 'op_c' end as operator,
       case when event_id % 25 = 0 then 'FAILED' when event_id % 50 = 1 then 'PENDING'
            else 'SUCCESS' end as status,
       cast(cast(value as decimal(18,2)) * 100 as decimal(20,2)) as fee_amount,
       'MOBILE_MONEY' as entity_type,
       concat('landing/', {country('user_id')}, '/mobile_money_payments/part-',
              cast(event_id % 16 as string), '.csv') as _source_file,
       ts + interval '10' second as _ingested_at
from events""",
    "b_loans": f"""
select concat('R-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as repayment_id,
       l_shipdate + {SHIFT} as event_ts,
       case when l_orderkey % 223 = 0 then 'A-999999999'
            when l_orderkey % 211 = 0 then {serial('A', f'{LINE_CUSTOMER} * 5')}
            else {serial('A', f'{LINE_CUSTOMER} * 5 + 2')} end as loan_account_id,
       case when l_orderkey % 227 = 0 then 'C-999999999'
            else {serial('C', LINE_CUSTOMER)} end as customer_id,
       {country(LINE_CUSTOMER)} as country_code,
       cast(l_extendedprice as decimal(20,2)) as amount_due,
       cast(case when l_returnflag = 'R' then 0 else l_extendedprice end as decimal(20,2)) as amount_paid,
       {currency(LINE_CUSTOMER)} as currency,
       cast(l_shipdate + {SHIFT} as date) - cast(l_quantity as int) as due_date,
       cast(case when l_returnflag <> 'R' then l_shipdate + {SHIFT} end as date) as payment_date,
       case l_returnflag when 'R' then 71 + cast(l_quantity as int)
            when 'A' then cast(l_quantity as int) else 0 end as days_overdue,
       case l_suppkey % 3 when 0 then 'CONSUMER' when 1 then 'MORTGAGE' else 'SME' end as loan_type,
       case when l_returnflag = 'R' and l_quantity > 25 then 'DEFAULT'
            when l_returnflag = 'N' then 'ON_TIME' else 'LATE' end as repayment_status,
       case l_suppkey % 2 when 0 then 'BANK' else 'MICROFINANCE' end as entity_type,
       concat(lpad(cast(l_partkey as string), 9, '0'), '-', lpad(cast(l_suppkey as string), 9, '0'),
              '-', lpad(cast(cast(l_quantity as int) as string), 4, '0'), '-',
              cast(cast(l_extendedprice as decimal(20,2)) as string), l_returnflag) as _source_file,
       l_shipdate + {SHIFT} as _ingested_at
from {LINES}""",
}
# Bank rows under the full contract, with the known kinds of bad rows, replays and copies.
UUID_ID = "concat('00000000-0000-4000-8000-', lpad(cast(o_orderkey as string), 12, '0'))"
_DIRTY = f"""
select case when o_orderkey % 37 = 0 then null when o_orderkey % 59 = 0 then 'T-1'
            else {UUID_ID} end as transaction_id,
       case when o_orderkey % 41 = 0 then null else o_orderdate + {SHIFT} end as event_ts,
       {serial('A', 'o_custkey * 5')} as account_id,
       case when o_orderkey % 3 = 0 then null else {serial('A', '(o_orderkey % (select count(*) from customer)) * 5')} end
            as beneficiary_account,
       {serial('B', 'o_orderkey % (select count(*) from supplier)')} as branch_id,
       case when o_orderkey % 43 = 0 then 'XX' else {country('o_custkey')} end as country_code,
       case when o_orderkey % 47 = 0 then 'GIFT' else 'PAYMENT' end as transaction_type,
       cast(case when o_orderkey % 29 = 0 then -1 else 1 end
            * cast(o_totalprice as decimal(18,2)) * 30 as decimal(20,2)) as amount,
       case when o_orderkey % 31 = 0 then 'GHS' when o_orderkey % 71 = 0 then 'EUR'
            else {currency('o_custkey')} end as currency,
       case when o_orderkey % 20 = 0 then null when o_orderkey % 73 = 0 then 'FAX'
            else 'ATM' end as channel,
       case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'FAILED' else 'REVERSED' end
            as transaction_status,
       cast(cast(o_totalprice as decimal(18,2)) * 0.03 as decimal(20,2)) as fee_amount,
       case when o_orderkey % 79 = 0 then 'SHOP' else 'BANK' end as entity_type,
       case when o_orderkey % 41 = 0 then concat('broken,', cast(o_orderkey as string)) end
            as _corrupt_record, copy,
       o_orderkey * 4 + copy as _row_id,
       case when copy = 2 then 'landing/zz-replay.csv'
            else concat('landing/', {country('o_custkey')}, '/bank_transactions/part-',
                        cast(o_orderkey % 16 as string), '.csv') end as _source_file
from orders EACH copy IN 1, case when o_orderkey % 53 = 0 then 2 end, case when o_orderkey % 61 = 0 then 3 end
where copy is not null"""
ADAPTERS["d_bank"] = _DIRTY

# Logs shaped from `events`: one progress row per event, one run per user and day.
ADAPTERS["p_log"] = """
select 'silver_to_gold' as job, 'kafka' as source,
       case event_type when 'click' then 'event_rules' when 'view' then 'fraud_bursts'
            when 'error' then 'liquidity' else 'raw_to_silver' end as query,
       case when event_id % 997 = 0 then 'started' when event_id % 1301 = 0 then 'terminated'
            when event_id % 10 = 3 then 'idle' else 'progress' end as event,
       ts as logged_at, event_id % 100 as input_rows,
       case when event_id % 1301 = 0 and event_type = 'error' then 'state store lost' end as error,
       case when event_id % 10 = 3 then null
            when event_id % 4 = 0 then '{"raw-a": {"0": 5}}'
            else concat('{"raw-a": {"0": ', cast(event_id as string), ', "1": ',
                        cast(event_id % 50 as string), '}, "raw-b": {"0": 7}}') end as end_offset,
       case when event_id % 10 = 3 then null
            else concat('{"raw-a": {"0": ', cast(event_id + event_id % 30 as string),
                        ', "1": 40}, "raw-b": {"0": ', cast(event_id % 9 as string),
                        ', "2": 9000}}') end as latest_offset
from events"""
ADAPTERS["c_log"] = """
select case when event_id % 2 = 0 then 'raw_to_silver' else 'event_rules' end as job,
       event_id as batch_id, ts as logged_at,
       case event_type when 'click' then 'rows' when 'view' then 'alerts'
            when 'error' then 'dead_letters' else 'country_lag' end as counter,
       concat('label-', cast(user_id % 5 as string)) as label,
       cast(event_id % 40 as double) as n
from events"""
ADAPTERS["r_log"] = """
select concat('report-', cast(user_id % 6 as string)) as job, ts as logged_at,
       case when event_id % 3 = 0 then 'FAILED' else 'SUCCESS' end as status
from events"""
BRONZE = {"customers": "b_customers", "branches": "b_branches", "products": "b_products",
          "accounts": "b_accounts", "bank_transactions": "b_bank",
          "insurance_operations": "b_insurance", "mobile_money_payments": "b_mm",
          "loan_repayments": "b_loans"}


#: A customer's row becomes five accounts. The customers of a whole business are one small file, so one
#: task would make all accounts, and sort them to find the latest versions.
SPREAD = {"b_accounts": ("customer", "c_custkey", 64)}

_EACH = re.compile(r"EACH (\w+) IN ([^\n]+)")


def spark_text(name: str) -> str:
    return _EACH.sub(r"lateral view explode(array(\2)) each_one as \1", ADAPTERS[name])


def duckdb_text(name: str) -> str:
    return _EACH.sub(r"cross join unnest([\2]) as each_one(\1)", ADAPTERS[name])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def adapt(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An adapter as a frame; the base tables it names are bound as views."""
    text = spark_text(name)
    for t in set(re.findall(r"(?:from|join)\s+(\w+)", text)) & set(TABLES):
        rows = table(spark, folder, t)
        if name in SPREAD and SPREAD[name][0] == t:
            rows = rows.repartition(SPREAD[name][2], SPREAD[name][1])
        rows.createOrReplaceTempView(t)
    df = spark.sql(text)
    return df.withColumnRenamed("event_ts", "timestamp") if "event_ts" in df.columns else df
