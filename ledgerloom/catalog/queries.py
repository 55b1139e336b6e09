"""Registered queries, part 1: sources, sinks, columns, silver, gold and quality checks. Each
has its oracle SQL beside it."""
from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog import oracle_parts as P
from ledgerloom.catalog.adapters import AS_OF, REPORT_DATE, SECRET
from ledgerloom.catalog.lake import TODAY
from ledgerloom.catalog.registry import query
from ledgerloom.contracts import BANK_TRANSACTIONS, CONTRACTS
from ledgerloom.functions import columns as C
from ledgerloom.functions.columns import ISO_MILLIS
from ledgerloom.functions.money import MONEY, convert_to_eur, fx_rates
from ledgerloom.functions.validation import check_batch, file_stats, reject_reasons
from ledgerloom.operators import quality, tables
from ledgerloom.operators.dedup import content_hash, latest, mark_copies
from ledgerloom.operators.slices import in_turn, together
from ledgerloom.operators.tables import not_in
from ledgerloom.plans import gold, incremental, ingest, regulatory, rollups
from ledgerloom.sources import landing, topics
from ledgerloom.session import staged
from ledgerloom.streaming import jobs, messages

NOW = f"timestamp '{AS_OF}'"


# ------------------------------------------------------------------ sources
@query("select transaction_id, event_ts as \"timestamp\", country_code, amount from b_bank "
       "where country_code in ('CI', 'GH')", "b_bank")
def scan_country_filter(lake):
    return lake.bronze("bank_transactions").filter(F.col("country_code").isin("CI", "GH")).select(
        "transaction_id", "timestamp", "country_code", "amount")


def _files(lake):
    """One landing file per source file of the bank rows, sized by its rows."""
    rows = lake.bronze("bank_transactions").groupBy("_source_file").agg(F.count("*").alias("n"))
    return rows.select(F.col("_source_file").alias("path"), F.col("_source_file").alias("file_key"),
                       F.concat(F.lit("tag-"), F.col("n").cast("string")).alias("file_etag"))


@query("""
select f.path, f.file_key, f.file_etag from
  (select _source_file as path, _source_file as file_key, 'tag-' || cast(count(*) as varchar) as file_etag
   from b_bank group by 1) f
where not exists (select 1 from
  (select _source_file as file_key, 'tag-' || cast(count(*) filter (event_ts < timestamp '2024-07-01') as varchar) as file_etag
   from b_bank group by 1) j where j.file_key = f.file_key and j.file_etag = f.file_etag)""", "b_bank")
def skip_ingested_antijoin(lake):
    """The journal saw each file as it was before July 2024; files that grew since come again."""
    old = lake.bronze("bank_transactions").groupBy(F.col("_source_file").alias("file_key")).agg(
        F.count_if(F.col("timestamp") < F.lit("2024-07-01").cast("timestamp")).alias("n"))
    journal = old.select(F.lit("bank_transactions").alias("dataset"), F.lit("SUCCESS").alias("status"),
                         F.lit(None).cast("string").alias("target_table"), "file_key",
                         F.concat(F.lit("tag-"), F.col("n").cast("string")).alias("file_etag"))
    return landing.not_ingested(_files(lake), journal, "bank_transactions",
                                "raw.bank_transactions")


def _json_pairs(columns: dict[str, str]) -> str:
    """A JSON object text from name -> SQL text (already quoted where needed), NULLs left out."""
    pairs = ", ".join(f"case when {v} is not null then '\"{k}\":' || {v} end"
                      for k, v in columns.items())
    return f"'{{' || concat_ws(',', {pairs}) || '}}'"


def _text(c: str) -> str:
    return f"'\"' || {c} || '\"'"


_ISO = "%Y-%m-%dT%H:%M:%S.%g"
_MM_TEXT = {**{c: _text(f"cast({c} as varchar)") for c in CONTRACTS["mobile_money_payments"].columns},
            "timestamp": _text(f"strftime(event_ts, '{_ISO}')")}


@query(f"""
select payment_id as key, {_json_pairs({**_MM_TEXT,
       'ingestion_timestamp': _text(f"strftime({NOW}, '{_ISO}')"), 'source_file': _text('_source_file'),
       'landed_at': _text(f"strftime(_ingested_at, '{_ISO}')")})} as value,
       'raw-mobile-money-payments' as topic,
       regexp_extract(_source_file, '([A-Z]{{2}})/mobile_money_payments/', 1) as path_country
from b_mm""", "b_mm")
def csv_to_envelope(lake):
    """Landing rows are text; here their times are written as a file would have them."""
    rows = lake.bronze("mobile_money_payments").withColumn(
        "timestamp", F.date_format("timestamp", ISO_MILLIS))
    return topics.envelope(rows, CONTRACTS["mobile_money_payments"], F.col("_ingested_at"),
                           C.moment(AS_OF))


@query("""
select transaction_id, "timestamp" as event_time, txn_date, country_code, entity_type, transaction_type,
       channel, transaction_status, is_success, cast(amount as double) as amount, currency,
       cast(amount_eur as double) as amount_eur, cast(amount_eur as double) as streaming_amount_eur,
       account_key, customer_key, beneficiary_country, is_cross_border, is_high_value, is_aberrant
from s_bank""", "s_bank")
def topic_as_table(lake):
    return _bank_topic(lake).drop("_bronze_ingested_at", "_silver_processed_at", "_timestamp")


def _bank_topic(lake):
    published = messages.to_messages(lake.silver("bank_transactions"), "transaction_id")
    return topics.topic_view(published.withColumn("timestamp", C.moment(AS_OF)),
                             "silver-bank-transactions")


@query("""
select fx.currency, fx.rate_month, fx.eur_per_unit, fx.source, count(*) as nb_operations
from b_bank b join fx on fx.currency = b.currency and fx.rate_month = date_trunc('month', cast(b.event_ts as date))
group by all""", "b_bank", "fx", name="fx_rates")
def fx_rates_used(lake):
    """The rate table restricted to the months and currencies that occur in the data."""
    months = lake.bronze("bank_transactions").groupBy(
        "currency", C.month_of("timestamp").alias("rate_month")).agg(
            F.count("*").alias("nb_operations"))
    return months.join(fx_rates(lake.spark), ["currency", "rate_month"]).select(
        "currency", "rate_month", "eur_per_unit", "source", "nb_operations")


@query(f"""
select operation_id, operation_type, "timestamp", amount_eur, account_key, layer from (
  select *, 'batch' as layer from s_insurance where "timestamp" < timestamp '2023-12-01'
  union all select *, 'speed' from s_insurance where "timestamp" >= timestamp '2023-11-01')
where is_premium and "timestamp" > {NOW} - interval 366 days""", "s_insurance")
def premium_history_union(lake):
    rows = lake.silver("insurance_operations")
    parts = []
    for layer, part in (("batch", rows.filter("timestamp < '2023-12-01'")),
                        ("speed", rows.filter("timestamp >= '2023-11-01'"))):
        parts.append(jobs.union_history([part], AS_OF).withColumn("layer", F.lit(layer)))
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ sinks
def _mm_layers(lake):
    """A stored table (payments before the 20th) and an incoming batch that overlaps it."""
    rows = lake.bronze("mobile_money_payments")
    return (rows.filter("timestamp >= '2024-01-10'"), rows.filter("timestamp < '2024-01-20'"))


@query("""
select payment_id, event_ts as "timestamp", amount from b_mm where event_ts >= timestamp '2024-01-20'""",
       "b_mm")
def merge_insert_only(lake):
    batch, stored = _mm_layers(lake)
    return tables.not_in(batch, stored, "payment_id").select("payment_id", "timestamp", "amount")


@query("""
select 'mobile_money_payments' as table_name, count(*) filter (event_ts >= timestamp '2024-01-10') as in_batch,
       count(*) filter (event_ts >= timestamp '2024-01-20') as inserted,
       count(*) filter (event_ts >= timestamp '2024-01-10' and event_ts < timestamp '2024-01-20') as already_present
from b_mm""", "b_mm")
def merge_stats(lake):
    batch, stored = _mm_layers(lake)
    return tables.merge_counts(batch, stored, "payment_id", "mobile_money_payments")


def _new_accounts(lake):
    """Every dormant account is closed, and every customer opens one more account."""
    now = lake.bronze("accounts")
    opened = now.filter("account_type = 'CURRENT'").withColumns(
        {"account_id": F.concat(F.lit("N"), F.col("account_id")), "balance": F.lit(0).cast(MONEY)})
    return now.withColumn("status", F.when(F.col("status") == "DORMANT", "CLOSED")
                          .otherwise(F.col("status"))).unionByName(opened)


@query("""
select account_id, customer_id, balance, case when status = 'DORMANT' then 'CLOSED' else status end as status,
       case when status = 'DORMANT' then 'UPDATE' else 'KEEP' end as merge_action from b_accounts
union all
select 'N' || account_id, customer_id, cast(0 as decimal(20,2)), status, 'INSERT'
from b_accounts where account_type = 'CURRENT'""", "b_accounts")
def merge_upsert_changed(lake):
    business = [c for c in CONTRACTS["accounts"].columns if c != "account_id"]
    return tables.merge_result(_new_accounts(lake), lake.bronze("accounts"), "account_id",
                               business).select("account_id", "customer_id", "balance", "status",
                                                "merge_action")


@query("""
select dataset, record_key, country_code, reason from quarantine
where not (dataset = 'bank_transactions' and country_code in ('CI', 'SN'))
union all select dataset, record_key, country_code, 'RECHECKED;' || reason from quarantine
where dataset = 'bank_transactions' and country_code in ('CI', 'SN') and reason like '%BRANCH%'""",
       "quarantine")
def quarantine_replace(lake):
    held = lake.quarantine().drop("detected_at")
    scope = (F.col("dataset") == "bank_transactions") & F.col("country_code").isin("CI", "SN")
    again = held.filter(scope & F.col("reason").contains("BRANCH")).withColumn(
        "reason", F.concat(F.lit("RECHECKED;"), "reason"))
    return tables.replaced_rows(held, again, scope)


@query(f"""
select 'bceao' as regulator, k.c as country_code
from (select unnest(['CI', 'SN', 'ML', 'BF', 'GN', 'TG', 'BJ', 'GH']) as c) k
where k.c not in (select country_code from s_bank where txn_date = date '{REPORT_DATE}' and is_high_value)""",
       "s_bank")
def export_completeness(lake):
    """Files as exported for countries with a high-value transaction that day."""
    day = lake.silver("bank_transactions").filter(
        (F.col("txn_date") == C.day(REPORT_DATE)) & F.col("is_high_value"))
    files = day.select(F.concat(F.lit(f"/out/bceao/report_date={REPORT_DATE}/country_code="),
                                "country_code", F.lit("/part-0.csv")).alias("path"))
    return regulatory.missing_exports(files, ["CI", "SN", "ML", "BF", "GN", "TG", "BJ", "GH"],
                                      REPORT_DATE)


_MESSAGE = {"payment_id": _text("payment_id"), "timestamp": _text(f"strftime(\"timestamp\", '{_ISO}')"),
            "txn_date": _text("cast(txn_date as varchar)"), "country_code": _text("country_code"),
            **{c: f"cast({c} as varchar)" for c in ("amount", "amount_eur", "is_success",
                                                    "is_cross_border", "is_aberrant")},
            **{c: _text(c) for c in ("sender_country", "receiver_country", "sender_home_country",
                                     "entity_type", "payment_type", "operator", "status", "currency",
                                     "sender_key", "receiver_key", "customer_segment", "corridor")}}


@query(f"select payment_id as key, {_json_pairs(_MESSAGE)} as value from s_mm", "s_mm")
def to_message_json(lake):
    return messages.to_messages(lake.silver("mobile_money_payments").select(*_MESSAGE),
                                "payment_id")


def _dirty(lake):
    return lake.adapter("d_bank")


_ZONE_CURRENCY = "case when country_code in ('CI','SN','ML','BF','GN','TG','BJ') then 'XOF' when country_code = 'GH' then 'GHS' end"
_REASONS = f"""concat_ws(';',
  case when _corrupt_record is not null then 'MALFORMED_ROW' end,
  case when transaction_id is null then 'MISSING_TRANSACTION_ID' end,
  case when event_ts is null then 'MISSING_TIMESTAMP' end,
  case when country_code = 'XX' then 'INVALID_COUNTRY' end,
  case when entity_type = 'SHOP' then 'INVALID_ENTITY' end,
  case when currency = 'EUR' then 'INVALID_CURRENCY' end,
  case when currency in ('XOF', 'GHS') and currency <> {_ZONE_CURRENCY} then 'CURRENCY_COUNTRY_MISMATCH' end,
  case when transaction_type = 'GIFT' then 'INVALID_TRANSACTION_TYPE' end,
  case when channel = 'FAX' then 'INVALID_CHANNEL' end,
  case when amount < 0 then 'NEGATIVE_AMOUNT' end,
  case when transaction_id = 'T-1' then 'INVALID_KEY_FORMAT' end)"""
P.PARTS["d_ranked"] = (("d_bank",), f"""
select *, case when reason = '' then row_number() over (partition by reason = '', transaction_id
                                                        order by _source_file) end as rn
from (select *, {_REASONS} as reason from d_bank)""")


@query(f"""
select 'b1' as batch_id, 'bank_transactions' as dataset, _source_file as source_file,
       regexp_extract(_source_file, '((?:[A-Z]{{2}}|referentials)/bank_transactions/.*)$', 1) as file_key,
       't' as file_etag, '' as message, {NOW} as processed_at, count(*) as rows_read, count(*) filter (rn = 1) as rows_valid,
       count(*) filter (rn is null or rn > 1) as rows_rejected, 'SUCCESS' as status,
       'bronze.bank_transactions' as target_table
from d_ranked group by _source_file""", "d_ranked")
def ingestion_log(lake):
    rows = _dirty(lake)
    rejected = check_batch(rows, BANK_TRANSACTIONS, "b1", AS_OF).rejected
    stats = file_stats(rows, rejected)
    files = rows.select(F.col("_source_file").alias("path")).distinct().withColumns({
        "file_key": F.regexp_extract("path", "((?:[A-Z]{2}|referentials)/bank_transactions/.*)$", 1),
        "file_etag": F.lit("t")})
    return ingest.journal_rows(files, stats, BANK_TRANSACTIONS, "b1", "bronze.bank_transactions",
                               "SUCCESS", now=AS_OF)


@query("""
select 'bank_transactions' as dataset, batch_id, 'SUCCESS' as status, count(*) as files,
       cast(sum(rows_read) as bigint) as rows_read, cast(sum(rows_valid) as bigint) as rows_valid,
       cast(sum(rows_rejected) as bigint) as rows_rejected
from (select _source_file, coalesce(nullif(regexp_extract(_source_file, 'part-([0-9])', 1), ''), 'replay') as batch_id,
             count(*) as rows_read, count(*) filter (rn = 1) as rows_valid,
             count(*) filter (rn is null or rn > 1) as rows_rejected
      from d_ranked group by 1, 2)
group by batch_id order by batch_id limit 20""", "d_ranked")
def journal_by_batch(lake):
    """The last batches of the journal, here one per first digit of the file number."""
    rows = _dirty(lake)
    stats = file_stats(rows, check_batch(rows, BANK_TRANSACTIONS, "b1", AS_OF).rejected)
    digit = F.regexp_extract("_source_file", "part-([0-9])", 1)
    journal = stats.select(
        F.lit("bank_transactions").alias("dataset"), F.lit("SUCCESS").alias("status"),
        F.when(digit == "", "replay").otherwise(digit).alias("batch_id"), "rows_read", "rows_valid",
        "rows_rejected", C.moment(AS_OF).alias("processed_at"))
    return quality.journal_by_batch(journal).drop("processed_at")


@query("""
select 'insurance_operations' as table_name, count(distinct operation_id) as before, count(*) as after
from b_insurance having count(*) <> count(distinct operation_id)
union all select 'loan_repayments', count(distinct repayment_id), count(*) from b_loans
having count(*) <> count(distinct repayment_id)
union all select 'mobile_money_payments', count(distinct payment_id), count(*) from b_mm
having count(*) <> count(distinct payment_id)""", "b_insurance", "b_loans", "b_mm")
def idempotency_check(lake):
    """Row counts of merged tables against the same rows appended without a merge."""
    names = ("insurance_operations", "loan_repayments", "mobile_money_payments")
    appended = {n: lake.bronze(n) for n in names}
    merged = {}
    for n, df in appended.items():
        key = CONTRACTS[n].key
        batch = latest(df, key)
        known = batch.filter(F.pmod(F.xxhash64(key), F.lit(2)) == 0)    # what is there already
        merged[n] = known.unionByName(not_in(batch, known, key))
    return quality.changed_counts(quality.row_counts(merged), quality.row_counts(appended))


# ------------------------------------------------------------------ columns
@query("""
select customer_id, upper(trim(country_code)) as country_code, upper(trim(entity_type)) as entity_type,
       upper(trim(kyc_level)) as kyc_level from b_customers""", "b_customers")
def normalize_codes(lake):
    return lake.bronze("customers").select("customer_id", *[
        C.code(c).alias(c) for c in ("country_code", "entity_type", "kyc_level")])


@query("""
select customer_id, coalesce(trim(region), 'UNKNOWN') as region, coalesce(upper(trim(kyc_level)), 'UNKNOWN') as kyc_level,
       coalesce(is_active, false) as is_active from b_customers""", "b_customers")
def null_defaults(lake):
    return lake.bronze("customers").select(
        "customer_id", C.text_or_unknown("region").alias("region"),
        C.code_or_unknown("kyc_level").alias("kyc_level"), C.or_false("is_active").alias("is_active"))


@query(f"""
select transaction_id, sha256('{SECRET}|' || account_id) as account_key,
       {P.key('beneficiary_account')} as beneficiary_account_key from b_bank""", "b_bank")
def pseudonymize(lake):
    return lake.bronze("bank_transactions").select(
        "transaction_id", C.pseudonym("account_id", SECRET).alias("account_key"),
        C.pseudonym("beneficiary_account", SECRET).alias("beneficiary_account_key"))


@query(f"select transaction_id, _source_file, {_REASONS} as reject_reason from d_bank", "d_bank",
       name="reject_reasons")
def reject_reasons_per_row(lake):
    return lake.adapter("d_bank").select("transaction_id", "_source_file", reject_reasons(
        BANK_TRANSACTIONS).alias("reject_reason"))


@query(f"select transaction_id, country_code, {_ZONE_CURRENCY} as expected_currency from d_bank", "d_bank")
def expected_currency(lake):
    return lake.adapter("d_bank").select(
        "transaction_id", "country_code",
        C.expected_currency("country_code").alias("expected_currency"))


@query("""
select transaction_id as record_key, _source_file as source_file, 'valid' as side, '' as reject_reason
from d_ranked where rn = 1
union all
select transaction_id, _source_file, 'rejected', case when reason = '' then 'DUPLICATE_IN_BATCH' else reason end
from d_ranked where rn is null or rn > 1""", "d_ranked")
def validate_split(lake):
    return check_batch(_dirty(lake), BANK_TRANSACTIONS, "b1", AS_OF).sides.select(
        "record_key", F.col("_source_file").alias("source_file"), "side", "reject_reason")


@query("select dataset, record_key, country_code, reason from quarantine", "quarantine")
def orphan_split(lake):
    return lake.quarantine().drop("detected_at")


@query("select 'quarantine' as source, dataset, count(*) as nb from quarantine group by dataset", "quarantine")
def quarantine_union(lake):
    return lake.quarantine().groupBy(F.lit("quarantine").alias("source"), "dataset").agg(
        F.count("*").alias("nb"))


@query(f"""
select transaction_id, {P.eur('b.amount')} as amount_eur,
       {P.eur('b.amount')} > 1000000 or {P.eur('b.amount')} <= 0 or event_ts > {P.HORIZON} as is_aberrant
from b_bank b {P.rate('b.currency', 'b.event_ts')}""", "b_bank", "fx")
def flag_aberrant(lake):
    return _converted(lake).select("transaction_id", "amount_eur",
                                   C.is_aberrant("amount_eur", "timestamp", AS_OF).alias("is_aberrant"))


def _converted(lake):
    return convert_to_eur(lake.bronze("bank_transactions"), fx_rates(lake.spark), "timestamp",
                          {"amount": "amount_eur", "fee_amount": "fee_amount_eur"})


@query(f"""
select transaction_id, {P.eur('b.amount')} >= 15244.90 as is_high_value
from b_bank b {P.rate('b.currency', 'b.event_ts')}""", "b_bank", "fx")
def flag_high_value(lake):
    return _converted(lake).select("transaction_id",
                                   C.is_high_value("amount_eur").alias("is_high_value"))


@query("select transaction_id, beneficiary_country, is_cross_border from s_bank", "s_bank")
def flag_cross_border(lake):
    return lake.silver("bank_transactions").select("transaction_id", "beneficiary_country",
                                                   "is_cross_border")


@query(f"""
select payment_id, upper(trim(sender_country)) || '-' || receiver_country as corridor,
       upper(trim(sender_country)) in {P.ZONE} and receiver_country in {P.ZONE} as in_zone from b_mm""", "b_mm")
def corridor(lake):
    here, there = C.code("sender_country"), C.code("receiver_country")
    return lake.bronze("mobile_money_payments").select(
        "payment_id", C.corridor(here, there).alias("corridor"),
        C.in_zone(here, there).alias("in_zone"))


@query("""
select operation_id, line_family, claim_status, processing_days, is_premium, is_claim, is_claim_paid
from s_insurance""", "s_insurance")
def insurance_flags(lake):
    return lake.silver("insurance_operations").select(
        "operation_id", "line_family", "claim_status", "processing_days", "is_premium",
        "is_claim", "is_claim_paid")


@query("select account_key, account_type, balance_eur, outstanding_eur from s_accounts", "s_accounts")
def loan_outstanding(lake):
    return lake.silver("accounts").select("account_key", "account_type", "balance_eur",
                                          "outstanding_eur")


@query("""
select repayment_id, repayment_status, days_overdue, is_non_performing from s_loans""", "s_loans")
def flag_npl(lake):
    return lake.silver("loan_repayments").select("repayment_id", "repayment_status",
                                                 "days_overdue", "is_non_performing")


@query("""
select repayment_id, outstanding_eur, interest_rate, amount_paid_eur, interest_received_eur from s_loans""",
       "s_loans")
def interest_received(lake):
    return lake.silver("loan_repayments").select(
        "repayment_id", "outstanding_eur", "interest_rate", "amount_paid_eur",
        "interest_received_eur")


@query(f"select customer_id, cast({P.TODAY} - onboarding_date as int) as tenure_days from b_customers",
       "b_customers")
def tenure_days(lake):
    return lake.bronze("customers").select(
        "customer_id", C.tenure_days("onboarding_date", TODAY).alias("tenure_days"))


@query(f"""
select transaction_id, b.currency, amount, {P.eur('b.amount')} as amount_eur, {P.eur('b.fee_amount')} as fee_amount_eur
from b_bank b {P.rate('b.currency', 'b.event_ts')}""", "b_bank", "fx")
def fx_convert(lake):
    return _converted(lake).select("transaction_id", "currency", "amount", "amount_eur",
                                   "fee_amount_eur")


@query(f"""
select currency, month, count(*) as nb, count(amount_eur) as nb_converted,
       cast(sum(amount_eur) as decimal(20,2)) as amount_eur
from (select b.currency, cast(date_trunc('month', b.event_ts) as date) as month, {P.eur('b.amount')} as amount_eur
      from b_insurance b {P.rate('b.currency', 'b.event_ts')})
group by 1, 2""", "b_insurance", "fx")
def join_fx_broadcast(lake):
    converted = convert_to_eur(lake.bronze("insurance_operations"), fx_rates(lake.spark), "timestamp",
                               {"amount": "amount_eur"})
    return converted.groupBy("currency", C.month_of("timestamp").alias("month")).agg(
        F.count("*").alias("nb"), F.count("amount_eur").alias("nb_converted"),
        F.sum("amount_eur").cast(MONEY).alias("amount_eur"))


@query(f"""
select 'bank_transactions' as table_name, count(*) filter (currency <> {_ZONE_CURRENCY}) as mismatches from d_bank
union all select 'accounts', count(*) filter (currency <> {_ZONE_CURRENCY}) from b_accounts
union all select 'mobile_money_payments', count(*) filter (currency <> case when trim(country_code) = 'GH' then 'GHS' else 'XOF' end)
from (select *, upper(sender_country) as country_code from b_mm)""", "d_bank", "b_accounts", "b_mm")
def dq_currency(lake):
    mobile = lake.bronze("mobile_money_payments").withColumn("country_code",
                                                             C.code("sender_country"))
    return quality.currency_report({"bank_transactions": lake.adapter("d_bank"),
                                    "accounts": lake.bronze("accounts"),
                                    "mobile_money_payments": mobile})


# ------------------------------------------------------------------ silver
def _silver_query(name: str, part: str, fn_name: str) -> None:
    def run(lake):
        return lake.silver(name)
    run.__name__ = fn_name
    query(f"select * from {part}", part)(run)


for _name, _part, _fn in (
        ("customers", "s_customers", "silver_customers"), ("branches", "s_branches", "silver_branches"),
        ("products", "s_products", "silver_products"), ("accounts", "s_accounts", "silver_accounts"),
        ("bank_transactions", "s_bank", "silver_bank_transactions"),
        ("insurance_operations", "s_insurance", "silver_insurance"),
        ("mobile_money_payments", "s_mm", "silver_mobile_money"),
        ("loan_repayments", "s_loans", "silver_loans")):
    _silver_query(_name, _part, _fn)


# ------------------------------------------------------------------ dedup and windows
@query("select operation_id, event_ts as \"timestamp\", amount, claim_status from v_insurance", "v_insurance")
def dedup_latest(lake):
    return latest(lake.bronze("insurance_operations"), "operation_id").select(
        "operation_id", "timestamp", "amount", "claim_status")


@query("""
select operation_id, _source_file, event_ts as "timestamp",
       row_number() over (partition by operation_id order by _source_file) > 1 as is_copy
from b_insurance""", "b_insurance")
def dedup_in_batch(lake):
    rows = lake.bronze("insurance_operations")
    rows = rows.withColumn("_row_id", content_hash(rows))
    return mark_copies(rows, "operation_id", "_row_id", newest_file_wins=False).select(
        "operation_id", "_source_file", "timestamp", F.col("_is_copy").alias("is_copy"))


@query("""
select _source_file as source_file, count(*) as rows_read,
       count(*) filter (rn is null or rn > 1) as rows_rejected, count(*) filter (rn = 1) as rows_valid
from d_ranked group by 1""", "d_ranked", name="file_stats")
def file_stats_per_file(lake):
    rows = _dirty(lake)
    stats = file_stats(rows, check_batch(rows, BANK_TRANSACTIONS, "b1", AS_OF).rejected)
    return stats.withColumnRenamed("_source_file", "source_file")


@query("""
select account_key, country_code, entity_type, loan_type, is_non_performing from (
  select *, row_number() over (partition by account_key order by "timestamp" desc, repayment_id desc) as rn
  from s_loans where not is_aberrant and cast("timestamp" as date) <= date '2024-01-20') where rn = 1""", "s_loans")
def loan_last_status(lake):
    return gold.loan_last_status(lake.silver("loan_repayments"), TODAY)


@query("select * from loan_book", "loan_book")
def loan_book(lake):
    return gold.loan_book(lake.silver("loan_repayments"), lake.silver("accounts"), TODAY)


# ------------------------------------------------------------------ gold and regulatory
def _gold_query(table: str, part: str, fn_name: str) -> None:
    def run(lake):
        return lake.gold(table)
    run.__name__ = fn_name
    query(f"select * from {part}", part)(run)


for _name, _part, _fn in (
        ("daily_transaction_volume", "g_daily", "daily_transaction_volume"),
        ("npl_ratio_by_country", "g_npl", "npl_ratio"), ("customer_arpu_monthly", "g_arpc", "arpc_monthly"),
        ("loss_ratio_by_product", "g_loss", "loss_ratio"),
        ("claims_processing_time", "g_claims", "claims_processing_time"),
        ("mobile_money_daily_flow", "g_mobile", "mobile_daily_flow"),
        ("cross_border_transfers", "g_weekly", "cross_border_weekly")):
    _gold_query(_name, _part, _fn)


@query("select * from g_bceao", "g_bceao")
def regulatory_bank_daily(lake):
    return lake.bank_report()


@query("select * from g_cima", "g_cima")
def regulatory_insurance_mtd(lake):
    return lake.insurance_report()


@query("select distinct country_code from s_accounts", "s_accounts")
def country_spine(lake):
    return lake.silver("accounts").select("country_code").distinct()


# ------------------------------------------------------------------ gold after late rows
# First run: what had come in by July 2024, the amounts of May 2024 as first booked (a cent more), and
# payments in GHS still in quarantine. Then the rest comes, and both are corrected.

def _first_seen(rows, name):
    at = F.col("timestamp")
    seen = rows.filter(at < F.lit("2024-07-01").cast("timestamp"))
    may = at.between(F.lit("2024-05-01").cast("timestamp"), F.lit("2024-05-31 23:59:59").cast("timestamp"))
    seen = seen.withColumn("amount", F.when(may, F.col("amount") + F.lit("0.01").cast("decimal(20,2)"))
                           .otherwise(F.col("amount")).cast("decimal(20,2)"))
    return seen.filter("currency <> 'GHS'") if name == "mobile_money_payments" else seen


def _refreshed(lake, name):
    """(groups, table): an indicator built on first sight, then brought up to date."""
    refresh = incremental.TABLES[name]
    now = {n: together(lake.stored(n)) for n in refresh.inputs}
    before = {n: _first_seen(rows, n) for n, rows in now.items()}

    def marks(frames):
        return reduce(DataFrame.unionByName, [incremental.digests(f, n) for n, f in frames.items()])
    wanted = staged(incremental.groups(incremental.touched(marks(before), marks(now)), refresh))
    stored = incremental.with_country(refresh.build(*before.values()))
    if refresh.finish:
        stored = refresh.finish(stored)
    new = incremental.with_country(incremental.recomputed(refresh, now, wanted))
    return wanted, incremental.replaced(stored, new, wanted, refresh)


@query("select * from g_daily", "g_daily")
def gold_daily_refreshed(lake):
    return _refreshed(lake, "daily_transaction_volume")[1]


@query("select * from g_weekly", "g_weekly")
def gold_weekly_refreshed(lake):
    return _refreshed(lake, "cross_border_transfers")[1]


@query("""
select distinct country_code, txn_date as period from s_mm
where "timestamp" >= timestamp '2024-07-01' or currency = 'GHS'
   or "timestamp" between timestamp '2024-05-01' and timestamp '2024-05-31 23:59:59'""", "s_mm")
def gold_touched_groups(lake):
    return _refreshed(lake, "mobile_money_daily_flow")[0]


# ------------------------------------------------------------------ months from daily states
def _user_days(lake):
    payments = lake.silver("mobile_money_payments")
    users = gold.usable(payments).select(F.col("sender_key").alias("user_key"))
    return rollups.daily_users(payments, rollups.numbered(users))


@query("""
select cast(date_trunc('month', txn_date) as date) as month, country_code, currency,
       count(distinct sender_key) as active_users
from s_mm where not is_aberrant group by 1, 2, 3""", "s_mm")
def active_users_monthly(lake):
    return rollups.monthly_users(_user_days(lake))


@query("""
select d.day, d.country_code, d.currency, count(distinct m.sender_key) as active_users
from (select distinct txn_date as day, country_code, currency from s_mm where not is_aberrant) d
     join s_mm m on m.country_code = d.country_code and m.currency = d.currency and m.txn_date <= d.day
                and date_trunc('month', m.txn_date) = date_trunc('month', d.day)
where not m.is_aberrant group by 1, 2, 3""", "s_mm")
def active_users_to_date(lake):
    return rollups.users_to_date(_user_days(lake))


@query("""
select month, country_code, line_family, nb_claims, avg_processing_days, true as median_within,
       true as p90_within
from g_claims""", "g_claims")
def claim_times_from_days(lake):
    """Whether the quantiles of merged daily sketches keep the stated error, in every group."""
    operations = lake.silver("insurance_operations")
    return rollups.within_error(rollups.monthly_claims(rollups.daily_claims(operations)), operations)


# ------------------------------------------------------------------ quality reports
@query("""
select 'bank.account_id' as "check", count(*) as orphans from b_bank t left join b_accounts a using (account_id) where a.customer_id is null
union all select 'bank.beneficiary_account', count(*) from b_bank t left join b_accounts a on a.account_id = t.beneficiary_account where t.beneficiary_account is not null and a.account_id is null
union all select 'bank.branch_id', count(*) from b_bank t left join b_branches b using (branch_id) where b.city is null
union all select 'insurance.customer_id', count(*) from b_insurance o left join b_customers c on c.customer_id = o.customer_id where c.customer_id is null
union all select 'insurance.account_id', count(*) from b_insurance o left join b_accounts a on a.account_id = o.account_id where a.account_id is null
union all select 'mobile_money.sender_id', count(*) from b_mm p left join b_customers c on c.customer_id = p.sender_id where c.customer_id is null
union all select 'mobile_money.receiver_id', count(*) from b_mm p left join b_customers c on c.customer_id = p.receiver_id where c.customer_id is null
union all select 'loan.loan_account_id', count(*) from b_loans r left join b_accounts a on a.account_id = r.loan_account_id and a.account_type = 'LOAN' where a.account_id is null
union all select 'loan.customer_id', count(*) from b_loans r left join b_customers c on c.customer_id = r.customer_id where c.customer_id is null
union all select 'accounts.customer_id', count(*) from b_accounts a left join b_customers c on c.customer_id = a.customer_id where c.customer_id is null""",
       "b_bank", "b_insurance", "b_mm", "b_loans", "b_accounts", "b_customers", "b_branches")
def dq_orphans(lake):
    return quality.orphan_report({n: lake.bronze(n) for n in CONTRACTS if n != "products"})


@query("""
select 'bank_transactions' as table_name, count(*) - count(distinct transaction_id) as duplicates from b_bank
union all select 'insurance_operations', count(*) - count(distinct operation_id) from b_insurance
union all select 'mobile_money_payments', count(*) - count(distinct payment_id) from b_mm
union all select 'loan_repayments', count(*) - count(distinct repayment_id) from b_loans
union all select 'customers', count(*) - count(distinct customer_id) from b_customers
union all select 'accounts', count(*) - count(distinct account_id) from b_accounts""",
       "b_bank", "b_insurance", "b_mm", "b_loans", "b_customers", "b_accounts")
def dq_duplicates(lake):
    return quality.duplicate_report({n: (lake.bronze(n), CONTRACTS[n].key) for n in CONTRACTS
                                     if n not in ("branches", "products")})


@query("""
select 'bank_transactions' as dataset, case when reason = '' then 'DUPLICATE_IN_BATCH' else reason end as reject_reason,
       count(*) as nb from d_ranked where rn is null or rn > 1 group by 1, 2""", "d_ranked")
def rejects_by_reason(lake):
    return quality.rejects_by_reason(check_batch(_dirty(lake), BANK_TRANSACTIONS, "b1",
                                                 AS_OF).rejected)


@query("""
select 'bank_transactions' as dataset, (select count(*) from b_bank) as bronze, (select count(*) from s_bank) as silver
union all select 'insurance_operations', (select count(*) from b_insurance), (select count(*) from s_insurance)
union all select 'mobile_money_payments', (select count(*) from b_mm), (select count(*) from s_mm)
union all select 'loan_repayments', (select count(*) from b_loans), (select count(*) from s_loans)
union all select 'accounts', (select count(*) from b_accounts), (select count(*) from s_accounts)""",
       "b_bank", "s_bank", "b_insurance", "s_insurance", "b_mm", "s_mm", "b_loans", "s_loans",
       "b_accounts", "s_accounts")
def layer_counts(lake):
    names = [n for n in CONTRACTS if n not in ("customers", "branches", "products")]
    return quality.layer_counts({"bronze": {n: lake.bronze(n) for n in names},
                                 "silver": {n: lake.silver(n) for n in names}})


@query("""
select 'bronze' as layer, country_code, count(*) as row_count from b_bank group by 2
union all select 'silver', country_code, count(*) from s_bank group by 2
union all select 'gold', country_code, count(*) from g_daily group by 2""", "b_bank", "s_bank", "g_daily")
def partition_counts(lake):
    return quality.partition_counts({"bronze": lake.bronze("bank_transactions"),
                                     "silver": lake.silver("bank_transactions"),
                                     "gold": lake.gold("daily_transaction_volume")})


@query("select dataset, reason, count(*) as nb from quarantine group by 1, 2", "quarantine")
def quarantine_by_reason(lake):
    return quality.quarantine_by_reason(lake.quarantine())


_LEAKS = {"s_mm": ["payment_id", "country_code", "sender_country", "receiver_country",
                   "sender_home_country", "entity_type", "payment_type", "operator", "status",
                   "currency", "sender_key", "receiver_key", "customer_segment", "corridor"],
          "s_accounts": ["account_key", "customer_key", "country_code", "entity_type",
                         "account_type", "product_id", "product_name", "currency", "status",
                         "customer_segment", "kyc_level"],
          "s_bank": ["transaction_id", "country_code", "entity_type", "transaction_type", "channel",
                     "transaction_status", "currency", "account_key", "customer_key",
                     "beneficiary_account_key", "beneficiary_country", "account_type",
                     "customer_segment", "branch_id", "branch_city", "branch_region", "branch_type"],
          "s_insurance": ["operation_id", "country_code", "entity_type", "operation_type",
                          "product_line", "line_family", "claim_status", "currency", "customer_key",
                          "account_key", "customer_segment"],
          "s_loans": ["repayment_id", "country_code", "entity_type", "loan_type", "repayment_status",
                      "currency", "account_key", "customer_key", "customer_segment"],
          "s_customers": ["customer_key", "country_code", "entity_type", "segment", "kyc_level", "region"],
          "s_branches": ["branch_id", "country_code", "entity_type", "city", "region", "branch_type"],
          "s_products": ["product_id", "product_name", "product_category", "entity_type",
                         "country_code", "currency"],
          "documents": ["text", "lang", "source"]}
_SILVER_NAMES = {"s_mm": "mobile_money_payments", "s_accounts": "accounts",
                 "s_bank": "bank_transactions", "s_insurance": "insurance_operations",
                 "s_loans": "loan_repayments", "s_customers": "customers", "s_branches": "branches",
                 "s_products": "products"}
_ID = "[AC]-[0-9]{9}|[0-9]{3}-[0-9]{2}-[0-9]{4}"


@query(" union all ".join(
    f"select '{_SILVER_NAMES.get(t, t)}' as table_name, '{c}' as column_name, "
    f"count(*) filter (regexp_matches({c}, '{_ID}')) as leaks from {t}"
    for t, cs in _LEAKS.items() for c in cs), *_SILVER_NAMES)
def pii_leak_scan(lake):
    """Clear identifiers in every text column of the silver tables (none) and of the documents (whole
    texts are scanned)."""
    documents = lake.spark.read.parquet(f"{lake.folder}/documents.parquet")
    parts = ((name, part) for name in _SILVER_NAMES.values() for part in lake.silver_parts(name))
    return quality.leaks_together(in_turn(
        quality.leak_report({name: part}, _ID) for name, part in chain(parts, [("documents", documents)])))
