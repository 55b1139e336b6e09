"""Column derivations shared by the silver tables and the stream rules."""
from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.contracts import expected_currency_sql
from ledgerloom.rules import DEFAULT_RULES, XOF_ZONE, Rules

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of: datetime | str | Column | None) -> Column:
    """The reference clock of an operator; the wall clock only when the caller gives none."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def day(as_of: date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def code(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def code_or_unknown(c: str | Column) -> Column:
    return F.coalesce(code(c), F.lit("UNKNOWN"))


def text_or_unknown(c: str | Column) -> Column:
    return F.coalesce(F.trim(col(c)), F.lit("UNKNOWN"))


def or_zero(c: str | Column, sql_type: str = "decimal(20,2)") -> Column:
    return F.coalesce(col(c), F.lit(0)).cast(sql_type)


def or_false(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(False))


def pseudonym(c: str | Column, secret: str) -> Column:
    """Salted SHA-256 of an identifier: the same key everywhere, NULL stays NULL."""
    if not secret:
        raise ValueError("a pseudonymisation secret is required")
    value = col(c)
    return F.when(value.isNotNull(), F.sha2(F.concat_ws("|", F.lit(secret), value), 256))


def expected_currency(country: str) -> Column:
    return F.expr(expected_currency_sql(f"`{country}`"))


def month_of(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def is_aberrant(amount_eur: str, at: str, as_of=None, rules: Rules = DEFAULT_RULES) -> Column:
    """Too large, not positive or dated in the future. Three-valued: with no rate the amount
    is NULL and so is the flag, unless the date alone decides."""
    horizon = moment(as_of) + F.expr(f"INTERVAL {rules.future_tolerance}")
    amount = F.col(amount_eur)
    return (amount > F.lit(rules.aberrant_eur)) | (amount <= 0) | (F.col(at) > horizon)


def is_high_value(amount_eur: str, rules: Rules = DEFAULT_RULES) -> Column:
    return F.col(amount_eur) >= F.lit(rules.high_value_eur)


def is_cross_border(transaction_type: str, home: str, beneficiary: str) -> Column:
    return ((F.col(transaction_type) == "INTERNATIONAL_WIRE")
            | (F.col(beneficiary) != F.col(home)))


def in_zone(*countries: str | Column) -> Column:
    flag = F.lit(True)
    for c in countries:
        flag = flag & col(c).isin(*XOF_ZONE)
    return flag


def corridor(sender: str | Column, receiver: str | Column) -> Column:
    return F.concat_ws("-", col(sender), col(receiver))


def line_family(product_line: str) -> Column:
    return F.when(F.col(product_line).isin("VIE", "PREVOYANCE"), "VIE").otherwise("IARD")


def is_premium(operation: str) -> Column:
    return F.col(operation).isin("PREMIUM_PAYMENT", "POLICY_RENEWAL")


def is_claim(operation: str) -> Column:
    return F.col(operation).isin("CLAIM_SUBMISSION", "CLAIM_PAYMENT")


def debt(balance: str | Column) -> Column:
    """What is owed on an account whose balance is negative."""
    return F.greatest(-col(balance), F.lit(0)).cast("decimal(20,2)")


def is_non_performing(status: Column, days_overdue: str,
                      rules: Rules = DEFAULT_RULES) -> Column:
    return (status == "DEFAULT") | (F.col(days_overdue) > rules.npl_overdue_days)


def interest_received(paid_eur: str, outstanding: Column, yearly_rate: Column) -> Column:
    """Monthly interest on the outstanding amount, limited to what was paid."""
    monthly = F.round(outstanding * yearly_rate.cast("decimal(6,2)") / F.lit(1200), 2)
    return F.least(F.col(paid_eur), monthly.cast("decimal(20,2)"))


def tenure_days(since: str, as_of=None) -> Column:
    return F.datediff(day(as_of), F.col(since))
