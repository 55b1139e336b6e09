"""Data contracts: one object per dataset drives the read schema, the checks, the merge and the DDL."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.rules import COUNTRIES, CURRENCIES, ENTITY_TYPES, XOF_ZONE

CORRUPT = "_corrupt_record"
LINEAGE_DDL = ("_source_file STRING, _batch_id STRING, _ingested_at TIMESTAMP, "
               "_row_position BIGINT")
# What an envelope adds to a record.
ENVELOPE = ("ingestion_timestamp", "source_file", "landed_at")
# Key formats. A random (version 4) UUID for events, and for referentials
# an issuer prefix, country, kind letter and serial number.
UUID4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool


def required(name: str, kind: str) -> Field:
    return Field(name, kind, True)


def optional(name: str, kind: str) -> Field:
    return Field(name, kind, False)


def serial_id(kind: str, digits: int, issuer: str = "[A-Z]+") -> str:
    return f"^{issuer}-[A-Z]{{2}}-{kind}-[0-9]{{{digits},}}$"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@dataclass(frozen=True)
class Contract:
    name: str
    kind: str                       # "event" or "referential"
    fields: tuple[Field, ...]
    key_format: str
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    not_negative: tuple[str, ...] = ()
    country: str = "country_code"
    currency: str | None = "currency"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{f.name}` {f.type}" for f in self.fields))

    @property
    def read_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(CORRUPT, StringType())])

    @property
    def message_schema(self) -> StructType:
        """Messages carry every field as text, plus the envelope fields."""
        names = [*self.columns, *ENVELOPE, CORRUPT]
        return StructType([StructField(n, StringType()) for n in names])

    @property
    def table_schema(self) -> StructType:
        fields = list(self.schema.fields)
        if "country_code" not in self.columns:
            fields.append(StructField("country_code", StringType()))
        return StructType(fields + StructType.fromDDL(LINEAGE_DDL).fields)

    @property
    def day_column(self) -> str | None:
        return "event_day" if self.kind == "event" else None

    def landing_prefixes(self, countries=COUNTRIES) -> list[str]:
        if self.kind == "referential":
            return [f"referentials/{self.name}"]
        return [f"{c}/{self.name}" for c in countries]

    def violations(self) -> Iterator[tuple[str, str]]:
        """(label, SQL condition) in report order. A NULL condition does not fire, so a NULL
        value triggers only its MISSING rule."""
        yield "MALFORMED_ROW", f"{CORRUPT} IS NOT NULL"
        for c in self.required:
            yield f"MISSING_{c.upper()}", f"`{c}` IS NULL"
        yield "INVALID_COUNTRY", f"`{self.country}` NOT IN ({_quoted(COUNTRIES)})"
        yield "INVALID_ENTITY", f"entity_type NOT IN ({_quoted(ENTITY_TYPES)})"
        if self.currency:
            known = f"`{self.currency}` IN ({_quoted(CURRENCIES)})"
            yield "INVALID_CURRENCY", f"NOT {known}"
            yield ("CURRENCY_COUNTRY_MISMATCH",
                   f"{known} AND `{self.currency}` <> {expected_currency_sql(f'`{self.country}`')}")
        for c, values in self.allowed.items():
            yield f"INVALID_{c.upper()}", f"`{c}` NOT IN ({_quoted(values)})"
        for c in self.not_negative:
            yield f"NEGATIVE_{c.upper()}", f"`{c}` < 0"
        yield "INVALID_KEY_FORMAT", f"NOT regexp_like(`{self.key}`, '{self.key_format}')"


def expected_currency_sql(country: str) -> str:
    """NULL for a country outside the contract."""
    return (f"CASE WHEN {country} IN ({_quoted(XOF_ZONE)}) THEN 'XOF' "
            f"WHEN {country} = 'GH' THEN 'GHS' END")


# Fields, required marks and allowed codes of the eight datasets.
CUSTOMERS = Contract(
    "customers", "referential",
    (required("customer_id", "STRING"), required("country_code", "STRING"),
     required("entity_type", "STRING"), required("segment", "STRING"),
     required("kyc_level", "STRING"), required("onboarding_date", "DATE"),
     optional("region", "STRING"), required("is_active", "BOOLEAN")),
    serial_id("C", 6), currency=None,
    allowed={"segment": ("RETAIL", "SME", "CORPORATE", "PREMIUM"),
             "kyc_level": ("BASIC", "STANDARD", "ENHANCED")})

ACCOUNTS = Contract(
    "accounts", "referential",
    (required("account_id", "STRING"), required("customer_id", "STRING"),
     required("country_code", "STRING"), required("entity_type", "STRING"),
     required("account_type", "STRING"), optional("product_id", "STRING"),
     required("currency", "STRING"), required("balance", "DECIMAL(20,2)"),
     optional("credit_limit", "DECIMAL(20,2)"), required("opened_date", "DATE"),
     required("status", "STRING")),
    serial_id("A", 7), not_negative=("credit_limit",),
    allowed={"account_type": ("CURRENT", "SAVINGS", "LOAN", "MOBILE_WALLET", "INSURANCE_POLICY"),
             "status": ("ACTIVE", "FROZEN", "CLOSED", "DORMANT")})

BRANCHES = Contract(
    "branches", "referential",
    (required("branch_id", "STRING"), required("country_code", "STRING"),
     required("entity_type", "STRING"), required("city", "STRING"),
     optional("region", "STRING"), required("branch_type", "STRING"),
     optional("is_active", "BOOLEAN")),
    serial_id("B", 3), currency=None,
    allowed={"branch_type": ("FULL_SERVICE", "DIGITAL_ONLY", "AGENCY_BANKING", "ATM_POINT")})

PRODUCTS = Contract(
    "products", "referential",
    (required("product_id", "STRING"), required("product_name", "STRING"),
     required("product_category", "STRING"), required("entity_type", "STRING"),
     required("country_code", "STRING"), required("currency", "STRING"),
     optional("interest_rate", "DECIMAL(6,2)"), optional("monthly_fee", "DECIMAL(20,2)"),
     optional("launch_date", "DATE"), optional("is_active", "BOOLEAN")),
    serial_id("P", 3), not_negative=("interest_rate", "monthly_fee"))

BANK_TRANSACTIONS = Contract(
    "bank_transactions", "event",
    (required("transaction_id", "STRING"), required("timestamp", "TIMESTAMP"),
     required("account_id", "STRING"), optional("beneficiary_account", "STRING"),
     required("branch_id", "STRING"), required("country_code", "STRING"),
     required("transaction_type", "STRING"), required("amount", "DECIMAL(20,2)"),
     required("currency", "STRING"), optional("channel", "STRING"),
     required("transaction_status", "STRING"), optional("fee_amount", "DECIMAL(20,2)"),
     required("entity_type", "STRING")),
    UUID4, not_negative=("amount", "fee_amount"),
    allowed={"transaction_type": ("TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT",
                                  "INTERNATIONAL_WIRE"),
             "channel": ("BRANCH", "ATM", "MOBILE_APP", "INTERNET_BANKING", "USSD"),
             "transaction_status": ("SUCCESS", "FAILED", "REVERSED")})

INSURANCE_OPERATIONS = Contract(
    "insurance_operations", "event",
    (required("operation_id", "STRING"), required("timestamp", "TIMESTAMP"),
     required("customer_id", "STRING"), required("account_id", "STRING"),
     required("country_code", "STRING"), required("operation_type", "STRING"),
     required("product_line", "STRING"), required("amount", "DECIMAL(20,2)"),
     required("currency", "STRING"), optional("claim_status", "STRING"),
     optional("processing_days", "INT"), required("entity_type", "STRING")),
    UUID4, not_negative=("amount", "processing_days"),
    allowed={"operation_type": ("PREMIUM_PAYMENT", "CLAIM_SUBMISSION", "CLAIM_PAYMENT",
                                "POLICY_RENEWAL", "POLICY_CANCELLATION"),
             "product_line": ("VIE", "IARD_AUTO", "IARD_HABITATION", "IARD_SANTE", "PREVOYANCE"),
             "claim_status": ("PENDING", "APPROVED", "REJECTED", "PAID")})

MOBILE_MONEY_PAYMENTS = Contract(
    "mobile_money_payments", "event",
    (required("payment_id", "STRING"), required("timestamp", "TIMESTAMP"),
     required("sender_id", "STRING"), required("receiver_id", "STRING"),
     required("sender_country", "STRING"), required("receiver_country", "STRING"),
     required("amount", "DECIMAL(20,2)"), required("currency", "STRING"),
     required("payment_type", "STRING"), optional("operator", "STRING"),
     required("status", "STRING"), optional("fee_amount", "DECIMAL(20,2)"),
     required("entity_type", "STRING")),
    UUID4, not_negative=("amount", "fee_amount"), country="sender_country",
    allowed={"payment_type": ("P2P", "MERCHANT_PAYMENT", "BILL_PAYMENT", "AIRTIME",
                              "CROSS_BORDER_TRANSFER"),
             "status": ("SUCCESS", "FAILED", "PENDING"),
             "receiver_country": COUNTRIES})

LOAN_REPAYMENTS = Contract(
    "loan_repayments", "event",
    (required("repayment_id", "STRING"), required("timestamp", "TIMESTAMP"),
     required("loan_account_id", "STRING"), required("customer_id", "STRING"),
     required("country_code", "STRING"), required("amount_due", "DECIMAL(20,2)"),
     required("amount_paid", "DECIMAL(20,2)"), required("currency", "STRING"),
     required("due_date", "DATE"), optional("payment_date", "DATE"),
     required("days_overdue", "INT"), required("loan_type", "STRING"),
     required("repayment_status", "STRING"), required("entity_type", "STRING")),
    UUID4, not_negative=("amount_due", "amount_paid", "days_overdue"),
    allowed={"loan_type": ("CONSUMER", "MORTGAGE", "SME", "AGRICULTURAL", "MICROCREDIT"),
             "repayment_status": ("ON_TIME", "LATE", "DEFAULT")})

CONTRACTS = {c.name: c for c in (
    CUSTOMERS, ACCOUNTS, BRANCHES, PRODUCTS, BANK_TRANSACTIONS, INSURANCE_OPERATIONS,
    MOBILE_MONEY_PAYMENTS, LOAN_REPAYMENTS)}
REFERENTIALS = [n for n, c in CONTRACTS.items() if c.kind == "referential"]
EVENTS = [n for n, c in CONTRACTS.items() if c.kind == "event"]


def for_deployment(contracts: dict[str, Contract], issuer: str | None = None,
                   operators: tuple[str, ...] = ()) -> dict[str, Contract]:
    """The contracts with what belongs to a deployment: the issuer that identifiers of referentials
    start with, and the list of mobile operators. Pass the result to ingestion and streams."""
    out = {}
    for name, contract in contracts.items():
        if issuer and contract.kind == "referential" and contract.key_format.startswith("^[A-Z]+"):
            contract = replace(contract, key_format=contract.key_format.replace(
                "^[A-Z]+", f"^{issuer}", 1))
        if operators and "operator" in contract.columns:
            contract = replace(contract, allowed={**contract.allowed, "operator": operators})
        out[name] = contract
    return out
