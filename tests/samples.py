"""Hand-made rows: a small group with two countries, as bronze frames and as CSV files."""
from __future__ import annotations

import csv
import uuid
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from ledgerloom.contracts import CONTRACTS

T0 = datetime(2026, 5, 4, 10, 0, 0)
LINEAGE = {"_source_file": "f1.csv", "_batch_id": "b0", "_ingested_at": T0}


def uid(n: int) -> str:
    return str(uuid.UUID(int=n, version=4))


def customer(i, cc="CI", **over):
    return {"customer_id": f"ACME-{cc}-C-{i:06d}", "country_code": cc, "entity_type": "BANK",
            "segment": "RETAIL", "kyc_level": "STANDARD", "onboarding_date": date(2024, 1, 1),
            "region": "South", "is_active": True, **over}


def account(i, owner, kind="CURRENT", cc="CI", **over):
    return {"account_id": f"ACME-{cc}-A-{i:07d}", "customer_id": owner, "country_code": cc,
            "entity_type": "BANK", "account_type": kind, "product_id": f"ACME-{cc}-P-001",
            "currency": "GHS" if cc == "GH" else "XOF", "balance": Decimal("1000000.00"),
            "credit_limit": None, "opened_date": date(2024, 2, 1), "status": "ACTIVE", **over}


def branch(cc="CI", **over):
    return {"branch_id": f"ACME-{cc}-B-001", "country_code": cc, "entity_type": "BANK",
            "city": "Town", "region": None, "branch_type": "FULL_SERVICE", "is_active": True,
            **over}


def product(cc="CI", **over):
    return {"product_id": f"ACME-{cc}-P-001", "product_name": "Basic", "product_category": "LOAN",
            "entity_type": "BANK", "country_code": cc, "currency": "XOF",
            "interest_rate": Decimal("12.00"), "monthly_fee": Decimal("500.00"),
            "launch_date": None, "is_active": True, **over}


def bank(n, acc, cc="CI", **over):
    return {"transaction_id": uid(n), "timestamp": T0, "account_id": acc,
            "beneficiary_account": None, "branch_id": f"ACME-{cc}-B-001", "country_code": cc,
            "transaction_type": "TRANSFER", "amount": Decimal("655957.00"),
            "currency": "GHS" if cc == "GH" else "XOF", "channel": "ATM",
            "transaction_status": "SUCCESS", "fee_amount": Decimal("0.00"),
            "entity_type": "BANK", **over}


def insurance(n, acc, owner, kind="PREMIUM_PAYMENT", **over):
    return {"operation_id": uid(n), "timestamp": T0, "customer_id": owner, "account_id": acc,
            "country_code": "CI", "operation_type": kind, "product_line": "IARD_AUTO",
            "amount": Decimal("65595700.00"), "currency": "XOF", "claim_status": None,
            "processing_days": None, "entity_type": "INSURANCE", **over}


def mobile(n, sender, receiver, **over):
    return {"payment_id": uid(n), "timestamp": T0, "sender_id": sender, "receiver_id": receiver,
            "sender_country": "CI", "receiver_country": "SN", "amount": Decimal("65595.70"),
            "currency": "XOF", "payment_type": "CROSS_BORDER_TRANSFER", "operator": "OP_A",
            "status": "SUCCESS", "fee_amount": Decimal("100.00"), "entity_type": "MOBILE_MONEY",
            **over}


def loan(n, acc, owner, **over):
    return {"repayment_id": uid(n), "timestamp": T0, "loan_account_id": acc, "customer_id": owner,
            "country_code": "CI", "amount_due": Decimal("50000.00"),
            "amount_paid": Decimal("50000.00"), "currency": "XOF", "due_date": date(2026, 5, 1),
            "payment_date": date(2026, 5, 4), "days_overdue": 3, "loan_type": "SME",
            "repayment_status": "ON_TIME", "entity_type": "BANK", **over}


def frame(spark, name, rows, lineage=True):
    contract = CONTRACTS[name]
    schema = contract.schema
    if lineage:
        from pyspark.sql.types import StructType
        schema = StructType(schema.fields + StructType.fromDDL(
            "_source_file STRING, _batch_id STRING, _ingested_at TIMESTAMP").fields)
    names = schema.fieldNames()
    full = [{**(LINEAGE if lineage else {}), **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schema)


def cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, datetime):
        return v.strftime("%Y-%m-%dT%H:%M:%SZ")
    return str(v)


def write_file(path: Path, name: str, rows: list[dict], header: list[str] | None = None):
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = CONTRACTS[name].columns
    return _write(path, header or columns, columns, rows)


def _write(path, header, columns, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow([cell(r.get(c)) for c in columns])
    return path
