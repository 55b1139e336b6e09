from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.contracts import CONTRACTS, CORRUPT, for_deployment
from ledgerloom.functions.validation import check_batch, file_stats
from ledgerloom.sources import landing
from samples import T0, bank, customer, mobile, uid, write_file

ACC = "ACME-CI-A-0000001"


def checked(spark, tmp_path, name, rows, contract=None, path="CI/x.csv"):
    contract = contract or CONTRACTS[name]
    file = write_file(tmp_path / path, name, rows)
    df = landing.read_csv(spark, contract, [str(file)])
    return df, check_batch(df.persist(), contract, "b1", T0)


@pytest.mark.parametrize("override, reason", [
    ({"country_code": "FR"}, "INVALID_COUNTRY"),
    ({"entity_type": "SHOP"}, "INVALID_ENTITY"),
    ({"currency": "USD"}, "INVALID_CURRENCY"),
    ({"currency": "GHS"}, "CURRENCY_COUNTRY_MISMATCH"),
    ({"transaction_type": "GIFT"}, "INVALID_TRANSACTION_TYPE"),
    ({"channel": "FAX"}, "INVALID_CHANNEL"),
    ({"transaction_status": "LOST"}, "INVALID_TRANSACTION_STATUS"),
    ({"amount": Decimal("-1.00")}, "NEGATIVE_AMOUNT"),
    ({"fee_amount": Decimal("-1.00")}, "NEGATIVE_FEE_AMOUNT"),
    ({"transaction_id": "T-1"}, "INVALID_KEY_FORMAT"),
    ({"transaction_id": None}, "MISSING_TRANSACTION_ID"),
    ({"account_id": None}, "MISSING_ACCOUNT_ID"),
    ({"amount": Decimal("-1.00"), "channel": "FAX"}, "INVALID_CHANNEL;NEGATIVE_AMOUNT")])
def test_each_bad_row_has_its_reasons(spark, tmp_path, override, reason):
    _, batch = checked(spark, tmp_path, "bank_transactions", [bank(1, ACC, **override)])
    assert batch.valid.count() == 0
    assert [r["reject_reason"] for r in batch.rejected.collect()] == [reason]


def test_optional_fields_may_be_missing(spark, tmp_path):
    rows = [bank(1, ACC, channel=None, fee_amount=None, beneficiary_account=None)]
    _, batch = checked(spark, tmp_path, "bank_transactions", rows)
    row = batch.valid.first()
    assert row["_batch_id"] == "b1" and row["amount"] == Decimal("655957.00")
    assert CORRUPT not in batch.valid.columns and "_row_id" not in batch.valid.columns


def test_unreadable_rows_keep_their_text(spark, tmp_path):
    file = tmp_path / "CI" / "bad.csv"
    write_file(file, "bank_transactions", [bank(1, ACC)])
    with open(file, "a") as f:
        f.write(f"{uid(2)},2026-13-45T99:61:00Z,{ACC},,B,CI,TRANSFER,10,XOF,ATM,SUCCESS,0,BANK\n")
        f.write(f"{uid(3)},2026-05-04T10:00:00Z,{ACC},,B,CI,TRANSFER,ten,XOF,ATM,SUCCESS,0,BANK\n")
    df = landing.read_csv(spark, CONTRACTS["bank_transactions"], [str(file)]).persist()
    batch = check_batch(df, CONTRACTS["bank_transactions"], "b1", T0)
    assert batch.valid.count() == 1
    bad = {r["raw_record"].split(",")[0]: r["reject_reason"] for r in batch.rejected.collect()}
    assert set(bad) == {uid(2), uid(3)} and all(v.startswith("MALFORMED_ROW") for v in bad.values())


def test_identical_rows_one_valid_two_rejected(spark, tmp_path):
    df, batch = checked(spark, tmp_path, "bank_transactions", [bank(1, ACC)] * 3)
    assert batch.valid.count() == 1
    assert [r["reject_reason"] for r in batch.rejected.collect()] == ["DUPLICATE_IN_BATCH"] * 2
    stats = file_stats(df, batch.rejected).first()
    assert (stats["rows_read"], stats["rows_valid"], stats["rows_rejected"]) == (3, 1, 2)


def test_many_copies_of_one_row(spark):
    """A third of the rows is one row; exactly one survives and all others are reported."""
    contract = CONTRACTS["bank_transactions"]
    one = spark.createDataFrame([tuple(bank(999_999, ACC)[c] for c in contract.columns)], contract.schema)
    copies = (spark.range(5000).crossJoin(one).drop("id")
              .unionByName(spark.range(10_000).select(
                  F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("id").cast("string"), 12, "0"))
                  .alias("transaction_id")).crossJoin(one.drop("transaction_id"))))
    df = copies.withColumns({CORRUPT: F.lit(None).cast("string"), "_source_file": F.lit("f"),
                             "_row_id": F.monotonically_increasing_id()})
    batch = check_batch(df, contract, "b", T0)
    assert batch.valid.count() == 10_001 and batch.rejected.count() == 4_999


def test_newest_file_wins_for_referentials(spark, tmp_path):
    contract = CONTRACTS["customers"]
    old = write_file(tmp_path / "2026-05-01.csv", "customers", [customer(1), customer(2)])
    new = write_file(tmp_path / "2026-05-02.csv", "customers", [customer(1, segment="PREMIUM")])
    df = landing.read_csv(spark, contract, [str(old), str(new)]).persist()
    batch = check_batch(df, contract, "b1", T0)
    assert {r["customer_id"][-1]: r["segment"] for r in batch.valid.collect()} == {
        "1": "PREMIUM", "2": "RETAIL"}


def test_payment_country_comes_from_sender(spark, tmp_path):
    _, batch = checked(spark, tmp_path, "mobile_money_payments", [mobile(1, "a", "b")])
    assert batch.valid.first()["country_code"] == "CI"


def test_operator_list_of_a_deployment(spark, tmp_path):
    contract = for_deployment(CONTRACTS, operators=("OP_B",))["mobile_money_payments"]
    _, batch = checked(spark, tmp_path, "mobile_money_payments", [mobile(1, "a", "b")], contract)
    assert batch.rejected.first()["reject_reason"] == "INVALID_OPERATOR"


def test_issuer_of_a_deployment(spark, tmp_path):
    contract = for_deployment(CONTRACTS, issuer="OTHER")["customers"]
    _, batch = checked(spark, tmp_path, "customers", [customer(1)], contract)
    assert batch.rejected.first()["reject_reason"] == "INVALID_KEY_FORMAT"
    assert for_deployment(CONTRACTS, issuer="ACME")["branches"].key_format.startswith("^ACME-")


def test_swapped_columns_are_refused(spark, tmp_path):
    contract = CONTRACTS["bank_transactions"]
    names = list(contract.columns)
    names[2], names[3] = names[3], names[2]
    write_file(tmp_path / "CI/bank_transactions/swapped.csv", contract.name, [bank(1, ACC)],
               header=names)
    lines = landing.landed_lines(spark, str(tmp_path), contract)
    assert lines.filter("_header").count() == 0


def test_header_of_a_file_in_many_splits(spark, tmp_path):
    contract = CONTRACTS["bank_transactions"]
    write_file(tmp_path / "CI/bank_transactions/big.csv", contract.name,
               [bank(k, ACC) for k in range(3000)])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = landing.landed_lines(spark, str(tmp_path), contract)
        assert lines.rdd.getNumPartitions() > 3
        assert lines.filter("_header").count() == 1
        assert landing.parse_lines(lines, contract).select("_row_id").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_inventory_header_and_skip_list(spark, tmp_path):
    contract = CONTRACTS["bank_transactions"]
    good = write_file(tmp_path / "CI/bank_transactions/good.csv", contract.name, [bank(1, ACC)])
    write_file(tmp_path / "SN/bank_transactions/bad.csv", contract.name, [bank(1, ACC)],
               header=["x", *contract.columns[1:]])
    text = good.read_text()
    quoted = ",".join(f'"{c}"' for c in contract.columns)
    (tmp_path / "CI/bank_transactions/bom.csv").write_text(
        "﻿" + quoted + "\r\n" + text.split("\n", 1)[1], encoding="utf-8")
    (tmp_path / "CI/bank_transactions/empty.csv").write_text("")
    files = landing.inventory(spark, str(tmp_path), contract)
    lines = landing.landed_lines(spark, str(tmp_path), contract)
    ok = {r["file_key"]: r["ok"] for r in lines.groupBy("file_key").agg(
        F.max("_header").alias("ok")).collect()}
    assert ok == {"CI/bank_transactions/good.csv": True, "CI/bank_transactions/bom.csv": True,
                  "SN/bank_transactions/bad.csv": False}
    rows = landing.parse_lines(lines, contract).filter("file_key LIKE 'CI/%'")
    assert [r["transaction_id"] for r in rows.collect()] == [uid(1)] * 2
    assert {r["prefix"]: r["pending"] for r in landing.pending_by_prefix(files).collect()} == {
        "CI/bank_transactions": 2, "SN/bank_transactions": 1}
    journal = files.filter(F.col("file_key").endswith("good.csv")).select(
        F.lit(contract.name).alias("dataset"), F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("target_table"), "file_key", "file_etag")
    left = landing.not_ingested(files, journal, contract.name, "raw.bank_transactions")
    assert left.count() == 2
    assert landing.not_ingested(files, journal, contract.name,
                                "bronze.bank_transactions").count() == 3


def test_nothing_landed(spark, tmp_path):
    assert landing.inventory(spark, str(tmp_path), CONTRACTS["customers"]).count() == 0


def test_modified_after(spark, tmp_path):
    write_file(tmp_path / "CI/bank_transactions/a.csv", "bank_transactions", [bank(1, ACC)])
    later = datetime(2999, 1, 1).strftime("%Y-%m-%dT%H:%M:%S")
    assert landing.inventory(spark, str(tmp_path), CONTRACTS["bank_transactions"],
                             modified_after=later).count() == 0
