"""Gold brought up to date after late, corrected and released rows, held against a full build."""
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.contracts import CONTRACTS
from ledgerloom.operators.tables import Warehouse
from ledgerloom.plans import gold, incremental, ingest, jobs, silver
from samples import T0, account, bank, branch, customer, insurance, loan, mobile, product, write_file

NOW = "2026-06-01 00:00:00"
C1, C2 = "ACME-CI-C-000001", "ACME-SN-C-000002"
ACC, LOAN, POL, GONE = (f"ACME-CI-A-{n:07d}" for n in (1, 2, 3, 7777777))
MAY18 = T0 + timedelta(days=14)


def load(spark, warehouse, root, part, files, names=tuple(silver.TABLES)):
    for name, rows in files.items():
        place = "referentials" if CONTRACTS[name].kind != "event" else "CI"
        write_file(root / f"{place}/{name}/{part}.csv", name, rows)
        ingest.ingest(spark, warehouse, str(root), CONTRACTS[name], now=f"2026-06-0{part} 00:00:00")
    jobs.run_silver(warehouse, "s3cret", names=names, as_of=f"2026-06-0{part + 1} 00:00:00")


def rows_of(frame):
    kept = [c for c in sorted(frame.columns) if c != "_gold_computed_at"]
    return sorted(map(str, frame.select(*kept).collect()))


def check(warehouse):
    frames = {n: warehouse.table("silver", n, silver.PARTITIONS[n]).read() for n in silver.PARTITIONS}
    for name in incremental.TABLES:
        stored = warehouse.table("gold", name, ("country_code",)).read()
        assert rows_of(stored) == rows_of(gold.build(name, frames, NOW)), name


def test_gold_follows_silver(spark, tmp_path):
    root, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "lake"))
    wire = dict(transaction_type="INTERNATIONAL_WIRE", beneficiary_account="ACME-SN-A-0000004")
    load(spark, warehouse, root, 1, {
        "customers": [customer(1), customer(2, "SN")], "branches": [branch()], "products": [product()],
        "accounts": [account(1, C1), account(2, C1, "LOAN", balance=Decimal("-500000.00")),
                     account(3, C1, "INSURANCE_POLICY", entity_type="INSURANCE"),
                     account(4, C2, cc="SN", account_id="ACME-SN-A-0000004")],
        "bank_transactions": [bank(1, ACC), bank(2, ACC, **wire), bank(3, ACC, timestamp=MAY18, **wire),
                              bank(4, GONE)],
        "insurance_operations": [insurance(5, POL, C1)], "loan_repayments": [loan(7, LOAN, C1)],
        "mobile_money_payments": [mobile(6, C1, C2), mobile(8, C1, C2, timestamp=MAY18)]})
    first = incremental.run_gold(warehouse, as_of=NOW)
    assert set(first.values()) == {-1}
    check(warehouse)

    # The same silver again: nothing to do, but for the indicator that is of a date.
    jobs.run_silver(warehouse, "s3cret", as_of="2026-06-09 00:00:00")
    assert {n for n, v in incremental.run_gold(warehouse, as_of=NOW).items() if v} == {"npl_ratio_by_country"}

    # A late payment of April in the week before, one of a week in between, and an account that
    # releases a row from quarantine.
    april = datetime(2026, 4, 28, 9)
    load(spark, warehouse, root, 3, {
        "accounts": [account(7777777, C1, account_id=GONE)],
        "bank_transactions": [bank(11, ACC, timestamp=april, **wire)],
        "mobile_money_payments": [mobile(12, C1, C2, timestamp=T0 + timedelta(days=7))]})
    after = incremental.run_gold(warehouse, as_of=NOW)
    # 28 April, 4 May (released) and 11 May; customers did not change.
    assert after["daily_transaction_volume"] == 3 and after["mobile_money_daily_flow"] == 1
    assert after["loss_ratio_by_product"] == 0 and after["customer_arpu_monthly"] == 2
    assert after["cross_border_transfers"] == 3
    check(warehouse)

    # A customer of another segment; and rows that vanish from silver take their groups with them.
    load(spark, warehouse, root, 5, {"customers": [customer(1, segment="SME")]})
    table = warehouse.table("silver", "mobile_money_payments", silver.PARTITIONS["mobile_money_payments"])
    kept = spark.createDataFrame(table.read().filter(
        F.to_date("timestamp") != F.lit("2026-05-11").cast("date")).collect(), table.read().schema)
    table.replace_scope(kept, F.lit(True))
    after = incremental.run_gold(warehouse, as_of=NOW)
    assert after["customer_arpu_monthly"] == -1 and after["mobile_money_daily_flow"] >= 1
    check(warehouse)


def test_a_run_cut_short_is_repeated(spark, tmp_path, monkeypatch):
    """The digests are written last, so changes that reached no table are found again."""
    root, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "lake"))
    built = ("customers", "mobile_money_payments")
    load(spark, warehouse, root, 1, {"customers": [customer(1), customer(2, "SN")],
                                     "mobile_money_payments": [mobile(6, C1, C2)]}, built)
    names = ["mobile_money_daily_flow"]
    incremental.run_gold(warehouse, names, as_of=NOW)
    load(spark, warehouse, root, 3, {"mobile_money_payments": [mobile(9, C1, C2, timestamp=MAY18)]}, built)
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "recomputed", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run_gold(warehouse, names, as_of=NOW)
    assert incremental.run_gold(warehouse, names, as_of=NOW) == {names[0]: 1}
    assert warehouse.table("gold", names[0]).read().count() == 2


def test_digests_tell_contents_apart(spark):
    kind = "country_code STRING, timestamp TIMESTAMP, a INT, b INT, _silver_processed_at TIMESTAMP"
    rows = [("CI", T0, 1, 2, T0), ("CI", T0, 3, 4, T0), ("SN", T0, 1, 1, T0), ("GH", T0, 1, 1, T0)]
    changed = [("CI", T0, 3, 4, MAY18), ("CI", T0, 1, 2, MAY18),        # order and stamps: the same
               ("SN", T0, 1, 1, T0), ("SN", T0, 1, 1, T0), ("SN", T0, 1, 1, T0)]   # thrice; GH is gone
    one, two = (incremental.digests(spark.createDataFrame(r, kind), "x") for r in (rows, changed))
    assert sorted(r.country_code for r in incremental.touched(one, two).collect()) == ["GH", "SN"]
    swapped = spark.createDataFrame([("CI", T0, 1, 4, T0), ("CI", T0, 3, 2, T0)], kind)
    assert "CI" in [r.country_code for r in incremental.touched(
        one, incremental.digests(swapped, "x")).collect()]
