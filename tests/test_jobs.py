"""Batch path end to end: CSV files to bronze, silver, gold, reports; replay changes nothing."""
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.contracts import CONTRACTS
from ledgerloom.operators import quality
from ledgerloom.operators.tables import Warehouse
from ledgerloom.plans import ingest, jobs, regulatory
from samples import account, bank, branch, customer, insurance, loan, mobile, product, write_file

NOW = "2026-06-01 00:00:00"
C1, ACC, LOAN, POL = ("ACME-CI-C-000001", "ACME-CI-A-0000001", "ACME-CI-A-0000002",
                      "ACME-CI-A-0000003")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    files = {
        "referentials/customers/1.csv": ("customers", [customer(1), customer(2, "SN")]),
        "referentials/accounts/1.csv": ("accounts", [
            account(1, C1), account(2, C1, "LOAN", balance=Decimal("-500000.00")),
            account(3, C1, "INSURANCE_POLICY", entity_type="INSURANCE")]),
        "referentials/branches/1.csv": ("branches", [branch()]),
        "referentials/products/1.csv": ("products", [product()]),
        "CI/bank_transactions/1.csv": ("bank_transactions", [
            bank(1, ACC), bank(2, ACC), bank(2, ACC), bank(3, ACC, currency="GHS"),
            bank(4, "ACME-CI-A-7777777")]),
        "CI/insurance_operations/1.csv": ("insurance_operations", [insurance(5, POL, C1)]),
        "CI/mobile_money_payments/1.csv": ("mobile_money_payments", [
            mobile(6, C1, "ACME-SN-C-000002")]),
        "CI/loan_repayments/1.csv": ("loan_repayments", [loan(7, LOAN, C1)])}
    for path, (name, rows) in files.items():
        write_file(root / path, name, rows)
    write_file(root / "SN/bank_transactions/wrong.csv", "bank_transactions", [bank(9, ACC)],
               header=["nope"] * 13)
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("lake")))
    summaries = {n: ingest.ingest(spark, warehouse, str(root), c, now=NOW)
                 for n, c in CONTRACTS.items()}
    return root, warehouse, summaries


def counts(warehouse):
    frame = quality.row_counts({n: warehouse.table("bronze", n).read() for n in CONTRACTS})
    return {r["table_name"]: r["row_count"] for r in frame.collect()}


def test_ingestion(lake):
    _, warehouse, summaries = lake
    s = summaries["bank_transactions"]
    assert (s.files_found, s.files_bad_header, s.files_ingested) == (2, 1, 1)
    assert s.rows == {"read": 5, "valid": 3, "rejected": 2} and s.rows_inserted == 3
    rejects = {r["reject_reason"] for r in warehouse.table("audit", "rejected_records")
               .read().collect()}
    assert rejects == {"DUPLICATE_IN_BATCH", "CURRENCY_COUNTRY_MISMATCH"}
    log = warehouse.table("audit", "ingestion_log").read()
    assert log.count() == 9
    bad = log.filter("status = 'REJECTED_FILE'").first()
    assert bad["file_key"] == "SN/bank_transactions/wrong.csv" and bad["rows_read"] == 0
    good = log.filter("dataset = 'bank_transactions' AND status = 'SUCCESS'").first()
    assert (good["rows_read"], good["rows_valid"], good["rows_rejected"]) == (5, 3, 2)


def test_rerun_skips_and_forced_replay_adds_nothing(spark, lake):
    root, warehouse, _ = lake
    before = counts(warehouse)
    for name, contract in CONTRACTS.items():
        again = ingest.ingest(spark, warehouse, str(root), contract, now=NOW)
        assert again.files_ingested == 0
        forced = ingest.ingest(spark, warehouse, str(root), contract, force=True, now=NOW)
        assert forced.files_ingested == 1 and forced.rows_inserted == 0
    assert counts(warehouse) == before


def test_changed_referential_replaces_its_row(spark, lake):
    root, warehouse, _ = lake
    write_file(root / "referentials/customers/2.csv", "customers", [customer(1, segment="SME")])
    ingest.ingest(spark, warehouse, str(root), CONTRACTS["customers"], now="2026-06-02 00:00:00")
    rows = {r["customer_id"]: r["segment"] for r in warehouse.table("bronze", "customers")
            .read().collect()}
    assert rows == {C1: "SME", "ACME-SN-C-000002": "RETAIL"}


def test_first_level_layout(spark, lake, tmp_path):
    root, _, _ = lake
    other = Warehouse(spark, str(tmp_path))
    ingest.ingest(spark, other, str(root), CONTRACTS["bank_transactions"], layer="raw", now=NOW)
    assert other.table("raw", "bank_transactions").read().filter(
        "event_day = DATE'2026-05-04'").count() == 3


def test_table_ddl(spark, lake):
    _, warehouse, _ = lake
    ddl = ingest.table_ddl(warehouse, "bronze", CONTRACTS["mobile_money_payments"])
    assert "ingest_day DATE" in ddl and "PARTITIONED BY (country_code, ingest_day)" in ddl


def test_silver_gold_and_reports(spark, lake, tmp_path):
    _, warehouse, _ = lake
    written = jobs.run_silver(warehouse, "s3cret", as_of=NOW)
    assert written["bank_transactions"] == 2 and written["silver_quarantine"] == 1
    again = jobs.run_silver(warehouse, "s3cret", as_of=NOW)
    assert again == written
    assert warehouse.table("audit", "silver_quarantine").read().count() == 1
    gold = jobs.run_gold(warehouse, as_of="2026-06-01")
    assert gold["daily_transaction_volume"] == 2 and gold["loss_ratio_by_product"] == 1
    assert jobs.run_gold(warehouse, ["CI"], as_of="2026-06-01") == gold

    export = str(tmp_path / "out")
    reports = jobs.run_regulatory(warehouse, export, "2026-05-04")
    assert reports == {"bceao": 1, "cima": 1}
    jobs.run_regulatory(warehouse, export, "2026-05-05")
    table = warehouse.table("gold", "regulatory_bceao_daily").read()
    assert table.select("report_date").distinct().count() == 2
    files = jobs.export_inventory(warehouse, export)
    assert files.filter(F.col("path").contains("bceao/report_date=2026-05-04")).count() == 1
    missing = regulatory.missing_exports(files, ["CI", "SN"], "2026-05-04").collect()
    assert [(r["regulator"], r["country_code"]) for r in missing] == [("bceao", "SN")]
    text = spark.read.option("header", "true").csv(export + "/bceao")
    assert text.filter("report_date = '2026-05-04'").first()["nb_bank_transactions"] == "2"


def test_reports_read_their_months_only(lake):
    frames = jobs.report_inputs(lake[1], "2026-05-04")
    for name in ("bank_transactions", "insurance_operations", "loan_repayments"):
        plan = frames[name]._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: ["):]
        assert "event_month" in filters[:filters.index("]")]


def test_a_quarantined_row_that_is_fixed_leaves_the_quarantine(spark, lake):
    root, warehouse, _ = lake
    write_file(root / "referentials/accounts/9.csv", "accounts",
               [account(7777777, C1, account_id="ACME-CI-A-7777777")])
    ingest.ingest(spark, warehouse, str(root), CONTRACTS["accounts"], now=NOW)
    written = jobs.run_silver(warehouse, "s3cret", ["CI"], as_of=NOW)
    assert written["bank_transactions"] == 3
    assert warehouse.table("audit", "silver_quarantine").read().count() == 0


def test_unknown_country(lake):
    with pytest.raises(ValueError, match="unknown countries"):
        jobs.run_silver(lake[1], "s", ["FR"])


def test_nothing_to_report(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        jobs.run_regulatory(warehouse, str(tmp_path / "o"), datetime(2026, 5, 4).date())


# ---- archive

def names_below(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.csv"))


def test_files_are_archived_after_the_journal(spark, tmp_path, monkeypatch):
    """A crash between journal and move: nothing is lost, nothing comes twice, the next run moves."""
    root, kept = tmp_path / "landing", tmp_path / "archive"
    contract, name = CONTRACTS["bank_transactions"], "bank_transactions"
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    write_file(root / f"CI/{name}/1.csv", name, [bank(1, ACC)])
    write_file(root / f"SN/{name}/wrong.csv", name, [bank(9, ACC)], header=["nope"] * 13)

    def run(**more):
        return ingest.ingest(spark, warehouse, str(root), contract, now=NOW, archive_to=str(kept), **more)
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "archive", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert len(names_below(root)) == 2 and not kept.exists()
    assert warehouse.table("audit", "ingestion_log").read().count() == 2
    assert run().files_ingested == 0
    assert names_below(root) == []
    assert names_below(kept) == [f"CI/{name}/1.csv", f"_rejected_files/SN/{name}/wrong.csv"]

    # The same name again, with other rows: both stay, and a replay of the archive adds nothing.
    write_file(root / f"CI/{name}/1.csv", name, [bank(1, ACC), bank(2, ACC)])
    assert run().rows_inserted == 1
    assert names_below(root) == [] and len(names_below(kept)) == 3
    again = ingest.ingest(spark, warehouse, str(kept), contract, now=NOW, force=True)
    assert again.files_ingested == 2 and again.rows_inserted == 0
