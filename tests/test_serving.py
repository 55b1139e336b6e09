import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import serving
from ledgerloom.plans.serving import AccessDenied, Reader, secure_view


@pytest.fixture
def ops(spark):
    return spark.createDataFrame(
        [("k", "c", "CI", True, 5), ("k", "c", "SN", False, 6), ("k", "c", "CI", None, 7)],
        "account_key STRING, customer_key STRING, country_code STRING, is_claim BOOLEAN, amount INT"
    ).withColumn("amount_eur", F.col("amount"))


def test_roles(ops):
    table = ("silver", "insurance_operations")
    assert secure_view(ops, *table, Reader.of("group_admin")).count() == 3
    mine = secure_view(ops, *table, Reader.of("country_analyst", "country_SN"))
    assert [r["country_code"] for r in mine.collect()] == ["SN"]
    assert secure_view(ops, "silver", "fx_rates", Reader.of("country_SN")).count() == 3
    seen = secure_view(ops, *table, Reader.of("viewer")).collect()
    assert {(r["account_key"], r["customer_key"]) for r in seen} == {("***", "***")}
    assert [r["amount"] for r in seen] == [None, 6, 7]
    assert secure_view(ops, "gold", "aml_events", Reader.of("compliance_officer")).count() == 3


@pytest.mark.parametrize("layer, table, roles", [
    ("silver", "accounts", ["compliance_officer"]), ("gold", "fraud_alerts", ["viewer"]),
    ("silver", "customers", ["viewer"]), ("bronze", "customers", ["country_CI"]),
    ("audit", "ingestion_log", ["viewer"]), ("gold", "daily_transaction_volume", []),
    ("gold", "daily_transaction_volume", ["country_analyst"])])
def test_everything_else_is_denied(ops, layer, table, roles):
    with pytest.raises(AccessDenied):
        secure_view(ops, layer, table, Reader.of(*roles))


def test_registered_views(spark, ops):
    names = serving.register_views({("silver", "insurance_operations"): ops,
                                    ("bronze", "customers"): ops}, Reader.of("country_CI"))
    assert names == ["silver_insurance_operations"]
    assert spark.sql("SELECT count(*) AS n FROM silver_insurance_operations").first()["n"] == 2
