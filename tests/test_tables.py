from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality, tables
from ledgerloom.operators.dedup import latest
from ledgerloom.operators.lookup import attach, full_outer_hot
from ledgerloom.operators.tables import Table, Warehouse, create_table_sql, merge_result

DDL = "id STRING, country_code STRING, event_day DATE, v INT"
D1, D2 = date(2026, 5, 1), date(2026, 5, 2)


def rows(spark, *values):
    return spark.createDataFrame(list(values), DDL)


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), ("country_code", "event_day"))


def content(table):
    return {r["id"]: (r["country_code"], r["event_day"], r["v"]) for r in table.read().collect()}


def test_replay_inserts_nothing(spark, table):
    batch = rows(spark, ("a", "CI", D1, 1), ("b", "SN", D1, 2))
    assert table.insert_new(batch, "id") == 2
    assert table.insert_new(batch, "id") == 0
    assert table.insert_new(rows(spark, ("a", "CI", D1, 9), ("c", "CI", D2, 3)), "id",
                            same_partition=True) == 1
    assert content(table) == {"a": ("CI", D1, 1), "b": ("SN", D1, 2), "c": ("CI", D2, 3)}


def test_upsert_updates_inserts_and_moves(spark, table):
    table.upsert(rows(spark, ("a", "CI", D1, 1), ("b", "SN", D1, 2), ("c", "SN", D1, 3)), "id")
    table.upsert(rows(spark, ("a", "CI", D2, 10), ("d", "GH", D1, 4)), "id")
    # The folder that lost its last row is empty, not stale.
    assert content(table) == {"a": ("CI", D2, 10), "b": ("SN", D1, 2), "c": ("SN", D1, 3),
                              "d": ("GH", D1, 4)}
    assert table.read().count() == 4


def test_upsert_only_changed_rows(spark, table):
    table.upsert(rows(spark, ("a", "CI", D1, 1), ("b", "CI", D1, None)), "id")
    table.upsert(rows(spark, ("a", "CI", D2, 1), ("b", "CI", D2, 5)), "id", compare=["v"])
    assert content(table) == {"a": ("CI", D1, 1), "b": ("CI", D2, 5)}


def test_overwrite_touches_only_its_partitions(spark, table):
    assert table.overwrite_partitions(rows(spark, ("a", "CI", D1, 1), ("b", "SN", D1, 2))) == 2
    assert table.overwrite_partitions(rows(spark, ("c", "CI", D1, 3))) == 1
    assert content(table) == {"c": ("CI", D1, 3), "b": ("SN", D1, 2)}


def test_schema_grows_and_vanished_columns_are_null(spark, table):
    table.overwrite_partitions(rows(spark, ("a", "CI", D1, 1)))
    wider = rows(spark, ("b", "SN", D1, 2)).drop("v").withColumn("w", F.lit("new"))
    table.overwrite_partitions(wider)
    got = {r["id"]: (r["v"], r["w"]) for r in table.read().collect()}
    assert got == {"a": (1, None), "b": (None, "new")}


def test_replace_scope_empties_what_is_gone(spark, table):
    scope = F.col("country_code") == "CI"
    table.replace_scope(rows(spark, ("a", "CI", D1, 1), ("b", "CI", D2, 2), ("c", "SN", D1, 3)),
                        F.lit(True))
    table.replace_scope(rows(spark, ("d", "CI", D2, 4)), scope)
    assert content(table) == {"d": ("CI", D2, 4), "c": ("SN", D1, 3)}
    table.replace_scope(rows(spark, ("d", "CI", D2, 4)).limit(0), scope)
    assert content(table) == {"c": ("SN", D1, 3)}


def test_pruned_read(spark, table):
    table.append(rows(spark, ("a", "CI", D1, 1), ("b", "CI", D2, 2), ("c", "SN", D2, 3)))
    df = table.read(countries=["CI"], since="2026-05-02")
    assert [r["id"] for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "country_code" in plan.split("PartitionFilters")[1]


def test_read_latest_and_compact(spark, table):
    table.append(rows(spark, ("a", "CI", D1, 1)))
    table.append(rows(spark, ("a", "CI", D1, 2), ("b", "CI", D1, 1)))
    order = [F.col("v").desc()]
    assert {r["id"]: r["v"] for r in table.read_latest("id", order).collect()} == {"a": 2, "b": 1}
    assert table.compact("id", order) == 2
    assert table.read().count() == 2


def test_missing_table(spark, table):
    assert table.read_or_none() is None
    with pytest.raises(FileNotFoundError):
        table.read()


def test_merge_result_actions(spark):
    now = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "id STRING, v INT")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("d", 4)], "id STRING, v INT")
    got = {r["id"]: (r["v"], r["merge_action"])
           for r in merge_result(new, now, "id", ["v"]).collect()}
    assert got == {"a": (1, "KEEP"), "b": (2, "UPDATE"), "c": (3, "KEEP"), "d": (4, "INSERT")}


def test_ddl_text_runs(spark, tmp_path):
    schema = spark.createDataFrame([], DDL).schema
    sql = create_table_sql("ddl_check", schema, ("country_code",), str(tmp_path / "d"), "it's")
    spark.sql(sql)
    assert spark.table("ddl_check").columns == ["id", "event_day", "v", "country_code"]
    spark.sql("DROP TABLE ddl_check")


def test_attach_spreads_missing_keys(spark):
    facts = spark.range(1000).select(F.col("id").cast("string").alias("f"),
                                     F.when(F.col("id") < 10, "k1").alias("k"))
    dim = spark.createDataFrame([("k1", None)], "k STRING, attr STRING")
    out = attach(facts, dim, "k", "k", "found", spread_nulls_by="f")
    assert out.count() == 1000 and out.filter("found").count() == 10
    assert set(out.columns) == {"f", "k", "attr", "found"}


def test_full_outer_hot_matches_full_outer(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k STRING, x INT")
    right = spark.createDataFrame([("a", 10), ("a", 20), ("c", 30)], "k STRING, y INT")
    got = sorted(map(tuple, full_outer_hot(left, right, ["k"]).select("k", "x", "y").collect()),
                 key=str)
    want = sorted(map(tuple, left.join(right, "k", "full_outer").select("k", "x", "y").collect()),
                  key=str)
    assert got == want


def test_latest_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id < 990, 'hot', 'cold') AS k", "cast(id AS timestamp) AS _ingested_at",
                                      "'f' AS _source_file")
    out = latest(df, "k")
    assert out.count() == 2
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_quality_gate(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k STRING")
    with pytest.raises(ValueError, match="1 duplicate k"):
        quality.assert_unique(df, "k", "t")
    assert quality.forbidden_columns({"t": df.withColumn("account_id", F.lit(1))}) == [
        ("t", "account_id")]


def test_a_crash_between_writing_and_switching_loses_nothing(spark, tmp_path, monkeypatch):
    table = Warehouse(spark, str(tmp_path)).table("t", "x", ("country_code",))
    rows = [(k, "CI" if k % 2 else "SN", "old") for k in range(6)]
    ddl = "id INT, country_code STRING, v STRING"
    table.append(spark.createDataFrame(rows, ddl))
    change = spark.createDataFrame([(1, "SN", "new"), (9, "CI", "new")], ddl)

    def crash(*args, **kwargs):
        # The old folder is gone when the driver dies.
        import shutil
        shutil.rmtree(tmp_path / "t/x/country_code=CI")
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(type(table), "overwrite_partitions", crash)
        with pytest.raises(RuntimeError):
            table.upsert(change, "id")
    table.upsert(change, "id")              # run again
    got = {r["id"]: (r["country_code"], r["v"]) for r in table.read().collect()}
    want = {k: (c, v) for k, c, v in rows} | {1: ("SN", "new"), 9: ("CI", "new")}
    assert got == want


# ---- tables indexed on their key

def rows_read(frame):
    """Rows that came out of the scan: of the row groups that were not skipped."""
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


@pytest.fixture
def indexed(spark, tmp_path):
    """Eight appends of 500 keys that no range separates, a file or more each."""
    table = Table(spark, str(tmp_path / "k"), ("country_code", "event_day"), indexed="id")
    for part in range(8):
        own = spark.range(part, 4000, 8).select(
            F.md5(F.col("id").cast("string")).alias("id"), F.lit("CI").alias("country_code"),
            F.lit(D1).alias("event_day"), F.lit(part).alias("v"))
        assert table.insert_new(own.coalesce(1), "id") == 500
    return table


def test_only_row_groups_that_may_hold_a_key_are_read(spark, indexed):
    of_one_file = indexed.read().filter("v = 3").limit(40).select("id")
    batch = of_one_file.union(spark.createDataFrame([(f"new{k}",) for k in range(40)], "id STRING"))
    found = tables.known(indexed.read(), batch, "id")
    assert rows_read(found) == 500 and found.count() == 40
    none = tables.known(indexed.read(), spark.createDataFrame([(f"{k:032x}",) for k in range(500)],
                                                              "id STRING"), "id")
    assert rows_read(none) == 0
    plain = Table(spark, indexed.path + "-plain", indexed.partitions)
    plain.append(indexed.read())
    assert rows_read(tables.known(plain.read(), batch, "id")) > 500


@pytest.mark.parametrize("most", [tables.LOOKUP_KEYS, 5])
def test_replay_of_an_indexed_table_inserts_nothing(spark, indexed, monkeypatch, most):
    """Whether the keys are few enough for the filters or not."""
    monkeypatch.setattr(tables, "LOOKUP_KEYS", most)
    again = indexed.read().filter("v IN (1, 6)").unionByName(
        spark.createDataFrame([("new1", "CI", D2, 9), ("new2", "SN", D2, 9), (None, "SN", D2, 9)], DDL))
    assert indexed.insert_new(again, "id") == 3
    assert indexed.insert_new(again.filter("id IS NOT NULL"), "id") == 0
    assert indexed.read().count() == 4003
    assert indexed.insert_new(again.limit(0), "id") == 0
