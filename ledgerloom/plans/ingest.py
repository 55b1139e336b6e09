"""Batch ingestion of one dataset: inventory, skip list, one scan, checks, merge, audit."""
from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.contracts import Contract
from ledgerloom.functions.columns import moment
from ledgerloom.functions.validation import check_batch
from ledgerloom.operators.tables import Table, Warehouse, create_table_sql
from ledgerloom.rules import COUNTRIES
from ledgerloom.sources import landing

AUDIT_TABLES = {
    "rejected_records": (
        "batch_id STRING, dataset STRING, source_file STRING, record_key STRING, "
        "reject_reason STRING, raw_record STRING, rejected_at TIMESTAMP", ("dataset", "batch_id")),
    "ingestion_log": (
        "batch_id STRING, dataset STRING, source_file STRING, file_key STRING, "
        "file_etag STRING, rows_read BIGINT, rows_valid BIGINT, rows_rejected BIGINT, "
        "status STRING, message STRING, processed_at TIMESTAMP, target_table STRING",
        ("dataset", "batch_id")),
    "silver_quarantine": (
        "dataset STRING, record_key STRING, country_code STRING, reason STRING, "
        "detected_at TIMESTAMP", ("dataset", "country_code")),
}


def table_for(warehouse: Warehouse, layer: str, contract: Contract) -> Table:
    """First level: country and business day. Bronze: country and ingestion day; there the key of an
    event may be in any partition, so its files are indexed on it."""
    day = "ingest_day" if layer == "bronze" else contract.day_column
    indexed = contract.key if layer == "bronze" and contract.kind == "event" else None
    return warehouse.table(layer, contract.name, ("country_code", day) if day
                           else ("country_code",), indexed)


def with_partitions(df: DataFrame, table: Table) -> DataFrame:
    days = {"ingest_day": "_ingested_at", "event_day": "timestamp"}
    return df.withColumns({p: F.to_date(days[p]) for p in table.partitions if p in days})


def table_ddl(warehouse: Warehouse, layer: str, contract: Contract) -> str:
    from pyspark.sql.types import DateType
    table = table_for(warehouse, layer, contract)
    schema = contract.table_schema
    for p in table.partitions:
        if p not in schema.fieldNames():
            schema = schema.add(p, DateType())
    return create_table_sql(f"{layer}.{contract.name}", schema, table.partitions, table.path,
                            f"{contract.kind} data, key {contract.key}")


def journal_rows(files: DataFrame, stats: DataFrame | None, contract: Contract, batch_id: str,
                 target: str, status: str, message: str = "", now=None) -> DataFrame:
    """One row per file. Statistics join to the inventory on the key below the root: readers
    spell the scheme of a path differently."""
    out = files.select(F.col("path").alias("source_file"), "file_key", "file_etag")
    if stats is not None:
        if "file_key" not in stats.columns:
            below_root = f"((?:[A-Z]{{2}}|referentials)/{contract.name}/.*)$"
            stats = stats.withColumn("file_key", F.regexp_extract("_source_file", below_root, 1))
        out = out.join(stats.drop("_source_file"), "file_key", "left")
    for c in ("rows_read", "rows_valid", "rows_rejected"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint")
                             if stats is not None else F.lit(0).cast("bigint"))
    return out.select(F.lit(batch_id).alias("batch_id"), F.lit(contract.name).alias("dataset"),
                      "source_file", "file_key", "file_etag", "rows_read", "rows_valid",
                      "rows_rejected", F.lit(status).alias("status"),
                      F.lit(message).alias("message"), moment(now).alias("processed_at"),
                      F.lit(target).alias("target_table"))


@dataclass
class Summary:
    dataset: str
    batch_id: str = ""
    files_found: int = 0
    files_skipped: int = 0
    files_bad_header: int = 0
    files_ingested: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    rows_inserted: int = 0


@dataclass(frozen=True)
class Landed:
    """Files of a dataset that wait, and their lines, read once. Only counts, a hash and a time of
    them reach the driver."""
    files: DataFrame
    lines: DataFrame

    @property
    def accepted(self) -> DataFrame:
        """Keys of the files that have the contract's header."""
        return self.lines.filter("_header").select("file_key").distinct()

    def rows(self, contract: Contract) -> DataFrame:
        own = self.lines.join(self.files.select("file_key"), "file_key", "left_semi")
        return landing.parse_lines(own, contract).join(self.accepted, "file_key", "left_semi")


def _merge(valid: DataFrame, table: Table, contract: Contract) -> int:
    """Events are inserted once. Their key never changes its day on the first level, so only the
    days of the batch are searched there. Of a referential the changed rows are rewritten."""
    placed = with_partitions(valid, table)
    if contract.kind == "event":
        return table.insert_new(placed, contract.key,
                                same_partition="event_day" in table.partitions)
    table.upsert(placed, contract.key, compare=[c for c in contract.columns if c != contract.key])
    return 0


#: Below the archive: files that no contract's header stands in.
REFUSED_PREFIX = "_rejected_files"


def archive(spark: SparkSession, warehouse: Warehouse, root: str, contract: Contract,
            archive_root: str, layer: str = "bronze", countries=COUNTRIES) -> int:
    """Moves the files that the journal has a row for out of the landing folder; how many moved.

    Ingested files keep their key below `archive_root`, from where they can be replayed; those with
    another header go below REFUSED_PREFIX. The journal is what decides, so a move that was cut short,
    or never began because the run ended after the journal, is made up for by the next call. A file
    that came again under the name of an archived one keeps both: its tag is added to the name.
    File by file, by the driver: a rename is one call to the store, and no content passes."""
    journal = warehouse.table("audit", "ingestion_log", AUDIT_TABLES["ingestion_log"][1]).read_or_none()
    if journal is None:
        return 0
    done = (journal.filter((F.col("dataset") == contract.name)
                           & (F.col("target_table") == f"{layer}.{contract.name}"))
            .groupBy("file_key", "file_etag").agg(F.max(F.col("status") == "SUCCESS").alias("taken")))
    waiting = landing.inventory(spark, root, contract, countries).join(done, ["file_key", "file_etag"])
    moved, path_of = 0, spark._jvm.org.apache.hadoop.fs.Path
    for r in waiting.select("path", "file_key", "file_etag", "taken").toLocalIterator():
        base = archive_root if r["taken"] else f"{archive_root}/{REFUSED_PREFIX}"
        source, target = path_of(r["path"]), path_of(f"{base}/{r['file_key']}")
        files = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(target):
            stem = r["file_key"].removesuffix(".csv")
            target = path_of(f"{base}/{stem}~{r['file_etag']}.csv")
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"cannot move {r['path']} to {target}")
        moved += 1
    return moved


def ingest(spark: SparkSession, warehouse: Warehouse, root: str, contract: Contract,
           layer: str = "bronze", countries=COUNTRIES, force: bool = False, now=None,
           archive_to: str | None = None) -> Summary:
    """Ingests the new files below `root` (a landing or an archive folder; for a replay pass
    `force=True`). With `archive_to` files are moved there when the journal has them (`archive`).

    The table is written first, then the rejects, then the journal, so that after a crash the files
    are read again; the merge adds nothing twice, and rejects and journal replace what the same
    files left, as the batch is named by a hash of them."""
    target, summary = f"{layer}.{contract.name}", Summary(contract.name)
    found = landing.inventory(spark, root, contract, countries)
    journal = warehouse.table("audit", "ingestion_log", AUDIT_TABLES["ingestion_log"][1])
    done = None if force else journal.read_or_none()
    waiting = found if done is None else landing.not_ingested(found, done, contract.name, target)
    seen = waiting.agg(F.count("*").alias("n"), F.min("modificationTime").alias("oldest"),
                       F.bit_xor(F.xxhash64("file_key", "file_etag")).alias("mark")).first()
    summary.files_found = found.count()
    summary.files_skipped = summary.files_found - seen["n"]
    if not seen["n"]:
        if archive_to:                  # files of a run that ended before its moves
            archive(spark, warehouse, root, contract, archive_to, layer, countries)
        return summary
    summary.batch_id = f"{target}-{seen['mark'] & (1 << 64) - 1:016x}"
    lines = landing.landed_lines(spark, root, contract, countries, seen["oldest"])
    landed = Landed(waiting, lines.persist(StorageLevel.DISK_ONLY))
    checked = check_batch(landed.rows(contract), contract, summary.batch_id, now)
    batch = replace(checked, rows=checked.rows.persist(StorageLevel.DISK_ONLY))
    try:
        table = table_for(warehouse, layer, contract)
        summary.rows_inserted = _merge(batch.valid.drop("file_key"), table, contract)
        _audit(warehouse, "rejected_records", batch.rejected)
        counts = batch.rows.groupBy("file_key").agg(
            F.count("*").alias("rows_read"),
            F.count_if(F.col("reject_reason") == "").alias("rows_valid"),
            F.count_if(F.col("reject_reason") != "").alias("rows_rejected"))
        refused = waiting.join(landed.accepted, "file_key", "left_anti")
        taken = waiting.join(landed.accepted, "file_key", "left_semi")
        rows = journal_rows(taken, counts, contract, summary.batch_id, target, "SUCCESS", "", now)
        rows = rows.unionByName(journal_rows(refused, None, contract, summary.batch_id, target,
                                             "REJECTED_FILE", "header mismatch", now)).persist()
        # Counted before the journal is written: a write drops what is cached from its path.
        total = rows.agg(F.count_if(F.col("status") == "SUCCESS").alias("files"),
                         F.count("*").alias("all"), F.sum("rows_read").alias("read"),
                         F.sum("rows_valid").alias("valid"),
                         F.sum("rows_rejected").alias("rejected")).first()
        _audit(warehouse, "ingestion_log", rows)
        summary.files_ingested = total["files"]
        summary.files_bad_header = total["all"] - total["files"]
        summary.rows = {k: int(total[k] or 0) for k in ("read", "valid", "rejected")}
        rows.unpersist()
    finally:
        batch.rows.unpersist()
        landed.lines.unpersist()
    if archive_to:
        archive(spark, warehouse, root, contract, archive_to, layer, countries)
    return summary


def _audit(warehouse: Warehouse, name: str, rows: DataFrame) -> None:
    warehouse.table("audit", name, AUDIT_TABLES[name][1]).overwrite_partitions(rows)
