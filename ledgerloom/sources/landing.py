"""Landing folders of CSV files: inventory, skip list, lines with their header mark, typed rows."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.contracts import CORRUPT, Contract
from ledgerloom.rules import COUNTRIES

INVENTORY_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
LINES_DDL = "value STRING, _source_file STRING, file_key STRING, _header BOOLEAN"
BOM = "﻿"


def inventory(spark: SparkSession, root: str, contract: Contract, countries=COUNTRIES,
              modified_after: str | None = None) -> DataFrame:
    """Non-empty CSV files of a dataset: path, key below the root, prefix, size tag and time.

    Only file metadata is selected, so no content is read."""
    reader = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", "true"))
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    found = None
    for prefix in contract.landing_prefixes(countries):
        try:
            part = reader.load(f"{root}/{prefix}")
        except AnalysisException:      # no such folder yet
            continue
        part = part.withColumns({"prefix": F.lit(prefix),
                                 "file_key": F.regexp_extract("path", f"({prefix}/.*)$", 1)})
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], INVENTORY_DDL).withColumns(
            {"prefix": F.lit(""), "file_key": F.lit("")})
    tag = F.concat_ws("-", "length", F.unix_micros("modificationTime"))
    return found.filter("length > 0").withColumn("file_etag", tag)


def pending_by_prefix(files: DataFrame) -> DataFrame:
    return files.groupBy("prefix").agg(F.count("*").alias("pending"),
                                       F.sum("length").alias("bytes"))


def not_ingested(files: DataFrame, journal: DataFrame, dataset: str, target: str) -> DataFrame:
    """Files without a successful journal row for this target with the same key and tag. A
    journal row without a target belongs to the first-level table `raw.<dataset>`."""
    done = (journal.filter((F.col("dataset") == dataset) & (F.col("status") == "SUCCESS"))
            .filter(F.coalesce("target_table", F.lit(f"raw.{dataset}")) == target)
            .select("file_key", "file_etag").distinct())
    return files.join(done, ["file_key", "file_etag"], "left_anti")


def landed_lines(spark: SparkSession, root: str, contract: Contract, countries=COUNTRIES,
                 since=None) -> DataFrame:
    """Lines of the dataset's files with the file, its key below the root, and whether the line is
    the contract's header: in the first block of its file, with the names in order. One text scan,
    which splits large files; files modified before `since` are not opened."""
    found = None
    for prefix in contract.landing_prefixes(countries):
        try:
            part = (spark.read.option("recursiveFileLookup", "true")
                    .option("pathGlobFilter", "*.csv").text(f"{root}/{prefix}"))
        except AnalysisException:      # no such folder yet
            continue
        part = part.withColumns({
            "_source_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
            "_modified": F.col("_metadata.file_modification_time"),
            "file_key": F.regexp_extract("_metadata.file_path", f"({prefix}/.*)$", 1)})
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], LINES_DDL)
    if since is not None:
        found = found.filter(F.col("_modified") >= F.lit(since))
    names = F.transform(F.split(F.regexp_replace("value", f"[{BOM}\"\r]", ""), ","), F.trim)
    expected = F.array(*[F.lit(c) for c in contract.columns])
    return (found.withColumn("_header", (F.col("_block") == 0) & (names == expected))
            .select("value", "_source_file", "file_key", "_header"))


def parse_lines(lines: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows of data lines; a line that does not parse keeps its text in the corrupt column.
    `_row_id` numbers the lines at the scan, where a recomputed task reads them in the same order."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "dateFormat": "yyyy-MM-dd",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX"}
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.read_schema.fields)
    return (lines.withColumn("_row_id", F.monotonically_increasing_id())
            .filter("NOT _header AND trim(value) <> ''")
            .withColumn("_row", F.from_csv(F.regexp_replace("value", "\r$", ""), kinds, options))
            .select("_row.*", "_source_file", "file_key", "_row_id"))


def read_csv(spark: SparkSession, contract: Contract, paths: list[str]) -> DataFrame:
    """Typed rows of a few named files, with their headers taken as given."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.lit("").alias("file_key"),
        (F.col("_metadata.file_block_start") == 0).alias("_block"))
    header = F.regexp_replace(F.split("value", ",")[0], f"[{BOM}\" ]", "") == contract.key
    return parse_lines(lines.withColumn("_header", F.col("_block") & header),
                       contract).drop("file_key")
