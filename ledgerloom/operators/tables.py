"""Parquet tables under one root: partition-aware reads, idempotent writes and merges.

A table is a folder of parquet files with Hive-style partition folders. Hidden partition
transforms of other formats become derived columns (`event_day`, `event_month`). There is one
writer per table.

A step whose rows come from elsewhere is repaired by running it again. A step that rewrites
partitions from the table's own rows (`upsert`, `compact`) writes the new rows beside the table
first and switches then; a crash between leaves them there, and the next writer finishes the switch
(`recover`).

A table may be `indexed` on its key: its files then carry a Bloom filter on it in each row group, and
the keys of a batch are searched only in row groups whose filter holds one of them (`known`)."""
from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerloom.operators.dedup import first_per

#: Keys of a batch up to this number are searched by the files' Bloom filters; more by a join. A row
#: group without any of so many keys is read by mistake with a chance of LOOKUP_KEYS * BLOOM_ERROR.
LOOKUP_KEYS = 10_000
BLOOM_ERROR, BLOOM_KEYS, BLOOM_BYTES = 1e-6, 1 << 20, 4 << 20      # keys and bytes of a row group


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str
    partitions: tuple[str, ...] = ()
    indexed: str | None = None

    # ------------------------------------------------------------------ reading
    def schema_or_none(self) -> StructType | None:
        """The table's schema, kept beside the data: reading it costs one small file, where
        merging the schemas of all data files would open every footer."""
        try:
            rows = self.spark.read.text(f"{self.path}/_schema").collect()
        except AnalysisException:
            return None
        return StructType.fromJson(json.loads(rows[0]["value"])) if rows else None

    def _remember(self, schema: StructType) -> None:
        loose = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
        if self.schema_or_none() != loose:
            row = self.spark.createDataFrame([(loose.json(),)], "value STRING")
            row.coalesce(1).write.mode("overwrite").text(f"{self.path}/_schema")

    def read_or_none(self) -> DataFrame | None:
        schema = self.schema_or_none()
        if schema is None:
            return None
        # Additive evolution: older files simply lack the newer columns.
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self, countries: Iterable[str] | None = None, since: str | None = None,
             until: str | None = None) -> DataFrame:
        """Filters on the partition columns reach the file listing, so whole folders are
        skipped; `since`/`until` are ISO dates on the day or month partition."""
        df = self.read_or_none()
        if df is None:
            raise FileNotFoundError(f"no table at {self.path}")
        if countries:
            df = df.filter(F.col("country_code").isin(*countries))
        for column in ("event_day", "event_month"):
            if column in self.partitions:
                start = F.lit(since).cast("date") if since else None
                end = F.lit(until).cast("date") if until else None
                if column == "event_month":
                    start = F.trunc(start, "month") if since else None
                if since:
                    df = df.filter(F.col(column) >= start)
                if until:
                    df = df.filter(F.col(column) <= end)
        return df

    def read_latest(self, key: str, order: list[Column], **filters) -> DataFrame:
        """Merge on read: the newest version of each key of an append-only table."""
        return first_per(self.read(**filters), [key], order)

    # ------------------------------------------------------------------ writing
    def _spread(self, df: DataFrame) -> DataFrame:
        """Group rows by target folder before writing. REBALANCE splits a folder that holds
        most of the rows over several tasks and merges the small ones."""
        return df.hint("rebalance", *self.partitions) if self.partitions else df

    def _options(self) -> dict[str, str]:
        """Bloom filters on the key; each takes the size that its row group's keys need."""
        if not self.indexed:
            return {}
        own = {"enabled": "true", "fpp": str(BLOOM_ERROR), "expected.ndv": str(BLOOM_KEYS)}
        return {**{f"parquet.bloom.filter.{k}#{self.indexed}": v for k, v in own.items()},
                "parquet.bloom.filter.adaptive.enabled": "true",
                "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES)}

    def append(self, df: DataFrame) -> None:
        current = self.schema_or_none()
        df = df if current is None else align(df, current)
        (self._spread(df).write.mode("append").options(**self._options())
         .partitionBy(*self.partitions).parquet(self.path))
        self._remember(df.schema)

    def replace(self, df: DataFrame) -> None:
        """The whole (small) table."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*self.partitions).parquet(self.path))
        self._remember(df.schema)

    def overwrite_partitions(self, df: DataFrame, before: set[tuple] | None = None) -> int:
        """Replaces the partitions present in `df`, adds new columns, fills vanished ones with
        NULL, and returns the row count. Partitions of `before` that got no row are emptied.

        The count and the list of written partitions (folder metadata) are observed while
        writing, so `df` is computed once."""
        if not self.partitions:
            raise ValueError(f"{self.path} has no partition columns; use replace()")
        current = self.read_or_none()
        if current is not None:
            df = align(df, current.schema)
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("n"),
                             F.collect_set(F.struct(*self.partitions)).alias("written"))
        (self._spread(watched).write.mode("overwrite").options(**self._options())
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partitions).parquet(self.path))
        self._remember(df.schema)
        metrics = observed(seen)
        if before and current is not None:
            plain = lambda v: tuple(None if x is None else str(x) for x in v)
            written = {plain(r) for r in metrics.get("written", ())}
            self.clear({plain(v) for v in before} - written, current.schema)
        return metrics.get("n", 0)

    def compact(self, key: str, order: list[Column], **filters) -> int:
        """Rewrites the filtered partitions with one row per key in fewer, larger files."""
        self.recover()
        return self._switch(self.read_latest(key, order, **filters), set())

    def rewrite(self, df: DataFrame, before: set[tuple]) -> int:
        """Replaces partitions by rows made from the table's own; those of `before` that get no row
        are emptied."""
        self.recover()
        return self._switch(df, before)

    def _beside(self, name: str) -> str:
        return f"{self.path}/_{name}"       # readers skip names that start like this

    def _switch(self, df: DataFrame, emptied: set[tuple]) -> int:
        """Overwrites partitions with rows that were read from this very table."""
        marks = [(json.dumps([None if v is None else str(v) for v in value]),)
                 for value in sorted(emptied, key=str)]
        (self.spark.createDataFrame(marks, "value STRING").coalesce(1)
         .write.mode("overwrite").text(self._beside("emptied")))
        df.write.mode("overwrite").parquet(self._beside("rows"))
        return self.recover()

    def recover(self) -> int:
        """Finishes a switch whose rows lie beside the table; the number of rows. An unfinished set
        of rows, without the committer's mark, is of no use and is overwritten by the next."""
        files, rows = self._path(self._beside("rows"))
        if not files.exists(self._path(f"{self._beside('rows')}/_SUCCESS")[1]):
            return 0
        marks = self.spark.read.text(self._beside("emptied")).collect()
        emptied = {tuple(json.loads(r["value"])) for r in marks}
        n = self.overwrite_partitions(self.spark.read.parquet(self._beside("rows")), emptied)
        files.delete(rows, True)
        return n

    def _path(self, path: str):
        """A path with its file system."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def clear(self, values: set[tuple], schema: StructType) -> None:
        """Empties whole partitions; a dynamic overwrite leaves the ones it has no row for."""
        keep = StructType([f for f in schema.fields if f.name not in self.partitions])
        for value in values:
            folder = "/".join(f"{p}={v}" for p, v in zip(self.partitions, value))
            (self.spark.createDataFrame([], keep).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").parquet(f"{self.path}/{folder}"))

    # ------------------------------------------------------------------ merging
    def insert_new(self, source: DataFrame, key: str,
                   same_partition: bool = False) -> int:
        """Appends the rows whose key is not in the table: a replay adds nothing.

        Only the key column of the table is read, and of a table that is indexed on the key only the
        row groups that may hold a key of the batch. `same_partition=True` also limits it to the
        source's partitions; use it when a key can never change partition."""
        current = self.read_or_none()
        new = source
        if current is not None:
            present = current
            if same_partition:
                present = present.filter(self._in({tuple(r) for r in self._partition_values(source)}))
            if key == self.indexed:
                present = known(present, source, key)
            new = align(not_in(source, present, key), current.schema)
        seen = Observation()
        self.append(new.observe(seen, F.count(F.lit(1)).alias("n")))
        return observed(seen).get("n", 0)

    def upsert(self, source: DataFrame, key: str, compare: list[str] | None = None) -> None:
        """Insert or update by key, rewriting only the touched partitions.

        A key may move to another partition: the old one is rewritten too. With `compare`,
        a row is updated only if one of these columns differs (NULL-safe)."""
        self.recover()
        current = self.read_or_none()
        if current is None:
            self.overwrite_partitions(source)
            return
        source = align(source, current.schema)
        if compare:
            source = changed_or_new(source, current, key, compare)
        source = source.persist()
        try:
            homes = {tuple(r) for r in self._partition_values(
                current.join(source.select(key), key, "left_semi"))}
            targets = {tuple(r) for r in self._partition_values(source)}
            if not homes | targets:
                return
            old = not_in(current.filter(self._in(homes | targets)), source, key)
            self._switch(old.unionByName(source), homes)
        finally:
            source.unpersist()

    def replace_scope(self, df: DataFrame, scope: Column) -> int:
        """Deletes the rows in `scope` (a condition on partition columns) and writes `df`."""
        current = self.read_or_none()
        before = None
        if current is not None:
            before = {tuple(r) for r in self._partition_values(current.filter(scope))}
        return self.overwrite_partitions(df, before)

    def _partition_values(self, df: DataFrame) -> list:
        return df.select(*self.partitions).distinct().collect()

    def _in(self, values) -> Column:
        """A prunable condition for a list of partition values, grouped by the first column."""
        groups: dict = {}
        for head, *rest in values:
            groups.setdefault(head, []).append(rest)
        condition = F.lit(False)
        for head, tails in groups.items():
            term = F.col(self.partitions[0]).eqNullSafe(F.lit(head))
            if len(self.partitions) == 2:
                term = term & F.col(self.partitions[1]).isin([t[0] for t in tails])
            elif len(self.partitions) > 2:
                inner = F.lit(False)
                for tail in tails:
                    same = F.lit(True)
                    for p, v in zip(self.partitions[1:], tail):
                        same = same & (F.col(p) == F.lit(v))
                    inner = inner | same
                term = term & inner
            condition = condition | term
        return condition


@dataclass(frozen=True)
class Warehouse:
    """Layers of tables below one shared root folder."""
    spark: SparkSession
    root: str

    def table(self, layer: str, name: str, partitions: tuple[str, ...] = (),
              indexed: str | None = None) -> Table:
        return Table(self.spark, f"{self.root}/{layer}/{name}", partitions, indexed)


def observed(seen: Observation) -> dict:
    """Metrics of a finished write. When AQE proves the input empty it drops the metrics node,
    and Spark then reports a row without fields, which Python refuses to convert."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" in str(e.java_exception):
            return {}
        raise


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """`schema`'s columns first (NULL where `df` lacks one), then the columns it adds."""
    kept = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    added = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*kept, *added)


def known(table: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The keys of `source` that `table` holds, for a table whose files have Bloom filters on it.

    Up to LOOKUP_KEYS keys reach the driver and go back as a list that the scan is given: row groups
    whose range or filter excludes all of them are not read. More keys would hit every filter by
    chance, so they are joined."""
    wanted = source.filter(F.col(key).isNotNull()).select(key).distinct()
    few = [r[0] for r in wanted.limit(LOOKUP_KEYS + 1).collect()]
    if len(few) > LOOKUP_KEYS:
        return table.select(key).join(wanted, key, "left_semi")
    return table.filter(F.col(key).isin(few)).select(key)


def not_in(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return source.join(target.select(key), key, "left_anti")


def merge_counts(source: DataFrame, target: DataFrame, key: str, name: str) -> DataFrame:
    """Rows in a batch, rows an insert-only merge would add, and rows already there."""
    offered = source.select(F.lit(1).alias("offered"), F.lit(0).alias("added"))
    added = not_in(source, target, key).select(F.lit(0).alias("offered"), F.lit(1).alias("added"))
    return offered.unionByName(added).agg(
        F.coalesce(F.sum("offered"), F.lit(0)).alias("in_batch"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("inserted")).select(
            F.lit(name).alias("table_name"), "in_batch", "inserted",
            (F.col("in_batch") - F.col("inserted")).alias("already_present"))


def changed_or_new(source: DataFrame, target: DataFrame, key: str,
                   compare: list[str]) -> DataFrame:
    """Source rows that are new, or differ from the target in one of `compare`."""
    before = target.select(F.col(key).alias("_old_key"),
                           F.struct(*[F.col(c) for c in compare]).alias("_old"))
    now = F.struct(*[F.col(c) for c in compare])
    return (source.join(before, F.col(key) == F.col("_old_key"), "left")
            .filter(F.col("_old_key").isNull() | ~now.eqNullSafe(F.col("_old")))
            .drop("_old_key", "_old"))


def merge_result(source: DataFrame, target: DataFrame, key: str,
                 compare: list[str]) -> DataFrame:
    """The table after a conditional upsert, as a frame, with `merge_action` per row.

    One shuffle of both sides on the key; unchanged rows pass through."""
    columns = target.columns
    both = (target.select(F.col(key), F.struct(*columns).alias("_t"))
            .join(source.select(F.col(key), F.struct(*columns).alias("_s")), key, "full_outer"))
    differs = reduce(lambda a, b: a | b,
                     [~F.col(f"_t.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in compare])
    action = (F.when(F.col("_t").isNull(), "INSERT").when(F.col("_s").isNull(), "KEEP")
              .when(differs, "UPDATE").otherwise("KEEP"))
    chosen = F.when(action == "KEEP", F.col("_t")).otherwise(F.col("_s"))
    return (both.select(action.alias("merge_action"), chosen.alias("_row"))
            .select("_row.*", "merge_action"))


def create_table_sql(name: str, schema: StructType, partitions: tuple[str, ...] = (),
                     location: str | None = None, comment: str = "") -> str:
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()})", "USING parquet"]
    if partitions:
        parts.append(f"PARTITIONED BY ({', '.join(partitions)})")
    if location:
        parts.append(f"LOCATION '{location}'")
    if comment:
        escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"COMMENT '{escaped}'")
    return "\n".join(parts)


def replaced_rows(current: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """A table after `replace_scope`, as a frame."""
    return current.filter(~scope).unionByName(new)
