"""Helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import discard, new_folder, staged  # noqa: F401


_SHIPPED: set[str] = set()


#: Rows go to Python in batches of so many bytes, which bounds what a worker holds; SMALL_BATCH where
#: a worker holds a batch several times over.
BATCH_BYTES, SMALL_BATCH = 8 << 20, 2 << 20


def ship_package(spark: SparkSession, batch: int = BATCH_BYTES) -> None:
    """Sends this package to the executors, once per application, so that functions which run
    there can import it, and bounds the session's Arrow batches. The archive is made on the driver,
    which serves it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / package.name
        context.addPyFile(shutil.make_archive(str(to), "zip", package.parent, package.name))


def give_back() -> None:
    """Returns what a Python worker has freed to the system. Workers live on between stages, and
    would keep the most that any of them needed."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # of glibc only
    if trim:
        trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it unlike any column's."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def named(df: DataFrame) -> list[Column]:
    """All columns, also those with a dot or a backtick in their name."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def crc32_mod(name: str, modulus: int) -> Column:
    return F.pmod(F.crc32(F.col(quoted(name)).cast("string").cast("binary")), F.lit(modulus))
