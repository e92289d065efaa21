"""Session helpers: tables, the shared checkpoint folder, written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shipped(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once, so that their Python workers can import it wherever they start."""
    context = spark.sparkContext
    if not getattr(context, "_factloom_shipped", False):
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="factloom-code-"), "factloom.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("factloom", os.path.relpath(full, root)))
        context.addPyFile(path)
        context._factloom_shipped = True
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # whole texts: smaller batches keep the Python workers small
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark's own readers touch the path."""
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    shipped(spark)
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str = "table", by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors.

    The write's own shuffle files go as soon as it is done.  by: a column whose values
    get folders of their own, which a filter on it skips and dropped() can empty alone.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/factloom/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._factloom_path = path
    return made


def dropped(*tables: DataFrame, part: str = "") -> None:
    """Empty tables that written() made and that nothing needs any more; part: only this folder of theirs, as in column=value."""
    for t in tables:
        schema = [f for f in t.schema.fields if f.name != part.split("=")[0]]
        t.sparkSession.createDataFrame([], T.StructType(schema)).coalesce(1).write.mode("overwrite").parquet(f"{t._factloom_path}/{part}".rstrip("/"))


def written_once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from sf_dir, written by the first query of the session that needs it; a session sees its tables unchanged."""
    context = spark.sparkContext
    known = context.__dict__.setdefault("_factloom_tables", {})
    if (sf_dir, label) not in known:
        known[sf_dir, label] = written(build(), label)
    return known[sf_dir, label]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
