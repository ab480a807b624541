"""Table, directory and CSV input and output; chart payloads; the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import CHART_PAYLOAD


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: the session's ``spark.checkpoint.dir``.

    Where that is unset on a local master (tests), a temporary folder is made and set. On a cluster
    an unset folder is an error, since a machine-local one would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _scratch_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/ledgerloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, once no DataFrame that reads them is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV file or directory of part files, with a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_table(
    df: DataFrame, name: str, path: str | None = None, file_format: str = "orc",
    partition_col: str | None = None, mode: str = "overwrite",
) -> None:
    """Save as a catalog table; external when ``path`` is given."""
    writer = _writer(df, partition_col, mode).format(file_format)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_path(
    df: DataFrame, path: str, file_format: str = "orc",
    partition_col: str | None = None, mode: str = "overwrite",
) -> None:
    """Save as a directory of ORC or Parquet files.

    With a partition column, overwriting replaces only the partitions that ``df`` holds.
    """
    writer = _writer(df, partition_col, mode).format(file_format)
    if partition_col in df.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def _writer(df: DataFrame, partition_col: str | None, mode: str):
    writer = df.write.mode(mode)
    # A partition column the frame does not have is ignored.
    return writer.partitionBy(partition_col) if partition_col in df.columns else writer


def parse_chart(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Chart payload text to daily (symbol, day, value): null closes dropped, epoch seconds in UTC.

    A payload that does not parse, or has no close at all, yields no row for its symbol.
    """
    chart = F.from_json(F.col(text), CHART_PAYLOAD)["chart"]["result"]
    result = F.get(chart, F.lit(0))
    quote = F.get(result["indicators"]["quote"], F.lit(0))
    points = F.arrays_zip(result["timestamp"].alias("ts"), quote["close"].alias("close"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("ts") / 86400).cast("int"))
    return (
        payloads.select("symbol", F.inline(points))
        .where(F.col("close").isNotNull() & F.col("ts").isNotNull())
        .select("symbol", day.alias("day"), F.col("close").alias("value"))
    )
