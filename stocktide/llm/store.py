"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stocktide.session import release  # noqa: F401 - used with kept() and discard()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local master without one (tests) gets a folder of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stocktide-"))
    return context.getCheckpointDir().rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._kept_at = path
    return table


def kept_apart(df: DataFrame, name: str, test: str) -> tuple[DataFrame, DataFrame]:
    """Like ``kept``, as two tables that are discarded by themselves: rows that pass the test, and the others."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.selectExpr("*", f"({test}) __apart").write.option("compression", "zstd").partitionBy("__apart").parquet(path)
    tables = []
    for value in ("true", "false"):
        at = f"{path}/__apart={value}"
        where = spark._jvm.org.apache.hadoop.fs.Path(at)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            table = spark.read.schema(df.schema).parquet(at)
        else:  # none passed, or all did
            table = spark.createDataFrame([], df.schema)
        table._kept_at = at
        tables.append(table)
    return tables[0], tables[1]


def discard(table: DataFrame) -> None:
    """Deletes a table of ``kept`` that no later step reads."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def workers_see_package(spark: SparkSession) -> None:
    """Puts this package's folder on the path of the Python workers; on a cluster it must be installed or shipped there."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
