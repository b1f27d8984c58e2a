"""Bounded samples of labelled rows for fitting, and the folds they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def sample(docs: DataFrame, rows: DataFrame, most: int):
    """Whole texts and targets of at most ``most`` rows, as a pandas frame.

    ``rows``: (doc_id, target). The rows kept are those of smallest id hash, so they don't follow any order of the table;
    the choice is made on ids alone, then the texts of the chosen ids are read.
    """
    chosen = rows.withColumn("__h", F.xxhash64("doc_id")).orderBy("__h", "doc_id").limit(most).drop("__h")
    spark = docs.sparkSession
    ids = spark.createDataFrame([tuple(r) for r in chosen.collect()], chosen.schema)
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id").toPandas()
    return found.sort_values(["doc_id", "text"], kind="stable").drop_duplicates("doc_id")
