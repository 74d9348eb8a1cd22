"""Size on storage of a file-backed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.display import pretty_size


def relation_size(spark: SparkSession, *paths: str) -> DataFrame:
    """One row: number of files, bytes and the readable size of the files under `paths`.

    The listing alone answers: file lengths are read, file contents are not, so it
    costs the same however many rows the files hold.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path", "length")
    )
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).select("files", "bytes", pretty_size(F.col("bytes")).alias("size"))
