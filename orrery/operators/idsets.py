"""Sets of ids as bitmaps: one for each bucket of 32,768 ids, 4 kB each.

Tasks make bitmaps of what they read and only those are shuffled. From a source that is
stored in the order of its ids this is one bit for an id; from one in any order at most
a bitmap for each bucket and task, which is less than the ids themselves from 512 ids a
bucket and task on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAPS = "bucket long, bitmap binary, n long"


def bucket_of(ids: Column) -> Column:
    return F.bitmap_bucket_number(ids)


def id_bitmaps(rows: DataFrame, column: str) -> DataFrame:
    """(bucket, bitmap, n): the ids of each bucket and how many rows have one. NULL is no id."""
    ids = F.col(column).cast("long")
    return (
        rows.filter(ids.isNotNull())
        .groupBy(bucket_of(ids).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bitmap"), F.count("*").alias("n"))
    )


def merged(bitmaps: DataFrame) -> DataFrame:
    """One bitmap a bucket, and in n the rows of all."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n").alias("n"))


def crowded(bitmaps: DataFrame) -> DataFrame:
    """(bucket) of the buckets with more rows than ids."""
    return bitmaps.filter(F.bitmap_count("bitmap") < F.col("n")).select("bucket")


def _of_buckets(rows: DataFrame, column: str, buckets: DataFrame) -> DataFrame:
    ids = F.col(column).cast("long")
    return rows.join(buckets, bucket_of(ids) == buckets["bucket"], "left_semi")


def repeated_ids(rows: DataFrame, column: str) -> DataFrame:
    """(id, copies) of the ids that more than one row has; ids of other buckets do not move."""
    buckets = crowded(id_bitmaps(rows, column))
    return (
        _of_buckets(rows.select(column), column, buckets)
        .groupBy(column)
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def shared_buckets(bitmaps: DataFrame, others: DataFrame) -> DataFrame:
    """(bucket) of the buckets in which two tables of bitmaps have an id in common.

    Of `others` only the buckets of `bitmaps` are read together.
    """
    own = merged(bitmaps).select("bucket", "bitmap")
    known = merged(others.join(own.select("bucket"), "bucket", "left_semi")).select("bucket", "bitmap")
    return (
        own.union(known)
        .groupBy("bucket")
        .agg(F.bitmap_or_agg("bitmap").alias("all"), F.sum(F.bitmap_count("bitmap")).alias("each"))
        .filter(F.bitmap_count("all") < F.col("each"))
        .select("bucket")
    )


def ids_in_common(rows: DataFrame, others: DataFrame, column: str) -> DataFrame:
    """(id) of the ids that rows of both tables have, once each."""
    buckets = shared_buckets(id_bitmaps(rows, column), id_bitmaps(others, column))
    ids = [_of_buckets(t.select(column), column, buckets).distinct() for t in (rows, others)]
    return ids[0].join(ids[1], column, "left_semi")
