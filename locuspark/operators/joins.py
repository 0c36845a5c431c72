"""Joins by position that Spark has no operator for, from its own joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def interval_join(points: DataFrame, intervals: DataFrame, chrom: str, pos: str, start: str, end: str, bin_size: int = 1 << 14) -> DataFrame:
    """Points within intervals (ends included), both with a column ``chrom``.

    Positions are cut into bins: an interval is given once for each bin it touches, a point has one bin, and
    (chromosome, bin) is an equi-join key, so no task compares a whole chromosome. An interval and a point
    share one bin only, so no pair is found twice.
    """
    bins = F.explode(F.sequence(F.floor(F.col(start) / bin_size), F.floor(F.col(end) / bin_size))).alias("_bin")
    right = intervals.where(F.col(start) <= F.col(end)).select("*", bins)
    left = points.withColumn("_bin", F.floor(F.col(pos) / bin_size))
    return left.join(right, [chrom, "_bin"]).where(F.col(pos).between(F.col(start), F.col(end))).drop("_bin")


def nearest_before(left: DataFrame, right: DataFrame, chrom: str, pos: str, value: str, out: str, bin_size: int = 1 << 20) -> DataFrame:
    """``left`` with ``out``: the value of the last row of ``right`` at or before its position on the chromosome (of equals the largest value).

    Both are cut into bins of positions, so a chromosome is not one task: within a bin a
    window carries the last value forward, and what precedes a bin is the last value of the nearest earlier bin
    that has one, from a window over one row a bin.
    """
    key = F.struct(F.col(pos).cast("long").alias("p"), F.col(value).alias("v"))
    names = left.columns
    rows = left.select(*names, F.lit(None).cast(right.select(key).schema[0].dataType).alias("_k"), F.lit(1).alias("_left"))
    marks = right.select(*[F.col(c) if c in (chrom, pos) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in names], key.alias("_k"), F.lit(0).alias("_left"))
    both = rows.unionByName(marks).withColumn("_bin", F.floor(F.col(pos) / bin_size))
    within = Window.partitionBy(chrom, "_bin").orderBy(F.col(pos), F.col("_left")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_here", F.max("_k").over(within)).where("_left = 1")
    lasts = right.groupBy(F.col(chrom).alias("_c"), F.floor(F.col(pos) / bin_size).alias("_b")).agg(F.max(key).alias("_last"))
    # The bins that a left row needs, each with the nearest earlier bin of the right side.
    asked = left.select(F.col(chrom).alias("_qc"), F.floor(F.col(pos) / bin_size).alias("_qb")).distinct()
    marks_and_bins = lasts.select("_c", "_b", F.col("_last"), F.lit(0).alias("_q")).unionByName(asked.select(F.col("_qc").alias("_c"), F.col("_qb").alias("_b"), F.lit(None).cast(lasts.schema["_last"].dataType).alias("_last"), F.lit(1).alias("_q")))
    before = Window.partitionBy("_c").orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks_and_bins.withColumn("_before", F.max("_last").over(before)).where("_q = 1").select("_c", "_b", "_before")
    joined = seen.join(carried, (F.col(chrom) == F.col("_c")) & (F.col("_bin") == F.col("_b")), "left")
    return joined.select(*names, F.coalesce("_here", "_before")["v"].alias(out))


def previous_position(rows: DataFrame, chrom: str, pos: str, out: str, bin_size: int = 1 << 20) -> DataFrame:
    """``rows`` with the position of the row before on the chromosome, null for the first; of equal positions all but one have their own.

    As in ``nearest_before``, windows are over bins; the row before a bin's first is the last of the nearest earlier bin, from one row a bin.
    """
    binned = rows.withColumn("_bin", F.floor(F.col(pos) / bin_size))
    lasts = binned.groupBy(F.col(chrom).alias("_c"), F.col("_bin").alias("_b")).agg(F.max(pos).alias("_last"))
    carried = lasts.select("_c", "_b", F.lag("_last").over(Window.partitionBy("_c").orderBy("_b")).alias("_before"))
    within = binned.withColumn("_here", F.lag(pos).over(Window.partitionBy(chrom, "_bin").orderBy(pos)))
    joined = within.join(carried, F.col(chrom).eqNullSafe(F.col("_c")) & F.col("_bin").eqNullSafe(F.col("_b")), "left")
    return joined.select(*rows.columns, F.coalesce("_here", "_before").alias(out))
