"""Dataset comparison: the rows two frames do not share, with multiplicity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(*columns, left_n, right_n)`` for every distinct row whose count
    differs between the frames (NULLs compare equal, as in ``EXCEPT ALL``).

    One aggregate over both inputs; identical rows are counted map-side
    first, so a row value held by a third of all rows is one partial count
    per partition in the shuffle.
    """
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    counts = tagged.groupBy(*cols).agg(F.sum("_l").alias("left_n"), F.sum("_r").alias("right_n"))
    return counts.where(F.col("left_n") != F.col("right_n"))


def dataset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(side, *columns)``: rows of ``left`` missing from ``right`` (side
    "left_only") and the reverse ("right_only"), duplicates counted.  One aggregate
    over both inputs (``diff_counts``); each surplus row comes out as often as it is
    in surplus."""
    cols = left.columns
    surplus = F.col("left_n") - F.col("right_n")
    side = F.when(surplus > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    return diff_counts(left, right.select(*cols)).select(
        side.alias("side"), *cols, F.explode(F.sequence(F.lit(1).cast("long"), F.abs(surplus))).alias("_time")).drop("_time")


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True when both frames hold the same multiset of rows."""
    return diff_counts(left, right).limit(1).count() == 0
