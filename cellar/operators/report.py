"""Cluster-center report: every non-zero coordinate of every center with its
column name and description, non-zero counts per center, and a text form.

Input sizes: ``centers`` is model-sized (``sum(k) x d``), the header is
bounded by the sheet width.  Nothing here scans the feature rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.operators.lookup import with_description, with_header_name

# --- fixed values -------------------------------------------------------------
REPORT_LINE_FORMAT = "Column %4d %-15s value: %17.8f    %s"
CLUSTER_HEADING = "Reporting center of KMeans cluster %d"
CLUSTER_COUNT = "Number for non-zero columns for center of KMeans cluster %d: %d"
COST_LINE = "Within Set Sum of Squared Errors = %s"
CARDINALITY_LINE = "Cardinality of the K-Means clustering found: %d"
NO_MODEL_LINE = "No K-Means clustering model could be found with the set-cardinality requested."
# -----------------------------------------------------------------------------


def center_report(centers: DataFrame, header: DataFrame | None = None,
                  codebook: DataFrame | None = None) -> DataFrame:
    """``(k, cluster, pos, name, value, description)`` for value != 0."""
    long = (centers.select("k", "cluster", F.posexplode("center").alias("pos", "value"))
            .where(F.col("value") != 0))
    if header is not None:
        long = with_header_name(long, header)
    else:
        long = long.withColumn("name", F.lit(""))
    if codebook is not None:
        long = with_description(long, codebook)
    else:
        long = long.withColumn("description", F.lit(""))
    return long.select("k", "cluster", "pos", "name", "value", "description")


def nonzero_counts(centers: DataFrame) -> DataFrame:
    """``(k, cluster, nonzero)``; a projection of the centers, no shuffle."""
    return centers.select("k", "cluster",
                          F.size(F.filter("center", lambda v: v != 0)).alias("nonzero"))


def report_lines(report: DataFrame) -> DataFrame:
    """Adds the printable ``line`` for every report row."""
    return report.withColumn("line", F.format_string(REPORT_LINE_FORMAT, F.col("pos"),
                                                     F.col("name"), F.col("value"),
                                                     F.col("description")))


def full_report(report: DataFrame, centers: DataFrame, scores: DataFrame) -> DataFrame:
    """The whole printed report of one model, ``(line_no, line)`` in order: per
    cluster a heading, its column lines and its count of non-zero columns, then
    cost and k.  ``scores``: ``(k, wssse)`` of the model.  Without a model the
    report says so."""
    head = centers.select("k", "cluster", F.lit(-1).alias("pos"),
                          F.format_string(CLUSTER_HEADING, "cluster").alias("line"))
    body = report_lines(report).select("k", "cluster", "pos", "line")
    end = nonzero_counts(centers).select("k", "cluster", F.lit(2 ** 31 - 1).alias("pos"),
                                         F.format_string(CLUSTER_COUNT, "cluster", "nonzero").alias("line"))
    last = F.lit(2 ** 31 - 1)
    cost = scores.select("k", last.alias("cluster"), F.lit(0).alias("pos"),
                         F.format_string(COST_LINE, F.col("wssse").cast("string")).alias("line"))
    size = scores.select("k", last.alias("cluster"), F.lit(1).alias("pos"),
                         F.format_string(CARDINALITY_LINE, "k").alias("line"))
    lines = head.unionAll(body).unionAll(end).unionAll(cost).unionAll(size)
    if scores.isEmpty():
        lines = scores.sparkSession.createDataFrame([(0, 0, 0, NO_MODEL_LINE)],
                                                    "k int, cluster int, pos int, line string")
    # the lines of a model are model-sized
    ordered = lines.agg(F.array_sort(F.collect_list(F.struct("cluster", "pos", "line"))).alias("l"))
    return ordered.select(F.posexplode("l").alias("line_no", "x")).select("line_no", "x.line")
