"""Sinks: grid rows as CSV, feature rows as vector text, ordered multi-part
text, K-Means models (native and PMML) and centers tables.

Every writer takes a target path and a save mode; ``overwrite`` replaces the
target (the usual "clear the output folder first").  A chosen model, which has several
parts, is replaced as a whole: a new version is written beside the old one and takes
effect with the last write (``save_chosen``).  Paths should live on
shared storage; ``cellar.session.shared_path`` builds one under the session's
checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.functions.cells import vector_text


def _grid_keys(grid: DataFrame) -> list[str]:
    return [c for c in ("workbook", "sheet", "row_num") if c in grid.columns]


def write_grid_csv(grid: DataFrame, path: str, width: int, *, mode: str = "overwrite",
                   keep: Sequence[str] | None = None) -> str:
    """Grid rows -> CSV: the row's keys (workbook, sheet, row_num, as far as the
    grid has them), then one column per cell.  Cells holding the separator or
    quotes are quoted, blanks at their ends stay; backslashes, line breaks and NULs are
    written as ``\\\\``, ``\\n`` / ``\\r`` and ``\\0``, so that every row is one line and the
    files can be split."""
    keep = _grid_keys(grid) if keep is None else list(keep)
    marks = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))

    def marked(x):
        for plain, mark in marks:
            x = F.replace(x, F.lit(plain), F.lit(mark))
        return x
    cells = F.transform("cells", marked)
    cols = [cells[i].alias(f"c{i}") for i in range(width)]
    _exact(grid.select(*keep, *cols).write.mode(mode).option("header", False)).csv(path)
    return path


def _exact(io):
    """CSV options of ``write_grid_csv``: nothing is trimmed."""
    return io.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_grid_csv(spark: SparkSession, path: str, width: int,
                  keep: Sequence[str] = ("sheet", "row_num")) -> DataFrame:
    """CSV written by ``write_grid_csv`` -> grid rows.  Files are split among
    tasks."""
    schema = ", ".join([f"{k} {'bigint' if k == 'row_num' else 'string'}" for k in keep]
                       + [f"c{i} string" for i in range(width)])
    df = _exact(spark.read.schema(schema)).csv(path)

    def plain(c):
        # between doubled backslashes, read from the left, a backslash begins a mark
        parts = F.split(F.coalesce(F.col(c), F.lit("")), r"\\\\", -1)

        def unmarked(x):
            for mark, text in (("\\n", "\n"), ("\\r", "\r"), ("\\0", "\0")):
                x = F.replace(x, F.lit(mark), F.lit(text))
            return x
        return F.array_join(F.transform(parts, unmarked), "\\")
    return df.select(*keep, F.array(*[plain(f"c{i}") for i in range(width)]).alias("cells"))


def write_vector_text(features: DataFrame, path: str, *, mode: str = "overwrite",
                      col: str = "features") -> str:
    """Feature rows -> text lines ``[a,b,c]``."""
    features.select(vector_text(col).alias("value")).write.mode(mode).text(path)
    return path


def write_ordered_text(df: DataFrame, path: str, order_by: Sequence[str], text_col: str,
                       *, parts: int | None = None, mode: str = "overwrite") -> str:
    """Text lines in a global order spread over range-partitioned part files:
    reading the parts in name order gives the lines in order.  This replaces
    a single-file write, which would push every row through one task.  Without
    ``parts`` the number of files follows the data (adaptive execution)."""
    ranged = df.repartitionByRange(parts, *order_by) if parts else df.repartitionByRange(*order_by)
    (ranged.sortWithinPartitions(*order_by)
     .select(F.col(text_col).alias("value")).write.mode(mode).text(path))
    return path


def save_model(model, path: str) -> str:
    """A ``pyspark.ml`` model -> its native folder (replaces the target)."""
    model.write().overwrite().save(path)
    return path


def export_pmml(model, path: str) -> str:
    """A ``pyspark.ml`` K-Means model -> PMML document."""
    model.write().format("pmml").overwrite().save(path)
    return path


def load_kmeans_model(path: str):
    from pyspark.ml.clustering import KMeansModel
    return KMeansModel.load(path)


def save_centers(centers: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """``(k, cluster, center)`` -> Parquet."""
    centers.write.mode(mode).parquet(path)
    return path


def load_centers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- a chosen model ---------------------------------------------------------------

_PMML_CLUSTER = '<Cluster name="cluster_%d"><Array n="%d" type="real">%s</Array></Cluster>'


def pmml_lines(centers: DataFrame) -> DataFrame:
    """``(line_no, line)`` of the PMML document of one model's centers
    ``(k, cluster, center)``; model-sized."""
    one = centers.agg(F.array_sort(F.collect_list(F.struct("cluster", "center"))).alias("c"))
    width = F.size(F.col("c")[0]["center"])
    fields = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.format_string(
        '<DataField name="field_%d" optype="continuous" dataType="double"/>', i))
    mining = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.format_string(
        '<MiningField name="field_%d" usageType="active"/>', i))
    compared = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.format_string(
        '<ClusteringField field="field_%d" compareFunction="absDiff"/>', i))
    clusters = F.transform("c", lambda x: F.format_string(
        _PMML_CLUSTER, x["cluster"], F.size(x["center"]),
        F.array_join(F.transform(x["center"], lambda v: v.cast("string")), " ")))
    head = F.array(F.lit('<?xml version="1.0" encoding="UTF-8"?>'),
                   F.lit('<PMML version="4.2" xmlns="http://www.dmg.org/PMML-4_2">'),
                   F.lit('<Header description="k-means clustering"/>'),
                   F.format_string('<DataDictionary numberOfFields="%d">', width))
    model = F.array(F.lit("</DataDictionary>"), F.format_string(
        '<ClusteringModel modelName="k-means" functionName="clustering" modelClass="centerBased" '
        'numberOfClusters="%d">', F.size("c")), F.lit("<MiningSchema>"))
    measure = F.array(F.lit("</MiningSchema>"), F.lit('<ComparisonMeasure kind="distance"><squaredEuclidean/></ComparisonMeasure>'))
    end = F.array(F.lit("</ClusteringModel>"), F.lit("</PMML>"))
    lines = F.concat(head, fields, model, mining, measure, compared, clusters, end)
    return one.select(F.posexplode(lines).alias("line_no", "line"))


MANIFEST = "name string, version long"


def save_chosen(centers: DataFrame, path: str, *, keep_versions: int = 2) -> str:
    """A chosen model's centers ``(k, cluster, center)`` as a new version under ``path``:
    ``centers`` (Parquet), ``pmml`` (one document) and ``native`` (a saved
    ``pyspark.mllib`` K-Means model), each written whole.

    The version counts from the moment its row is added to the manifest, which is
    written last; a failure before leaves the earlier version in place, all parts of
    one model.  Folders of versions older than the last ``keep_versions``, and of failed
    writes, are removed afterwards."""
    spark = centers.sparkSession
    last = _last_version(spark, path)
    version = (last["version"] if last else 0) + 1
    name = f"v{version}-{uuid.uuid4().hex[:12]}"
    folder = f"{path}/versions/{name}"
    save_centers(centers, f"{folder}/centers")
    (pmml_lines(centers).coalesce(1).sortWithinPartitions("line_no").select(F.col("line").alias("value"))
     .write.mode("overwrite").text(f"{folder}/pmml"))
    _save_native(centers, f"{folder}/native")
    spark.createDataFrame([(name, version)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    _forget(spark, path, keep_versions)
    return path


def _save_native(centers: DataFrame, path: str) -> None:
    from pyspark.mllib.clustering import KMeansModel
    rows = sorted(centers.select("cluster", "center").collect(), key=lambda r: r["cluster"])   # model-sized
    KMeansModel([r["center"] for r in rows]).save(centers.sparkSession.sparkContext, path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def _last_version(spark: SparkSession, path: str):
    if not _exists(spark, f"{path}/manifest"):
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.desc("version"), F.desc("name")).limit(1).collect()
    return rows[0] if rows else None


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    kept = {r["name"] for r in spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
            .orderBy(F.desc("version"), F.desc("name")).limit(keep).collect()}
    files, where = _file_system(spark, f"{path}/versions")
    for found in files.listStatus(where):
        if found.getPath().getName() not in kept:
            files.delete(found.getPath(), True)


def chosen_path(spark: SparkSession, path: str, part: str = "centers") -> str:
    """Where the current version of a chosen model has its ``centers``, ``pmml`` or
    ``native`` model."""
    last = _last_version(spark, path)
    if last is None:
        raise ValueError(f"no chosen model at {path!r}")
    return f"{path}/versions/{last['name']}/{part}"


def load_chosen(spark: SparkSession, path: str) -> DataFrame:
    """``(k, cluster, center)`` of the current version."""
    return load_centers(spark, chosen_path(spark, path))


def load_chosen_model(spark: SparkSession, path: str):
    """The current version as a ``pyspark.mllib`` K-Means model."""
    from pyspark.mllib.clustering import KMeansModel
    return KMeansModel.load(spark.sparkContext, chosen_path(spark, path, "native"))


def load_pmml_centers(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster, center)`` from a PMML document of ``save_chosen``."""
    found = spark.read.text(path).select(
        F.regexp_extract("value", r'<Cluster name="cluster_(\d+)"', 1).alias("cluster"),
        F.regexp_extract("value", r'type="real">([^<]*)</Array>', 1).alias("text"))
    return found.where(F.col("cluster") != "").select(
        F.col("cluster").cast("int").alias("cluster"), F.split("text", " ").cast("array<double>").alias("center"))
