"""Feature rows: parsing, dimension checks and standard scaling.

* ``to_features``     grid -> ``(row_num, features array<double>)`` (P14/P15)
* ``vector_sizes``    min/max vector size, no collect of rows (A2)
* ``dim_violations``  rows whose size differs from the most common one (M3)
* ``scale_fit``       per-position mean and sample std in one pass (A3/M1)
* ``scale_transform`` divide by std, zero-variance positions -> 0.0 (M2)
* ``write_measured``  write features once and learn sizes, means and stds in that job

``scale_fit`` is one vector aggregate (``pyspark.ml.stat.Summarizer``) with a
map-side partial step, so the shuffle carries ``partitions x width`` numbers
whatever the row count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions.cells import UNROLL_LIMIT, of_size, parse_cells


def to_features(grid: DataFrame, default: float = 0.0, keep=None,
                width: int | None = None) -> DataFrame:
    """Cell texts -> doubles; anything unparsable is ``default``.  ``width``
    (the known row width) keeps the parse code-generated; a row of another
    size fails.  ``keep``: columns that ride along, by default ``workbook``
    (when there is one) and ``row_num``."""
    if keep is None:
        keep = [x for x in ("workbook", "row_num") if x in grid.columns]
    return grid.select(*keep, parse_cells("cells", default, width).alias("features"))


def numeric_features(df: DataFrame, columns, keep=(), default: float = 0.0) -> DataFrame:
    """Table columns -> ``(*keep, row_num, features)`` by direct casts; text that
    is no number and NULL give ``default``.  A ``row_num`` of the table is taken (see
    ``sources.tables.number_rows``); without one, rows get unique numbers that depend on
    how the table is split."""
    types = dict(df.dtypes)
    number = F.col("row_num") if "row_num" in types else F.monotonically_increasing_id() + 1
    one = [(F.col(c).try_cast("double") if types[c] == "string" else F.col(c).cast("double")) for c in columns]
    return df.select(*keep, number.alias("row_num"),
                     F.array(*[F.coalesce(x, F.lit(float(default))) for x in one]).alias("features"))


def vector_sizes(features: DataFrame, col: str = "features") -> DataFrame:
    """``(n, min_size, max_size)``; empty input gives n=0 and NULL sizes."""
    size = F.size(col)
    return features.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("min_size"),
                        F.max(size).alias("max_size"))


def size_histogram(features: DataFrame, col: str = "features") -> DataFrame:
    """``(size, n)``; one row per distinct vector size (partial aggregate)."""
    return features.groupBy(F.size(col).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def dim_violations(features: DataFrame, col: str = "features") -> DataFrame:
    """Rows whose size differs from the most common size (ties -> the
    smaller size), with their ``size``.  One plan: the mode is a one-row
    aggregate of the size histogram, compared as a scalar."""
    # count first, then the smaller size: the largest (n, -size)
    best = size_histogram(features, col).agg(
        F.max(F.struct(F.col("n"), (-F.col("size")).alias("neg"))).alias("top")).select(
        (-F.col("top.neg")).alias("_mode"))
    return features.withColumn("size", F.size(col)).where(F.col("size") != best.scalar())


def check_dims(features: DataFrame, col: str = "features") -> int:
    """Raise when vector sizes differ or there are no rows; return the size."""
    row = vector_sizes(features, col).collect()[0]
    if row["n"] == 0:
        raise ValueError("no feature rows")
    if row["min_size"] != row["max_size"]:
        raise ValueError(f"vector sizes differ: min {row['min_size']}, max {row['max_size']}")
    return int(row["min_size"])


def scale_fit(features: DataFrame, width: int | None = None, col: str = "features") -> DataFrame:
    """Long ``(pos, n, mean, std)`` with the sample standard deviation, from
    one vector aggregate (``Summarizer``); one row, or a zero-variance
    column, gives std 0.0."""
    from pyspark.ml.stat import Summarizer

    stats = features.select(Summarizer.metrics("count", "mean", "std")
                            .summary(array_to_vector(col)).alias("s"))
    zipped = F.arrays_zip(vector_to_array("s.mean").alias("mean"),
                          vector_to_array("s.std").alias("std"))
    std = F.col("m.std")
    return (stats.select(F.col("s.count").alias("n"), F.posexplode(zipped).alias("pos", "m"))
            .select("pos", "n", F.col("m.mean").alias("mean"),
                    F.when(std.isNull() | F.isnan(std), F.lit(0.0)).otherwise(std).alias("std")))


@dataclass(frozen=True)
class Measured:
    """What one write of the features found."""
    n: int
    min_size: int | None
    max_size: int | None
    scaler: "Scaler | None"     # None unless all sizes are the given width

    def check(self, width: int) -> None:
        """Raise unless there are rows and all have ``width`` values."""
        if self.n == 0:
            raise ValueError("no feature rows")
        if self.min_size != self.max_size:
            raise ValueError(f"vector sizes differ: min {self.min_size}, max {self.max_size}")
        if self.min_size != width:
            raise ValueError(f"vector size {self.min_size} differs from width {width}")


def write_measured(features: DataFrame, width: int, path: str, col: str = "features") -> tuple[DataFrame, Measured]:
    """Write feature rows as Parquet to ``path`` (shared storage) and read them back;
    count, least and largest size, means and standard deviations are observed in the
    same job, so what made the rows runs once.  Rows of another size count as zeros in
    the moments, which then are not reported."""
    from pyspark.ml.stat import Summarizer
    from pyspark.sql import Observation

    size = F.size(col)
    whole = F.when(size == width, F.col(col)).otherwise(F.array_repeat(F.lit(0.0), width))
    seen = Observation()
    moments = Summarizer.metrics("mean", "std").summary(array_to_vector(whole))
    features.observe(
        seen, F.count(F.lit(1)).alias("n"), F.min(size).alias("min_size"), F.max(size).alias("max_size"),
        *[vector_to_array(moments[x]).alias(x) for x in ("mean", "std")]).write.mode("overwrite").parquet(path)
    back = features.sparkSession.read.schema(features.schema).parquet(path)
    if back.isEmpty():  # a plan that is known to be empty observes nothing
        return back, Measured(0, None, None, None)
    got = seen.get
    scaler = None
    if got["n"] and got["min_size"] == got["max_size"] == width:
        scaler = Scaler(tuple(0.0 if math.isnan(x) else float(x) for x in got["std"]),
                        tuple(float(x) for x in got["mean"]))
    return back, Measured(got["n"], got["min_size"], got["max_size"], scaler)


@dataclass(frozen=True)
class Scaler:
    """Fitted scaler: per-position std (and mean, for reports)."""
    std: tuple[float, ...]
    mean: tuple[float, ...]

    @staticmethod
    def fit(features: DataFrame, width: int, col: str = "features") -> "Scaler":
        """Runs ``scale_fit``; brings ``width`` pairs of numbers to the driver."""
        rows = sorted(scale_fit(features, width, col).collect(), key=lambda r: r["pos"])
        return Scaler(tuple(float(r["std"]) for r in rows),
                      tuple(float(r["mean"] or 0.0) for r in rows))

    def transform(self, features: DataFrame, col: str = "features",
                  out: str | None = None) -> DataFrame:
        return features.withColumn(out or col, scale_transform(F.col(col), self.std))


def scale_transform(x, std) -> "F.Column":
    """``x / std`` per position (std 0 -> 0.0), like a standard scaler with
    ``withMean=False, withStd=True``.  A row of another size fails.  The std values are constants, so each
    position is one code-generated expression."""
    x = F.col(x) if isinstance(x, str) else x
    std = [float(s) for s in std]
    if 0 < len(std) <= UNROLL_LIMIT:
        message = F.format_string(f"row of %d values where {len(std)} are expected", F.size(x))
        scaled = F.array(*[F.lit(0.0) if s == 0 else F.get(x, F.lit(i)) / F.lit(s) for i, s in enumerate(std)])
        return F.when(F.size(x) == len(std), scaled).when(x.isNotNull(), F.raise_error(message))
    stds = F.array(*[F.lit(s) for s in std])
    return F.zip_with(of_size(x, len(std)), stds, lambda v, s: F.when(s == 0, F.lit(0.0)).otherwise(v / s))
