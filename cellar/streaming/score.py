"""Scoring a stream with a fitted model.

Parsing, scaling and nearest-center assignment are row-local (no state, no
shuffle), so the same operators run unchanged on a streaming DataFrame:
``readStream`` -> ``score_stream`` -> ``writeStream``.  Model state (std and
centers) is fixed for the life of the query and shipped once as a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.operators import kmeans as km
from cellar.operators.features import scale_transform


def score_stream(stream: DataFrame, centers: km.Centers, *, std: Sequence[float] | None = None,
                 col: str = "features", keep: Sequence[str] = ("row_num",)) -> DataFrame:
    """``(*keep, k, cluster, d2)`` for every incoming row (and every k in
    ``centers``).  ``std`` scales the features first, as at training time."""
    if std is not None:
        stream = stream.withColumn(col, scale_transform(F.col(col), std))
    return km.assign(stream, centers, col=col, keep=keep)
