"""The fitted model scores a stream with the same operators."""

import numpy as np
from pyspark.sql import functions as F

from cellar.operators import kmeans as km
from cellar.streaming.score import score_stream
from paths import SF_SMALL


def test_score_stream_equals_batch(spark, tmp_path):
    src = f"{SF_SMALL}/embeddings.parquet"
    schema = spark.read.parquet(src).schema
    batch = spark.read.parquet(src)

    def prep(df):
        return df.select(F.col("vec_id").alias("row_num"),
                         F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    pts = np.array([r["features"] for r in prep(batch).orderBy("row_num").limit(3).collect()])
    centers = {3: pts}
    std = [2.0] * 64
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet")
              .parquet(SF_SMALL))
    q = (score_stream(prep(stream), centers, std=std).writeStream.format("memory")
         .queryName("scored").option("checkpointLocation", str(tmp_path / "ck"))
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r["row_num"]: r["cluster"] for r in spark.sql("SELECT * FROM scored").collect()}
    scaled = prep(batch).withColumn("features", F.transform("features", lambda v: v / 2.0))
    want = {r["row_num"]: r["cluster"] for r in km.assign(scaled, centers).collect()}
    assert got == want and len(got) == batch.count()
