"""Sinks: quoted CSV keeps commas inside cells, ordered multi-part text,
model files and centers tables round-trip."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.operators import kmeans as km
from cellar.sinks import files as sk
from cellar.sources.tables import number_rows, read_feature_text


def test_csv_quotes_separators(spark, tmp_path):
    grid = spark.createDataFrame([("s", 1, ["a,b", 'say "hi"', "x\ny"]), ("s", 2, ["1", "", "3"]), ("t", 1, ["\\n", "a\\\\b", "\r\n"]),
                                  ("t", 2, ["  lead", "trail  ", " "]), ("t", 3, ["a\0b", "\\0", "\\\n\\\\n"]), ("t", 4, ["", "\t", "\u3000x"])],
                                 "sheet string, row_num bigint, cells array<string>")
    path = str(tmp_path / "csv")
    sk.write_grid_csv(grid, path, 3)
    back = {(r["sheet"], r["row_num"]): r["cells"] for r in sk.read_grid_csv(spark, path, 3).collect()}
    assert back == {(r["sheet"], r["row_num"]): r["cells"] for r in grid.collect()}
    # one line a row: the files can be split
    assert spark.read.text(path).count() == 6


def test_ordered_text(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.format_string("line %04d", "id").alias("t"))
    path = str(tmp_path / "ordered")
    sk.write_ordered_text(df.repartition(7), path, ["id"], "t", parts=4)
    lines = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(part) as fh:
            lines += fh.read().splitlines()
    assert lines == [f"line {i:04d}" for i in range(1000)]


def test_vector_text_roundtrip(spark, tmp_path):
    f = spark.createDataFrame([(0, [1.5, -2.0, 0.0]), (1, [3.25, 4.0, 1e-3])],
                              "row_num bigint, features array<double>")
    path = str(tmp_path / "vec")
    sk.write_vector_text(f, path)
    back = sorted(r["features"] for r in read_feature_text(spark, path).collect())
    assert back == [[1.5, -2.0, 0.0], [3.25, 4.0, 1e-3]]


def test_centers_and_model_roundtrip(spark, tmp_path):
    centers = km.centers_frame(spark, {2: np.array([[0.0, 1.0], [2.0, 3.0]])})
    path = str(tmp_path / "centers")
    sk.save_centers(centers, path)
    assert km.centers_from_frame(sk.load_centers(spark, path))[2].tolist() == \
        [[0.0, 1.0], [2.0, 3.0]]
    f = spark.createDataFrame([(i, [float(i % 3), float(i % 5)]) for i in range(30)],
                              "row_num bigint, features array<double>")
    model = km.ml_kmeans(f, 2, 5)
    sk.save_model(model, str(tmp_path / "m"))
    sk.save_model(model, str(tmp_path / "m"))          # overwrite replaces the target
    sk.export_pmml(model, str(tmp_path / "pmml"))
    back = sk.load_kmeans_model(str(tmp_path / "m"))
    assert np.allclose(model.clusterCenters(), back.clusterCenters())
    text = "".join(r["value"] for r in spark.read.text(str(tmp_path / "pmml")).collect())
    assert "ClusteringModel" in text


FIRST, SECOND = np.array([[0.5, 1.0], [2.0, 3.0], [9.0, 9.0]]), np.array([[0.25, -1.0], [1e-7, 3.0]])


def current(spark, path):
    """(centers, PMML centers, native centers) of the version that readers see."""
    pmml = sk.load_pmml_centers(spark, sk.chosen_path(spark, path, "pmml")).orderBy("cluster").collect()
    return (next(iter(km.centers_from_frame(sk.load_chosen(spark, path)).values())).tolist(), [r["center"] for r in pmml],
            [list(c) for c in sk.load_chosen_model(spark, path).clusterCenters])


def test_chosen_model_replaces_the_earlier(spark, tmp_path):
    path = str(tmp_path / "chosen")
    with pytest.raises(ValueError, match="no chosen model"):
        sk.load_chosen(spark, path)
    for centers in (FIRST, FIRST, SECOND):
        sk.save_chosen(km.centers_frame(spark, {len(centers): centers}), path)
    assert current(spark, path) == (SECOND.tolist(),) * 3
    assert len(os.listdir(tmp_path / "chosen/versions")) == 2   # older ones are gone
    import xml.etree.ElementTree as ET
    doc = ET.fromstring("\n".join(r["value"] for r in spark.read.text(sk.chosen_path(spark, path, "pmml")).collect()))
    assert doc.tag.endswith("PMML")


@pytest.mark.parametrize("part", ["save_centers", "pmml_lines", "_save_native"])
def test_a_failed_save_leaves_the_earlier_model(spark, tmp_path, monkeypatch, part):
    """Whatever write fails, readers see all parts of the old model; the next save works."""
    path = str(tmp_path / "chosen")
    sk.save_chosen(km.centers_frame(spark, {3: FIRST}), path)
    whole = getattr(sk, part)

    def fail(*args):
        whole(*args)
        raise OSError("lost")
    monkeypatch.setattr(sk, part, fail)
    with pytest.raises(OSError):
        sk.save_chosen(km.centers_frame(spark, {2: SECOND}), path)
    assert current(spark, path) == (FIRST.tolist(),) * 3
    monkeypatch.setattr(sk, part, whole)
    sk.save_chosen(km.centers_frame(spark, {2: SECOND}), path)
    assert current(spark, path) == (SECOND.tolist(),) * 3


def test_row_numbers_do_not_depend_on_the_split(spark, tmp_path):
    lines = spark.range(5000).select(F.format_string("[%d.0,%d.5]", F.col("id"), F.col("id") % 7).alias("value"))
    lines.coalesce(1).write.text(str(tmp_path / "text"))
    spark.range(5000).select((F.col("id") * 3).alias("v")).coalesce(1).write.parquet(str(tmp_path / "table"))
    seen, chosen = [], []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "4096"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            back = read_feature_text(spark, str(tmp_path / "text"))
            seen.append(sorted((r["row_num"], r["features"][0]) for r in back.collect()))
            res = km.sweep(back, 2, 4, max_iter=4)
            chosen.append((res.chosen, res.wssse, [c.tolist() for c in res.centers.values()]))
            numbered = number_rows(spark.read.parquet(str(tmp_path / "table")))
            assert sorted((r["row_num"], r["v"]) for r in numbered.collect()) == [(i + 1, 3 * i) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] == [(i + 1, float(i)) for i in range(5000)]
    assert chosen[0] == chosen[1]


def test_shared_folder_must_be_named():
    """On a cluster a session without a shared folder is refused."""
    from types import SimpleNamespace
    from cellar.session import checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=sc)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session)
