"""The full flow on a survey-shaped workbook: header extracted, id column
dropped, the survey recodes applied, scaled, swept, reported with the
codebook's descriptions."""

import os

import pytest
from pyspark.sql import functions as F

from cellar.plans import flow as fl
from cellar.sinks.files import load_chosen
from cellar.sources.workbook import read_workbooks
from xlsx import write_xlsx

NAMES = ["id", "HQ17", "HQR1a", "HQH2_1", "HQH2b", "HQH6a3", "HQH6a3part2_1", "HQ1_1",
         "HQ1hidden_1", "HQ1b", "HQ6c3"]


def data_rows(n=60):
    rows = {0: dict(enumerate(NAMES))}
    for i in range(1, n + 1):
        g = i % 3                      # three loose groups
        row = {0: i, 1: 1 + g * 5, 2: 1960 + g * 20 + i % 4,
               4: 1 + g * 3, 5: 3 if g == 2 else 1, 6: 5 + g * 10 + i % 2,
               8: 100000 * (g + 1), 9: 1 + g * 6, 10: 1 + i % 2}
        if i % 4:                      # raw value present for most rows
            row[3] = 50000 * (g + 1) + i
        if i % 5:                      # primary value present for most rows
            row[7] = 120000 * (g + 1) + i
        rows[i] = row
    return rows


CODEBOOK = {
    0: {1: "Variable", 2: "Description"},
    1: {1: "HQ17", 2: "first text"},
    2: {1: "HQ17", 2: "Amount spent on improvements"},       # later row wins
    3: {1: "HQR1a", 2: "Year moved in"},
    4: {1: "QQ1", 2: "not a survey name"},                   # wrong prefix: ignored
    5: {1: "HQH2_1", 2: "Purchase price"},
    6: {0: "note", 1: "HQ1_1", 2: "Home value", 3: "extra column ignored"},
}


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("survey")
    write_xlsx(os.path.join(d, "survey.xlsx"), {"Data": data_rows(), "Codebook": CODEBOOK})
    return read_workbooks(spark, str(d)).cache()


def test_codebook(cells):
    book = {r["name"]: r["description"] for r in fl.codebook_for(cells).collect()}
    assert book == {"HQ17": "Amount spent on improvements", "HQR1a": "Year moved in",
                    "HQH2_1": "Purchase price", "HQ1_1": "Home value"}


def test_full_flow(spark, cells, tmp_path):
    sf = fl.sheet_to_features(cells, "Data", rows="extract", drop=[0], specs=None)
    assert sf.width == len(NAMES) - 1
    rows = {r["row_num"]: r["features"] for r in sf.features.collect()}
    assert len(rows) == 60
    r3 = rows[3]                      # i=3: group 0, raw present, primary present
    assert r3[0] == 250.0             # HQ17 code 1 -> midpoint
    assert r3[1] == 1963.0            # year identity
    assert r3[3] == 0.0               # category cleared after the raw value
    assert r3[8] == 0.0               # HQ1b cleared
    r4 = rows[4]                      # raw missing -> midpoint of HQH2b code 4
    assert r4[2] == 175000.0
    r5 = rows[5]                      # i=5: group 2, sign code 3, primary missing
    assert r5[5] == -26.0 and r5[4] == 0.0
    assert r5[6] == 300000.0          # primary from the hidden copy
    flow = fl.cluster_flow(sf, codebook=fl.codebook_for(cells), k_min=2, k_max=4,
                           max_iter=10, init_mode="first", save_to=str(tmp_path / "out"))
    k = flow.sweep.chosen
    assert k in (2, 3, 4)
    report = flow.report.collect()
    names = {r["name"] for r in report}
    # cleared helper columns are all zero, so their centers are 0 and unreported
    assert not names & {"HQH2b", "HQH6a3", "HQ1hidden_1", "HQ1b"}
    desc = {r["name"]: r["description"] for r in report}
    assert desc["HQ17"] == "Amount spent on improvements" and desc["HQ6c3"] == ""
    counts = {r["cluster"]: r["nonzero"] for r in flow.nonzero.collect()}
    per_cluster = {}
    for r in report:
        per_cluster[r["cluster"]] = per_cluster.get(r["cluster"], 0) + 1
    assert counts == per_cluster and len(counts) == k
    assert all(r["k"] == k for r in report)
    assert flow.scaled.where(F.size("features") != sf.width).count() == 0
    lines = [r["line"] for r in flow.lines.orderBy("line_no").collect()]
    assert lines[0] == "Reporting center of KMeans cluster 0"
    assert lines[-1] == f"Cardinality of the K-Means clustering found: {k}"
    assert lines[-2].startswith("Within Set Sum of Squared Errors = ")
    assert sum(x.startswith("Number for non-zero columns") for x in lines) == k
    assert spark.read.text(str(tmp_path / "out/vectors")).count() == 60
    assert load_chosen(spark, str(tmp_path / "out/model")).count() == k
    none = fl.cluster_flow(sf, k_min=5, k_max=4)
    assert [r["line"] for r in none.lines.collect()][0].startswith("No K-Means clustering model")
