"""Gap fill by runs: own width per sheet, repeated cells, wide rows, rows that span
batches; one permutation per workbook; features written and measured once."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellar.operators import features as feat
from cellar.operators import grid as g
from cellar.operators import recode as rc
from cellar.plans import flow as fl
from cellar.sources.tables import CELLS_SCHEMA


def cells_of(spark, rows):
    return spark.createDataFrame([(w, s, r, c, "string", v) for w, s, r, c, v in rows], CELLS_SCHEMA)


def brute(rows, drop=(), width=None):
    keys = sorted({(w, s, r) for w, s, r, _, _ in rows}, key=str)
    out = {}
    for w, s, r in keys:
        top = width if width is not None else max([c for a, b, _, c, _ in rows if (a, b) == (w, s) and c is not None], default=-1)
        values = {}
        for a, b, n, c, v in rows:
            if (a, b, n) == (w, s, r) and c is not None and v is not None:
                values[c] = max(values.get(c, ""), v)
        out[w, s, r] = [values.get(c, "0") for c in range(top + 1) if c not in drop]
    return out


def collected(grid):
    return {(r["workbook"], r["sheet"], r["row_num"]): r["cells"] for r in grid.collect()}


def sample():
    rnd = random.Random(4)
    rows = []
    for book, sheet, wide in (("a", "x", 7), ("a", "y", 1), ("b", "x", 3), (None, "x", 5)):
        for r in range(40):
            rows += [(book, sheet, r, c, f"{rnd.randrange(9)}") for c in range(wide) if rnd.random() < 0.5]
            rows.append((book, sheet, r, None, None))
    rows += [("a", "y", 3, 0, "first"), ("a", "y", 3, 0, "second"), ("b", "empty", 1, None, None)]
    return rows


@pytest.mark.parametrize("drop", [(), (0, 2), (6, 1, 99)])
@pytest.mark.parametrize("few", [g.FEW_SHEETS, 1])
def test_every_sheet_has_its_own_width(spark, monkeypatch, drop, few):
    monkeypatch.setattr(g, "FEW_SHEETS", few)   # few sheets' widths are sent, many are joined
    rows = sample()
    assert collected(g.densify(cells_of(spark, rows), drop=drop)) == brute(rows, drop)
    assert collected(g.densify(cells_of(spark, rows), drop=drop, width=4)) == brute(rows, drop, 4)


def test_rows_that_span_batches(spark):
    rows = [("a", "x", r, c, f"{r}:{c}") for r in (1, 2, 3) for c in range(r, 40, r)]
    batches = pa.Table.from_pylist([dict(row_num=r, col_num=c, value=v) for _, _, r, c, v in rows]).to_batches(max_chunksize=7)
    out = [x for b in g._filled_runs(["row_num"], [], "0")(iter(batches)) for x in b.to_pylist()]
    # up to each row's last cell
    assert {x["row_num"]: x["cells"] for x in out} == {k[2]: v[:39 // k[2] * k[2] + 1] for k, v in brute(rows).items()}


def test_wide_rows_are_linear(spark):
    """2,000 columns cost about ten times 200, not a hundred times."""
    def seconds(wide):
        cells = spark.range(200).select(
            F.lit("a").alias("workbook"), F.lit("x").alias("sheet"), F.col("id").alias("row_num"),
            F.explode(F.sequence(F.lit(0), F.lit(wide - 1), F.lit(2))).alias("col_num")).withColumn("value", F.lit("v")).cache()
        cells.count()
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            n = g.densify(cells, width=wide - 1).agg(F.sum(F.size("cells"))).first()[0]
            best = min(best, time.perf_counter() - t)
            assert n == 200 * wide
        return best
    narrow = seconds(200)
    assert seconds(2000) < 40 * narrow


def test_permutations(spark, monkeypatch):
    rows = [("a", "d", 0, i, n) for i, n in enumerate(["x", "y", "x"])] + [("b", "d", 0, i, n) for i, n in enumerate(["z", "x", "x", "y"])]
    rows += [("a", "d", r, i, f"a{r}{i}") for r in (1, 2) for i in range(3)] + [("b", "d", r, i, f"b{r}{i}") for r in (1, 2) for i in range(4)]
    for few in (g.FEW_SHEETS, 0):
        monkeypatch.setattr(g, "FEW_SHEETS", few)
        data, header = g.extract_header(g.densify(cells_of(spark, rows)))
        aligned, names = g.align_workbooks(data, header)
        assert g.header_names(names) == ["x", "y", "x", "z"]
        got = {(r["workbook"], r["row_num"]): r["cells"] for r in aligned.collect()}
        assert got["a", 1] == ["a10", "a11", "a12", "0"] and got["b", 2] == ["b21", "b23", "b22", "b20"]
    plan = aligned._jdf.queryExecution().optimizedPlan().toString()
    assert "array_position" not in plan


def test_features_are_made_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(feat, "check_dims", lambda *a: pytest.fail("a pass of its own for the sizes"))
    monkeypatch.setattr(feat.Scaler, "fit", lambda *a: pytest.fail("a pass of its own for the moments"))
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            made.add(len(pdf))
            calls.append(1)
            yield pdf
    rows = [("a", "d", 0, i, n) for i, n in enumerate(["x", "y"])] + [("a", "d", r, i, str(r % 7 + i)) for r in range(1, 60) for i in range(2)]
    sf = fl.sheet_to_features(cells_of(spark, rows), "d")
    sf.features = sf.features.mapInPandas(count, sf.features.schema)
    flow = fl.cluster_flow(sf, k_min=2, k_max=3, max_iter=4, init_mode="first")
    assert flow.report.count() > 0 and flow.scaled.count() == 59
    assert made.value == 59
    assert "Exchange" not in flow.scaled._jdf.queryExecution().executedPlan().toString()


def test_measured(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [8.0, 2.0])], "row_num bigint, features array<double>")
    back, m = feat.write_measured(df, 2, str(tmp_path / "a"))
    assert back.count() == 3 and m.scaler.mean == (4.0, 2.0) and m.scaler.std == pytest.approx((13 ** 0.5, 0.0))
    m.check(2)
    _, bad = feat.write_measured(df.union(spark.createDataFrame([(4, [1.0])], df.schema)), 2, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="sizes differ"):
        bad.check(2)
    _, none = feat.write_measured(df.limit(0), 2, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="no feature rows"):
        none.check(2)


def test_replace_cells(spark):
    grid = spark.createDataFrame([("s", 1, list("abcdef")), ("s", 2, list("ab"))], "sheet string, row_num bigint, cells array<string>")
    out = g.replace_cells(grid, [0, 3], lambda t: t.withColumns({"_p0": F.upper("_p0"), "_p3": F.concat("_p3", "_p0")}))
    assert {r["row_num"]: r["cells"] for r in out.collect()}[1] == ["A", "b", "c", "da", "e", "f"]
    assert rc.columns_of([rc.Category("HQ17"), rc.RawFromCategory("r", "c", "HQ17")]) == {"HQ17", "r", "c"}
