"""Code tables as data: in place and by a join, common codes, unknown codes, the audit."""

import pytest
from pyspark.sql import functions as F

from cellar.operators import recode_data as rd

CODES = [("a", "1", 1.5), ("a", "2", 20.0), ("a", "2", 3.0), ("b", "x", -4.0), ("b", "1", 7.0), ("other", "1", 0.0)]


def tables(spark):
    rows = [(0, "a", "b", "kept")]   # the header's row
    rows += [(i, "1" if i % 3 else "2", ["x", "1", None][i % 3], f"t{i}") for i in range(1, 300)]
    rows += [(300, "9", "x", ""), (301, "9", "", None), (302, None, "y", "z")]
    return (spark.createDataFrame(rows, "row_num bigint, a string, b string, c string"),
            spark.createDataFrame(CODES, "column string, code string, value double"), rows)


def brute(rows, mode):
    known = {("a", "1"): "1.5", ("a", "2"): "20", ("b", "x"): "-4", ("b", "1"): "7"}
    out = []
    for n, a, b, c in rows:
        new = [x if n == 0 or x is None else known.get((k, x), x if mode == "keep" else None) for k, x in (("a", a), ("b", b))]
        out.append((n, *new, c))
    return sorted(out)


@pytest.mark.parametrize("mode", ["null", "keep"])
@pytest.mark.parametrize("few, common", [(rd.FEW_CODES, rd.COMMON), (0, rd.COMMON), (0, 4)])
def test_against_brute_force(spark, monkeypatch, mode, few, common):
    monkeypatch.setattr(rd, "FEW_CODES", few)
    monkeypatch.setattr(rd, "COMMON", common)   # with 4, codes of more than a quarter of the cells are common
    table, codes, rows = tables(spark)
    out = rd.recode_from(table, codes, on_unmapped=mode)
    assert out.columns == table.columns
    assert sorted(map(tuple, out.collect())) == brute(rows, mode)


def test_unknown_codes(spark):
    table, codes, _ = tables(spark)
    with pytest.raises(ValueError, match="unmapped code '9' in column 'a' .2 rows"):
        rd.recode_from(table, codes)
    assert sorted(map(tuple, rd.audit_from(table, codes).collect())) == [("a", "9", 2), ("b", "", 1), ("b", "y", 1)]
    whole = rd.recode_from(table.where("row_num < 300"), codes)
    assert whole.where("a = '1.5'").count() == 200


def test_columns(spark):
    table, codes, _ = tables(spark)
    assert rd.recode_from(table, codes.where("column = 'other'")) is table
    only = rd.recode_from(table, codes, ["b"], on_unmapped="keep")
    assert only.where("a = '2'").count() == table.where("a = '2'").count()
    assert rd.recode_from(table.limit(0), codes).count() == 0


def test_a_common_code_is_counted_before_the_shuffle(spark):
    table, codes, _ = tables(spark)
    plan = rd.observed_codes(table, codes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1 or "partial" in plan


def test_a_large_table_needs_the_rows_key(spark, monkeypatch):
    monkeypatch.setattr(rd, "FEW_CODES", 0)
    table, codes, _ = tables(spark)
    with pytest.raises(ValueError, match="key"):
        rd.recode_from(table.drop("row_num"), codes, on_unmapped="null")
    keyed = rd.recode_from(table.withColumnRenamed("row_num", "id"), codes, on_unmapped="null", key=["id"])
    assert keyed.where(F.col("id") == 1).first()["a"] == "1.5"
