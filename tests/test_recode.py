"""Recodes on a survey-shaped sheet (one column per recode kind)."""

import pytest
from pyspark.sql import functions as F

from cellar.operators import recode as rc
from cellar.operators import recode_tables as rt

COLS = ["row_num", "HQ17", "HQR1a", "HQH2_1", "HQH2b", "HQH6a3", "HQH6a3part2_1", "HQ1_1",
        "HQ1hidden_1", "HQ1b", "HQ6c3"]


def frame(spark, rows, cols=COLS):
    return spark.createDataFrame(rows, ", ".join(
        f"{c} {'bigint' if c == 'row_num' else 'string'}" for c in cols))


def out(df):
    return {r["row_num"]: r.asDict() for r in df.collect()}


def test_tables_match_code_book():
    assert rt.get_table("HQ17")["14"] == 1000000
    assert rt.get_table("HQ14") == {"0": 0, "1": 310, "2": 650, "3": 700, "4": 740, "5": 770,
                                    "6": 630}
    years = rt.get_table("years")
    assert years["0"] == 1910 and years["1959"] == 1955 and years["1960"] == 1960
    assert years["2014"] == 2014 and "2015" not in years and "1958" not in years
    assert len(years) == 2 + 55
    assert rt.get_table("HQH1")["1"] == 0 and rt.get_table("HQH1")["1990"] == 1990
    assert rt.get_table("HQ1b")["22"] == 3250000 and len(rt.get_table("HQ1b")) == 23
    assert len(rc.survey_specs()) == 28


def test_survey_recode(spark):
    rows = [
        (0, *COLS[1:]),                                                   # header row: exempt
        (1, "0", "0", "0", "0", "0", "0", "0", "0", "0", "5"),            # all missing
        (2, "3", "1959", "250000", "4", "1", "7", "310000", "0", "5", "2"),  # raw present
        (3, "14", "2014", "", "4", "3", "12.5", "", "205000", "9", "1"),  # raw missing
        (4, "1", "1960", "0.0", "9", "3", "-4", "0", "0", "22", "3"),     # negative, hidden 0
    ]
    res = out(rc.recode(frame(spark, rows)))
    assert res[0]["HQ17"] == "HQ17"
    r1 = res[1]
    assert (r1["HQ17"], r1["HQR1a"], r1["HQH2_1"], r1["HQH2b"]) == ("0", "1910", "0", "0")
    assert (r1["HQH6a3"], r1["HQ1_1"], r1["HQ1hidden_1"], r1["HQ1b"]) == ("0", "0", "0", "0")
    r2 = res[2]
    assert (r2["HQ17"], r2["HQR1a"], r2["HQH2_1"], r2["HQH2b"]) == ("1500", "1955", "250000", "0")
    assert (r2["HQH6a3part2_1"], r2["HQH6a3"]) == ("7", "0")
    assert (r2["HQ1_1"], r2["HQ1hidden_1"], r2["HQ1b"], r2["HQ6c3"]) == ("310000", "0", "0", "2")
    r3 = res[3]
    assert (r3["HQ17"], r3["HQR1a"], r3["HQH2_1"]) == ("1000000", "2014", "175000")
    assert r3["HQH6a3part2_1"] == "-12.5"
    assert (r3["HQ1_1"], r3["HQ1hidden_1"], r3["HQ1b"]) == ("205000", "0", "0")
    r4 = res[4]
    assert (r4["HQH2_1"], r4["HQH2b"]) == ("1150000", "0")
    assert r4["HQH6a3part2_1"] == "-4"           # already negative stays negative
    assert r4["HQ1_1"] == "0"                    # hidden copy is 0 too: not consulted further


def test_full_chain(spark):
    rows = [(1, "0", "0", "7")]
    df = frame(spark, rows, ["row_num", "P", "H", "C"])
    short = out(rc.recode(df, [rc.Fallback("P", "H", "C")]))[1]
    full = out(rc.recode(df, [rc.Fallback("P", "H", "C", full_chain=True)]))[1]
    assert short["P"] == "0" and full["P"] == "325000"


def test_absent_column_variants(spark):
    # only hidden + category: hidden takes the midpoint when missing
    df = frame(spark, [(1, "", "3"), (2, "5", "3")], ["row_num", "HQ1hidden_1", "HQ1b"])
    r = out(rc.recode(df))
    assert (r[1]["HQ1hidden_1"], r[1]["HQ1b"]) == ("125000", "0")
    assert (r[2]["HQ1hidden_1"], r[2]["HQ1b"]) == ("5", "0")
    # only the category: it becomes its midpoint
    df = frame(spark, [(1, "3")], ["row_num", "HQ1b"])
    assert out(rc.recode(df))[1]["HQ1b"] == "125000"
    # raw column absent: the category becomes its midpoint
    df = frame(spark, [(1, "2")], ["row_num", "HQH2b"])
    assert out(rc.recode(df))[1]["HQH2b"] == "75000"
    # sign merge needs both columns
    df = frame(spark, [(1, "3")], ["row_num", "HQH6a3"])
    assert out(rc.recode(df))[1]["HQH6a3"] == "3"


def test_unknown_code_fails(spark):
    df = frame(spark, [(1, "99")], ["row_num", "HQ17"])
    with pytest.raises(Exception, match="unmapped code '99' in column 'HQ17'"):
        rc.recode(df).collect()
    assert out(rc.recode(df, on_unmapped="null"))[1]["HQ17"] is None
    assert out(rc.recode(df, on_unmapped="keep"))[1]["HQ17"] == "99"


def test_unknown_category_fails_even_with_raw(spark):
    df = frame(spark, [(1, "5000", "42")], ["row_num", "HQH2_1", "HQH2b"])
    with pytest.raises(Exception, match="unmapped code '42'"):
        rc.recode(df).collect()


def test_audit(spark):
    df = frame(spark, [(0, "HQ17", "HQR1a"), (1, "99", "1990"), (2, "99", "1800"),
                       (3, "1", "1960")], ["row_num", "HQ17", "HQR1a"])
    got = sorted(tuple(r) for r in rc.recode_audit(df).collect())
    assert got == [("HQ17", "99", 2), ("HQR1a", "1800", 1)]


def test_spec_checks():
    with pytest.raises(ValueError):
        rc.RawFromCategory("X", "X", "HQH2b")
    with pytest.raises(ValueError):
        rc.Category("not_a_table_column")


def test_one_projection(spark):
    """All recodes fuse into one projection over the scan (no shuffle)."""
    df = frame(spark, [(1, *["0"] * 10)])
    plan = rc.recode(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_own_tables_are_checked(spark):
    for bad in ({}, {"1": "x"}, {"1": None}, {"1": float("nan")}, {"1": True}, {1: 2.0}):
        with pytest.raises(ValueError):
            rt.register_table("own", bad)
    with pytest.raises(ValueError, match="shipped"):
        rt.register_table("HQ17", {"1": 1})
    rt.register_table("own", {"a": 1, "b": 2.5})
    df = frame(spark, [(1, "b"), (2, "a")], ["row_num", "X"])
    assert {r["X"] for r in rc.recode(df, [rc.Category("X", "own")]).collect()} == {"2.5", "1"}


def test_sign_merge_is_numeric(spark):
    rows = [(i, "3", m) for i, m in enumerate(["+5", " -5", "5", "-5", "0", "x", "", None, "1e3"], 1)]
    res = out(rc.recode(frame(spark, rows, ["row_num", "S", "M"]), [rc.SignMerge("S", "M")]))
    assert [res[i]["M"] for i in range(1, 10)] == ["-5", "-5", "-5", "-5", "0", "x", "", None, "-1000"]


def test_mapped_equals_the_table(spark):
    """Range test and array lookup agree with the code tables, also on codes
    that only look alike."""
    for name in ("HQ17", "HQH1", "years", "HQ5b2"):
        table = rt.get_table(name)
        codes = [*table, "", "01", "1.0", " 1", "-1", "99", "2015", "1958", "196O", None]
        df = frame(spark, list(enumerate(codes, 1)), ["row_num", "X"])
        got = {r["row_num"]: r["v"] for r in df.select("row_num", rc.mapped(F.col("X"), name).alias("v")).collect()}
        assert [got[i] for i, _ in enumerate(codes, 1)] == [rt.value_text(table[x]) if x in table else None for x in codes]
