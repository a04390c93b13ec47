"""Cell text functions, gap fill, column and row routing, scaling checks."""

import math

import pytest
from pyspark.sql import functions as F

from cellar.functions import cells as fc
from cellar.operators import features as feat
from cellar.operators import grid as g
from cellar.sources import tables as src


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("v,text", [(100.0, "100"), (5.35, "5.35"), (1e-7, "0"),
                                    (-0.0, "-0"), (0.0, "0"), (101.1, "101.1"),
                                    (1e20, "100000000000000000000"), (-2.5, "-2.5"),
                                    (None, None)])
def test_pretty_number(spark, v, text):
    assert one(spark, fc.pretty_number, v, "double") == text


@pytest.mark.parametrize("text,v", [("1.5", 1.5), (" 2 ", 2.0), ("abc", 0.0), ("", 0.0),
                                    ("NaN", "nan"), ("1d", 1.0), ("-3", -3.0),
                                    ("Unknown value at Row: 1 Column: 2", 0.0)])
def test_lenient_double(spark, text, v):
    got = one(spark, fc.lenient_double, text)
    assert (math.isnan(got) if v == "nan" else got == v)


def test_tokenize(spark):
    df = spark.createDataFrame([("a,,b,,",), (",,,",), ("x",)], "line string")
    got = df.select(fc.tokenize("line").alias("a"),
                    fc.tokenize("line", drop_trailing_empty=True).alias("b")).collect()
    assert got[0]["a"] == ["a", "", "b", "", ""] and got[0]["b"] == ["a", "", "b"]
    assert got[1]["a"] == ["", "", "", ""] and got[1]["b"] == [""]
    assert got[2]["a"] == ["x"]


def test_positional_complement(spark):
    df = spark.createDataFrame([(list(range(50)),)], "a array<int>")
    cases = {"even": [i for i in range(50) if i % 2 == 0],
             "odd": [i for i in range(50) if i % 2 == 1],
             "third": [i for i in range(50) if (i - 1) % 3 == 0]}
    for idx in cases.values():
        got = df.select(fc.positional_complement("a", idx).alias("r")).collect()[0]["r"]
        assert got == [i for i in range(50) if i not in idx]


def test_render_types(spark):
    rows = [(0, 0, "string", "x"), (0, 1, "numeric", "5.350000"), (0, 2, "boolean", "TRUE"),
            (0, 3, "other", "=A1"), (0, 4, "blank", None), (0, 5, "numeric", "oops")]
    cells = spark.createDataFrame(rows, "row_num bigint, col_num int, cell_type string, "
                                        "value string")
    got = {r["col_num"]: r["value"] for r in g.render(cells).collect()}
    # the blank cell is left as a marker of its row
    assert got == {0: "x", 1: "5.35", 2: "true", 3: "Unknown value at Row: 1 Column: 4",
                   5: "oops", None: None}
    raw = {r["col_num"]: r["value"] for r in g.render(cells, pretty_numbers=False,
                                                      bool_as_number=True).collect()}
    assert raw[1] == "5.350000" and raw[2] == "1"


def sparse_cells(spark):
    rows = [("s", 1, 2, "b"), ("s", 2, 0, "c"), ("s", 2, 4, "d"), ("s", 3, 1, "e")]
    return spark.createDataFrame(rows, "sheet string, row_num bigint, col_num int, value string")


def test_densify_gaps_and_width(spark):
    grid = {r["row_num"]: r["cells"] for r in g.densify(sparse_cells(spark)).collect()}
    assert grid == {1: ["0", "0", "b", "0", "0"], 2: ["c", "0", "0", "0", "d"],
                    3: ["0", "e", "0", "0", "0"]}
    assert {len(v) for v in grid.values()} == {5}
    assert g.max_column(sparse_cells(spark)) == 4
    assert g.max_column(sparse_cells(spark).where("false")) == -1


def test_densify_drop_filter_extra_rows(spark):
    extra = spark.createDataFrame([("s", 9)], "sheet string, row_num bigint")
    grid = {r["row_num"]: r["cells"]
            for r in g.densify(sparse_cells(spark), drop=[0, 2], extra_rows=extra).collect()}
    assert grid[1] == ["0", "0", "0"] and grid[2] == ["0", "0", "d"] and grid[9] == ["0"] * 3

    def upper_and_drop_last(pos, v):
        return F.when(pos == 4, F.lit(None).cast("string")).otherwise(F.upper(v))
    grid = {r["row_num"]: r["cells"] for r in
            g.densify(sparse_cells(spark), col_filter=upper_and_drop_last).collect()}
    assert grid[2] == ["C", "0", "0", "0"]


def test_melt_and_fast_path_agree(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 3), (2, None, 2.5, 0)],
                               "k bigint, s string, d double, i int")
    slow = g.densify(g.render(src.melt(df, "k", drop_zero=True)))
    fast = src.grid_from_table(df, "k", drop_zero=True)
    a = sorted((r["row_num"], tuple(r["cells"])) for r in slow.collect())
    b = sorted((r["row_num"], tuple(r["cells"])) for r in fast.collect())
    assert a == b == [(0, ("s", "d", "i")), (2, ("a", "0", "3")), (3, ("0", "2.5", "0"))]


def test_row_routing(spark):
    grid = spark.createDataFrame([("s", 0, ["h1", "h2"]), ("s", 1, ["1", "2"]),
                                  ("s", 2, ["3", "4"])],
                                 "sheet string, row_num bigint, cells array<string>")
    data, header = g.extract_header(grid)
    assert sorted(r["row_num"] for r in data.collect()) == [1, 2]
    assert g.header_names(header) == ["h1", "h2"]
    assert g.discard_header(grid).count() == 2
    saved, extracted = g.route_rows(grid, F.col("row_num") >= 1, F.col("row_num") <= 1)
    assert saved.count() == 2 and extracted.count() == 2
    assert g.unique_names(["a", "", "a", "b"]) == ["a", "_c1", "a__2", "b"]


def test_scaling_properties(spark):
    rows = [(i, [float(i), 5.0, float(i % 3)]) for i in range(20)]
    f = spark.createDataFrame(rows, "row_num bigint, features array<double>")
    sc = feat.Scaler.fit(f, 3)
    assert sc.std[1] == 0.0
    scaled = sc.transform(f)
    fit2 = {r["pos"]: r["std"] for r in feat.scale_fit(scaled, 3).collect()}
    assert fit2[0] == pytest.approx(1.0) and fit2[2] == pytest.approx(1.0) and fit2[1] == 0.0
    assert all(r["features"][1] == 0.0 for r in scaled.collect())
    single = spark.createDataFrame([(0, [1.0, 2.0])], "row_num bigint, features array<double>")
    assert feat.Scaler.fit(single, 2).std == (0.0, 0.0)


def test_dims(spark):
    f = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [3.0, 4.0])],
                              "row_num bigint, features array<double>")
    sizes = feat.vector_sizes(f).collect()[0]
    assert (sizes["min_size"], sizes["max_size"]) == (1, 2)
    assert [r["row_num"] for r in feat.dim_violations(f).collect()] == [0]
    with pytest.raises(ValueError, match="differ"):
        feat.check_dims(f)
    with pytest.raises(ValueError, match="no feature rows"):
        feat.check_dims(f.where("false"))


def test_dataset_diff_multiset(spark):
    from cellar.operators.compare import dataset_diff, diff_counts, same_rows
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (3, "z")],
                              "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (4, "w")], "k int, v string")
    got = sorted((r["side"], r["k"], r["v"]) for r in dataset_diff(a, b).collect())
    want = sorted([("left_only", r["k"], r["v"]) for r in a.exceptAll(b).collect()]
                  + [("right_only", r["k"], r["v"]) for r in b.exceptAll(a).collect()])
    assert got == want == [("left_only", 1, "x"), ("left_only", 1, "x"), ("left_only", 3, "z"),
                           ("right_only", 4, "w"), ("right_only", 4, "w")]
    assert diff_counts(a, a).count() == 0 and same_rows(a, a) and not same_rows(a, b)


def test_drop_columns_and_positions(spark):
    from cellar.operators.lookup import find_position, header_positions
    kept = g.drop_columns(sparse_cells(spark), [0, 4])
    assert sorted(r["col_num"] for r in kept.collect()) == [1, 2]
    header = spark.createDataFrame([("s", 0, "a"), ("s", 1, "b"), ("s", 2, "a")],
                                   "sheet string, pos int, name string")
    assert find_position(header, "a") == 0 and find_position(header, "zz") == -1
    assert {r["name"]: r["pos"] for r in header_positions(header).collect()} == {"a": 0, "b": 1}


def test_sizes_are_checked_at_every_width(spark):
    """Unrolled (narrow) and lambda (wide) paths: a row of another size fails."""
    from cellar.functions import cells as fc
    from cellar.operators.features import scale_transform
    for width in (2, 3, fc.UNROLL_LIMIT + 1):
        good = spark.createDataFrame([(["1"] * width,)], "cells array<string>")
        assert good.select(fc.parse_cells("cells", width=width).alias("x")).first().x == [1.0] * width
        for n in (width - 1, width + 1):
            bad = spark.createDataFrame([(["1"] * n,)], "cells array<string>")
            with pytest.raises(Exception, match=f"row of {n} values where {width}"):
                bad.select(fc.parse_cells("cells", width=width)).collect()
            nums = spark.createDataFrame([([1.0] * n,)], "x array<double>")
            with pytest.raises(Exception, match=f"row of {n} values where {width}"):
                nums.select(scale_transform("x", [2.0] * width)).collect()


def test_rows_without_cells_stay(spark):
    """NULL rows of a table, and sheet rows of blank cells only."""
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, None, None), (2, 0.0, 0.0), (3, None, 4.0)], "k bigint, a double, b double")
    for drop_zero in (False, True):
        cells = src.melt(df, "k", header=False, drop_zero=drop_zero)
        slow = {r["row_num"]: r["cells"] for r in g.densify(g.render(cells), width=1).collect()}
        fast = {r["row_num"]: r["cells"] for r in src.grid_from_table(df, "k", header=False, drop_zero=drop_zero).collect()}
        assert slow == fast and sorted(slow) == [1, 2, 3, 4]
    blank = spark.createDataFrame([("w", "s", 1, 0, "string", "x"), ("w", "s", 2, 0, "blank", None), ("w", "s", 3, 1, "string", "y")],
                                  src.CELLS_SCHEMA)
    rows = {r["row_num"]: r["cells"] for r in g.densify(g.render(blank)).collect()}
    assert rows == {1: ["x", "0"], 2: ["0", "0"], 3: ["0", "y"]}


def test_vector_text_keeps_places(spark):
    from cellar.functions.cells import vector_text
    df = spark.createDataFrame([([1.0, None, 2.0],)], "v array<double>")
    assert df.select(vector_text("v").alias("t")).first().t == "[1.0,NaN,2.0]"


def test_routes_in_one_scan(spark):
    grid = spark.createDataFrame([("s", i, [str(i)]) for i in range(6)], "sheet string, row_num bigint, cells array<string>")
    got = g.route_labels(grid, {"even": F.col("row_num") % 2 == 0, "big": F.col("row_num") > 3})
    assert sorted((r["row_num"], r["route"]) for r in got.collect()) == [
        (0, "even"), (2, "even"), (4, "big"), (4, "even"), (5, "big")]
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_headers_that_clash(spark):
    """Several workbooks: names by workbook, one order by name, or an error."""
    header = spark.createDataFrame([("a", "s", 0, "x"), ("a", "s", 1, "y"), ("b", "s", 0, "y"), ("b", "s", 1, "x")],
                                   "workbook string, sheet string, pos int, name string")
    from cellar.operators.lookup import with_header_name
    rows = spark.createDataFrame([("a", 0), ("b", 0), ("b", 7)], "workbook string, pos int")
    assert sorted((r["workbook"], r["pos"], r["name"]) for r in with_header_name(rows, header).collect()) == [
        ("a", 0, "x"), ("b", 0, "y"), ("b", 7, "")]
    with pytest.raises(Exception, match="several header names"):
        g.header_names(header)
    data = spark.createDataFrame([("a", "s", 1, ["1", "2"]), ("b", "s", 1, ["3", "4"])],
                                 "workbook string, sheet string, row_num bigint, cells array<string>")
    aligned, one = g.align_workbooks(data, header)
    assert g.header_names(one) == ["x", "y"]
    assert {r["workbook"]: r["cells"] for r in aligned.collect()} == {"a": ["1", "2"], "b": ["4", "3"]}


def test_direct_number_text_equals_round_trip(spark):
    """Typed doubles print the same whether formatted directly (table fast
    path) or after their text form (cells path)."""
    import random
    rnd = random.Random(7)
    vals = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-9, 12) for _ in range(3000)]
    vals += [(rnd.randint(-10**7, 10**7) + 0.5) / 1e6 for _ in range(1000)]   # ties at 1e-7
    vals += [0.0, -0.0, 1e-7, 5e-7, 123456789.123456789]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k bigint, x double")
    fast = {r["row_num"]: r["cells"][0] for r in src.grid_from_table(df, "k", header=False)
            .collect()}
    slow = {r["row_num"]: r["cells"][0]
            for r in g.densify(g.render(src.melt(df, "k", header=False)), width=0).collect()}
    assert fast == slow


def test_plain_doubles_are_not_formatted(spark):
    """Texts are those of the formatter, and doubles that print plainly take less time than it (before: the same)."""
    import time

    from pyspark.sql import functions as F

    from cellar.functions.cells import pretty_number

    def formatted(x):
        printed = F.format_string("%f", x)
        return F.when(F.isnan(x) | (F.abs(x) == float("inf")), printed).otherwise(F.regexp_replace(printed, r"[.]?0+$", ""))

    odd = [0.0, -0.0, None, float("nan"), float("inf"), 9999999.0, 9999999.5, 1e7, 0.001, 0.0009999, 1e-7, 100.0, -5.35,
           1234567.1234567, 0.1 + 0.2, 9999998.999999, 0.0010005]
    df = spark.createDataFrame([(v,) for v in odd], "x double")
    wrong = df.where(F.col("x").isNotNull() & ~formatted(F.col("x")).eqNullSafe(pretty_number("x")))
    assert wrong.count() == 0 and df.where(F.col("x").isNull() & pretty_number("x").isNotNull()).count() == 0

    def seconds(text):
        spent = []
        for _ in range(4):
            began = time.time()
            spark.range(0, 1_000_000, 1, 2).select((F.col("id") / 100).alias("x")).agg(F.sum(F.length(text))).collect()
            spent.append(time.time() - began)
        return min(spent)

    assert seconds(pretty_number("x")) < 0.85 * seconds(formatted(F.col("x")))
