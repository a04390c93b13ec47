"""cellar — turn sparse, loosely typed tables into numeric features and explain
the groups K-Means finds in them, on Spark DataFrames.

Data flows through a small number of frame shapes:

    cells  (workbook, sheet, row_num, col_num, cell_type, value)   long form
    grid   (sheet, row_num, cells array<string>)                   dense rows
    header (sheet, pos, name)                                       small
    table  one string column per header name                        recode input
    features (row_num, features array<double>)                      model input
    centers  (k, cluster, center array<double>)                     small

Every operator is DataFrame in, DataFrame out.  Only bounded, model-sized
state (sheet width, header names, per-column std, cluster centers) ever
reaches the driver, and each such pull states its bound.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run inside tasks (the Arrow kernels of
    ``mapInArrow`` / ``mapInPandas``) are pickled by value, so executors need
    no installed copy of the package; only NumPy, pandas and PyArrow."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - an older cloudpickle: ship with --py-files
        pass


_ship_by_value()
