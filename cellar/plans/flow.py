"""End-to-end flows composed from the operators.

``sheet_to_features`` (sheet -> feature rows) and ``cluster_flow`` (sheet ->
scaled features -> K-Means sweep -> chosen model -> center report).  Both
build lazy DataFrames; the driver only sees the sheet widths, the names of recoded
columns, the per-column std and the centers.  The shuffle of the cells runs once in
the whole flow: widths come from a scan of positions, headers from the cells of row
0, and ``cluster_flow`` writes the features once and learns their sizes, means and
standard deviations in that job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.operators import features as feat
from cellar.operators import grid as g
from cellar.operators import kmeans as km
from cellar.operators import lookup as lk
from cellar.operators import recode as rc
from cellar.operators import report as rp
from cellar.session import shared_path
from cellar.sinks.files import load_chosen, save_chosen, write_vector_text
from cellar.sources.tables import select_sheet


@dataclass
class SheetFeatures:
    features: DataFrame          # ([workbook,] row_num, features array<double>)
    header: DataFrame | None     # (sheet, pos, name) or None
    width: int                   # vector size


def sheet_to_features(cells: DataFrame, sheet: str, *, rows: str = "extract",
                      drop: Sequence[int] = (), col_filter: g.ColumnFilter | None = None,
                      specs: Sequence[rc.Spec] | None = (), on_unmapped: str = "error",
                      width: int | None = None, pretty_numbers: bool = True,
                      bool_as_number: bool = False, extra_rows: DataFrame | None = None,
                      default: float = 0.0) -> SheetFeatures:
    """Cells of one sheet, of one workbook or several, -> feature rows.

    ``rows``: "keep" (row 0 stays as data), "discard" (row 0 dropped) or
    "extract" (row 0 becomes the header).  ``drop`` removes original column
    positions before the header is read, so header positions match the kept
    columns.  ``specs`` recode named columns (needs the header; the default
    ``()`` recodes nothing, ``None`` applies the survey's 28 recodes).
    Workbooks whose headers differ are brought to one column order by name.
    """
    if rows not in ("extract", "discard", "keep"):
        raise ValueError(f"unknown rows mode {rows!r}")
    picked = select_sheet(cells, sheet, check=width is not None)
    widths = width
    if width is None:
        # one aggregate of the positions: whether the sheet exists, and its widths
        widths = g.sheet_width(picked)
        top = widths.agg(F.max("max_col")).first()[0]
        if top is None:
            raise ValueError(f"sheet {sheet!r} not found")
        if rows != "extract" or "workbook" not in cells.columns:
            widths = top   # one width for the rows of all workbooks
    else:
        top = width
    options = {"width": widths, "drop": drop, "col_filter": col_filter,
               "rendering": {"pretty_numbers": pretty_numbers, "bool_as_number": bool_as_number}}
    is_head = F.col("row_num") == 0
    header, n = None, len(g.kept_positions(top, drop)) if col_filter is None else None
    if rows == "extract":
        part = lambda cond: None if extra_rows is None else extra_rows.where(cond)
        data = g.densify(picked.where(~is_head), extra_rows=part(~is_head), **options)
        header = g.header_frame(g.densify(picked.where(is_head), extra_rows=part(is_head), **options))
        data, header = g.align_workbooks(data, header)
        n = header.agg(F.max("pos")).first()[0]
        n = n + 1 if n is not None else len(g.kept_positions(top, drop)) if col_filter is None else None
    else:
        data = g.densify(picked if rows == "keep" else picked.where(~is_head), extra_rows=extra_rows
                         if extra_rows is None or rows == "keep" else extra_rows.where(~is_head), **options)
    if specs is None or len(specs):
        if header is None:
            raise ValueError("recodes need the header row (rows='extract')")
        wanted = rc.survey_specs() if specs is None else list(specs)
        # only the recoded columns' positions reach the driver
        first = {r["name"]: int(r["pos"]) for r in lk.header_positions(
            lk.one_name_per_position(header).where(F.col("name").isin(sorted(rc.columns_of(wanted))))).collect()}
        placed, labels = rc.at_places(wanted, {name: g.position_name(p) for name, p in first.items()})
        data = g.replace_cells(data, list(first.values()), lambda t: rc.recode(
            t, placed, on_unmapped=on_unmapped, labels=labels)) if first else data
    features = feat.to_features(data, default)
    if n is None:
        n = feat.check_dims(features)
    return SheetFeatures(features, header, n)


@dataclass
class ClusterFlow:
    scaled: DataFrame
    scaler: feat.Scaler
    sweep: km.SweepResult
    centers: DataFrame       # chosen model: (k, cluster, center)
    report: DataFrame        # (k, cluster, pos, name, value, description)
    nonzero: DataFrame       # (k, cluster, nonzero)
    lines: DataFrame         # (line_no, line) of the printed report


def cluster_flow(sf: SheetFeatures, *, codebook: DataFrame | None = None, k_min: int = 2,
                 k_max: int = 100, max_iter: int = km.DEFAULT_SWEEP_ITERATIONS,
                 method: str = "lloyd", init_mode: str = "hash",
                 seed: int = km.DEFAULT_SEED,
                 chooser: str | km.Chooser = "wssse", tol: float = km.DEFAULT_TOL,
                 check: bool = True, save_to: str | None = None) -> ClusterFlow:
    """Scale, sweep k, choose, report.  The features are written once to the shared
    folder; sizes, means and standard deviations are observed in that job, and sizes
    are checked before any scaling or training.  With ``save_to`` the scaled vectors are
    written as text (``vectors``) and the chosen model as centers and PMML (``model``),
    and the model of the report is the one read back."""
    spark = sf.features.sparkSession
    features, measured = feat.write_measured(
        sf.features, sf.width, shared_path(spark, "flow", f"features-{uuid.uuid4().hex}"))
    if check:
        measured.check(sf.width)
    scaler = measured.scaler or feat.Scaler.fit(features, sf.width)
    scaled = scaler.transform(features)   # the sweep caches what it scans
    if save_to:
        write_vector_text(scaled, f"{save_to}/vectors")
    key = [x for x in ("row_num", "workbook") if x in scaled.columns]  # numbers repeat among workbooks
    result = km.sweep(scaled, k_min, k_max, max_iter=max_iter, method=method, key=key,
                      init_mode=init_mode, seed=seed, chooser=chooser, tol=tol)
    chosen = {} if result.chosen is None else {result.chosen: result.centers[result.chosen]}
    if chosen and save_to:
        save_chosen(km.centers_frame(spark, chosen), f"{save_to}/model")
        chosen = km.centers_from_frame(load_chosen(spark, f"{save_to}/model"))
    centers = km.centers_frame(spark, chosen) if chosen else \
        spark.createDataFrame([], "k int, cluster int, center array<double>")
    header = sf.header.select("pos", "name") if sf.header is not None else None
    report = rp.center_report(centers, header, codebook)
    scores = spark.createDataFrame([(k, result.wssse[k]) for k in chosen], "k int, wssse double")
    return ClusterFlow(scaled, scaler, result, centers, report, rp.nonzero_counts(centers),
                       rp.full_report(report, centers, scores))


def codebook_for(cells: DataFrame, sheet: str = lk.CODEBOOK_SHEET,
                 prefix: str = lk.CODEBOOK_NAME_PREFIX) -> DataFrame:
    return lk.codebook_from_cells(cells.where(F.col("sheet") == sheet), None, prefix)
