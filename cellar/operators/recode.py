"""Recodes: category and year codes -> numbers, raw values imputed from their
category, sign merge, a three-tier fallback, and an audit of unknown codes.

A recode is a list of specs applied to a *named string table* (one column
per header name, see ``grid.grid_to_table``).  Which branch a spec takes
depends only on which columns exist, so it is decided when the plan is built;
the per-row work is one projection of range tests and array lookups that
Catalyst fuses into a single code-generated stage.  No shuffle.

Unknown codes (``on_unmapped``):
  "error" (default) fail the job with the column and code in the message,
  "null"  write NULL,
  "keep"  leave the code as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.functions.cells import FILLER, is_missing, pretty_number
from cellar.operators import recode_tables as rt


@dataclass(frozen=True)
class Year:
    """Year code -> year."""
    column: str


@dataclass(frozen=True)
class Category:
    """Category code -> midpoint of its range (table defaults to the column)."""
    column: str
    table: str | None = None

    def __post_init__(self):
        rt.get_table(self.table or self.column)


@dataclass(frozen=True)
class RawFromCategory:
    """A raw value and the category it falls in.  With the raw column: a
    missing raw value takes the category midpoint, and the category is
    cleared.  Without it: the category becomes its midpoint."""
    raw: str
    category: str
    table: str | None = None

    def __post_init__(self):
        if self.raw == self.category:
            raise ValueError("raw and category columns must differ")
        rt.get_table(self.table or self.category)


@dataclass(frozen=True)
class SignMerge:
    """When ``sign`` holds ``negative_code`` the magnitude, as a number, becomes
    negative (zero and text that is no number stay); the sign column is
    cleared.  Needs both columns."""
    sign: str
    magnitude: str
    negative_code: str = rt.SIGN_NEGATIVE_CODE


@dataclass(frozen=True)
class Fallback:
    """Primary value, else a hidden copy, else the category midpoint; the
    helper columns are cleared.  ``full_chain`` also falls through to the
    category when the hidden copy is missing too."""
    primary: str
    hidden: str
    category: str
    table: str = "HQ1b"
    full_chain: bool = False

    def __post_init__(self):
        rt.get_table(self.table)


Spec = Year | Category | RawFromCategory | SignMerge | Fallback


def survey_specs() -> list[Spec]:
    """The 28 recodes of the housing survey (they write disjoint columns, so
    their order does not change the result)."""
    specs: list[Spec] = [Category(c) for c in rt.CATEGORY_COLUMNS]
    specs += [Year(c) for c in rt.YEAR_COLUMNS]
    specs += [RawFromCategory(r, c) for r, c in rt.RAW_CATEGORY_PAIRS]
    specs.append(SignMerge(*rt.SIGN_PAIR))
    specs.append(Fallback(*rt.FALLBACK_COLUMNS))
    return specs


def _listed(v: Column, values: list[float]) -> Column:
    """Codes "0", "1", ... -> values by position."""
    at = v.try_cast("int")
    texts = F.array(*[F.lit(rt.value_text(x)) for x in values])
    return F.when(at.cast("string") == v, F.get(texts, at))


def _year(v: Column) -> Column:
    plain = (F.length(v) == 4) & v.between(str(rt.YEAR_FIRST), str(rt.YEAR_LAST)) & v.rlike("^[0-9]{4}$")
    return (F.when(v == rt.YEAR_MISSING_CODE, F.lit(str(rt.YEAR_MISSING_VALUE)))
            .when(v == rt.YEAR_BEFORE_CODE, F.lit(str(rt.YEAR_BEFORE_VALUE))).when(plain, v))


def mapped(v: Column, table: str) -> Column:
    """Mapped text of a code, NULL when the table lacks it: a range test for
    years, the position for tables of codes 0, 1, 2, ..., else a map."""
    values = rt.get_table(table)
    if table == rt.YEARS:
        return _year(v)
    if list(values) == [str(i) for i in range(len(values))]:
        return _listed(v, list(values.values()))
    extra = {k: x for k, x in values.items() if k not in rt.get_table(rt.YEARS)}
    years = {k: x for k, x in values.items() if k not in extra}
    if years == rt.get_table(rt.YEARS):
        out = F.when(F.lit(False), v)
        for code, value in extra.items():
            out = out.when(v == code, F.lit(rt.value_text(value)))
        return out.otherwise(_year(v))
    items = [x for code, value in values.items() for x in (F.lit(code), F.lit(rt.value_text(value)))]
    return F.create_map(*items)[v]


def lookup(column: str, table: str, on_unmapped: str = "error", label: str | None = None) -> Column:
    """Mapped text of ``column`` in ``table``; ``label`` names the column in the
    message of a failed lookup."""
    v = F.col(column)
    hit = mapped(v, table)
    if on_unmapped == "null":
        return hit
    if on_unmapped == "keep":
        return F.coalesce(hit, v)
    if on_unmapped != "error":
        raise ValueError(f"unknown on_unmapped {on_unmapped!r}")
    msg = F.format_string("unmapped code '%s' in column '%s' (table %s)", v, F.lit(label or column),
                          F.lit(table))
    return F.coalesce(hit, F.when(v.isNotNull(), F.raise_error(msg)))


def _check_only(column: str, table: str, on_unmapped: str, filler: str, label: str | None) -> Column:
    """``filler``, but still fails on an unknown code in "error" mode."""
    if on_unmapped != "error":
        return F.lit(filler)
    # the lookup raises on an unknown code; mapped or NULL codes give filler
    return F.when(lookup(column, table, on_unmapped, label).isNotNull() | F.col(column).isNull(),
                  F.lit(filler))


def spec_updates(spec: Spec, columns: set[str], on_unmapped: str = "error",
                 filler: str = FILLER, labels: dict[str, str] | None = None) -> dict[str, Column]:
    """New expressions for the columns a spec writes (empty when the columns
    it needs are absent).  ``labels`` are the columns' names in messages."""
    has = columns.__contains__
    label = (labels or {}).get
    if isinstance(spec, Year):
        return {spec.column: lookup(spec.column, rt.YEARS, on_unmapped, label(spec.column))} if has(spec.column) \
            else {}
    if isinstance(spec, Category):
        return {spec.column: lookup(spec.column, spec.table or spec.column, on_unmapped, label(spec.column))} \
            if has(spec.column) else {}
    if isinstance(spec, RawFromCategory):
        table = spec.table or spec.category
        if not has(spec.category):
            return {}
        mid = lookup(spec.category, table, on_unmapped, label(spec.category))
        if not has(spec.raw):
            return {spec.category: mid}
        return {spec.raw: F.when(is_missing(F.col(spec.raw)), mid).otherwise(F.col(spec.raw)),
                spec.category: _check_only(spec.category, table, on_unmapped, filler, label(spec.category))}
    if isinstance(spec, SignMerge):
        if not (has(spec.sign) and has(spec.magnitude)):
            return {}
        mag = F.col(spec.magnitude)
        number = F.trim(mag).try_cast("double")
        negative = pretty_number(-F.abs(number))
        return {spec.magnitude: F.when((F.col(spec.sign) == spec.negative_code) & (number != 0), negative)
                .otherwise(mag),
                spec.sign: F.lit(filler)}
    if isinstance(spec, Fallback):
        p, h, c = spec.primary, spec.hidden, spec.category
        mid = lookup(c, spec.table, on_unmapped, label(c)) if has(c) else None
        out: dict[str, Column] = {}
        if has(p):
            if has(h):
                alt = F.col(h)
                if spec.full_chain and mid is not None:
                    alt = F.when(is_missing(F.col(h)), mid).otherwise(F.col(h))
            else:
                alt = mid
            if alt is not None:
                out[p] = F.when(is_missing(F.col(p)), alt).otherwise(F.col(p))
            if has(h):
                out[h] = F.lit(filler)
            if has(c):
                out[c] = F.lit(filler)
        elif has(h) and has(c):
            out[h] = F.when(is_missing(F.col(h)), mid).otherwise(F.col(h))
            out[c] = F.lit(filler)
        elif has(c):
            out[c] = mid
        return out
    raise TypeError(f"unknown spec {spec!r}")


_COLUMN_FIELDS = ("column", "raw", "category", "sign", "magnitude", "primary", "hidden")


def columns_of(specs: Sequence[Spec]) -> set[str]:
    """The names of the columns that some specs read or write."""
    return {getattr(s, f.name) for s in specs for f in fields(s) if f.name in _COLUMN_FIELDS}


def at_places(specs: Sequence[Spec], places: dict[str, str]) -> tuple[list[Spec], dict[str, str]]:
    """Specs over header names -> specs over the columns ``places[name]`` (a name that
    is not there stays absent), and the names of those columns for messages."""
    out = []
    for spec in specs:
        own = {f.name: getattr(spec, f.name) for f in fields(spec)}
        moved = {f: places.get(own[f], f"absent {own[f]}") for f in _COLUMN_FIELDS if f in own}
        if "table" in own and own["table"] is None:
            moved["table"] = own.get("column") or own.get("category")
        out.append(replace(spec, **moved))
    return out, {column: name for name, column in places.items()}


def recode(table: DataFrame, specs: Sequence[Spec] | None = None, *, on_unmapped: str = "error",
           filler: str = FILLER, row_col: str | None = "row_num",
           labels: dict[str, str] | None = None) -> DataFrame:
    """Apply ``specs`` (default: the survey's 28) in order.  Sheet row 0 (the
    header position) is left untouched when ``row_col`` is present."""
    specs = survey_specs() if specs is None else list(specs)
    out = table
    for spec in specs:
        updates = spec_updates(spec, set(out.columns), on_unmapped, filler, labels)
        if not updates:
            continue
        if row_col and row_col in out.columns:
            updates = {c: F.when(F.col(row_col) == 0, F.col(c)).otherwise(e)
                       for c, e in updates.items()}
        out = out.withColumns(updates)
    return out


def looked_up(spec: Spec, columns: set[str]) -> list[tuple[str, str]]:
    """``(column, table)`` pairs whose codes a spec looks up."""
    has = columns.__contains__
    if isinstance(spec, Year):
        return [(spec.column, rt.YEARS)] if has(spec.column) else []
    if isinstance(spec, Category):
        return [(spec.column, spec.table or spec.column)] if has(spec.column) else []
    if isinstance(spec, RawFromCategory):
        return [(spec.category, spec.table or spec.category)] if has(spec.category) else []
    if isinstance(spec, Fallback):
        return [(spec.category, spec.table)] if has(spec.category) else []
    return []


def recode_frame(spark: SparkSession) -> DataFrame:
    """All code tables, ``(table, code, value double)``; a few hundred rows."""
    return spark.createDataFrame(rt.recode_rows(), "table string, code string, value double")


def recode_audit(table: DataFrame, specs: Sequence[Spec] | None = None,
                 row_col: str | None = "row_num") -> DataFrame:
    """``(column, code, n)`` for every observed code that its table lacks.

    Codes are counted with a partial aggregate first, so a code held by a
    third of all rows costs one row per partition in the shuffle; the code
    tables (a few hundred rows, fixed) are broadcast.
    """
    specs = survey_specs() if specs is None else list(specs)
    cols = set(table.columns)
    pairs = [p for s in specs for p in looked_up(s, cols)]
    spark = table.sparkSession
    if not pairs:
        return spark.createDataFrame([], "column string, code string, n long")
    src = table.where(F.col(row_col) != 0) if row_col and row_col in cols else table
    observed = (src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("table"), F.col(c).alias("code"))
        for c, t in pairs])).alias("o")).select("o.*")
        .groupBy("column", "table", "code").agg(F.count(F.lit(1)).alias("n")))
    known = F.broadcast(recode_frame(spark).select("table", "code"))
    return observed.join(known, ["table", "code"], "left_anti").select("column", "code", "n")
