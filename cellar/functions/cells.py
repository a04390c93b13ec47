"""Column expressions for cell text: rendering, number printing, tokenising,
lenient parsing and vector text.  All are built from ``pyspark.sql.functions``
so they stay inside whole-stage code generation (no Python in the hot path).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source behaviour for equal results) -------
FILLER = "0"                      # text written for a missing cell
SEPARATOR = ","                   # cell separator in text lines
MISSING_TEXTS = ("", "0", "0.0")  # texts that count as "no value" in recodes
UNKNOWN_CELL_FORMAT = "Unknown value at Row: %d Column: %d"   # 1-based
CELL_TYPES = ("string", "numeric", "boolean", "blank", "other")
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretty_number(x) -> Column:
    """Print a double with ``%f`` (6 decimals, half-up, no exponent) and strip
    trailing zeros and a trailing dot: 100.0 -> "100", 5.35 -> "5.35",
    1e-7 -> "0", -0.0 -> "-0".  NaN / Infinity print as Java names them.

    A double whose own text has no exponent and up to 6 decimals is that text already;
    only the others are formatted."""
    x = _col(x).cast("double")
    printed = F.format_string("%f", x)
    own = x.cast("string")
    plain = (F.abs(x).between(0.001, 9_999_999.0) | (x == 0)) & (F.length(own) - F.instr(own, ".") <= 6)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(plain, F.when(own.endswith(".0"), F.substring(own, F.lit(1), F.length(own) - 2)).otherwise(own))
            .when(F.isnan(x) | (F.abs(x) == float("inf")), printed)
            .otherwise(F.regexp_replace(printed, r"[.]?0+$", "")))


def render_cell(cell_type, value, row_num, col_num, *, pretty_numbers: bool = True,
                bool_as_number: bool = False) -> Column:
    """Typed cell -> text.

    string  -> as is
    numeric -> ``pretty_number`` (or the raw text when ``pretty_numbers=False``)
    boolean -> "true"/"false" (or "1"/"0" with ``bool_as_number``)
    blank   -> NULL, i.e. missing; the gap fill writes the filler later
    other   -> "Unknown value at Row: R Column: C" (1-based), parses to 0.0
    """
    cell_type, value = _col(cell_type), _col(value)
    numeric = F.coalesce(pretty_number(value.try_cast("double")), value) if pretty_numbers \
        else value
    boolean = F.lower(value)
    if bool_as_number:
        boolean = F.when(boolean == "true", F.lit("1")).when(boolean == "false", F.lit("0")) \
            .otherwise(boolean)
    marker = F.format_string(UNKNOWN_CELL_FORMAT, _col(row_num) + 1, _col(col_num) + 1)
    return (F.when(cell_type == "string", value)
            .when(cell_type == "numeric", numeric)
            .when(cell_type == "boolean", boolean)
            .when(cell_type == "blank", F.lit(None).cast("string"))
            .otherwise(marker))


def tokenize(line, sep: str = SEPARATOR, drop_trailing_empty: bool = False) -> Column:
    """Split a text line into cells.  Empty tokens are kept (``limit=-1``);
    ``drop_trailing_empty`` drops trailing empty tokens first, like a plain
    Java ``split``."""
    line = _col(line)
    if drop_trailing_empty:
        line = F.regexp_replace(line, "(" + _quote(sep) + ")+$", "")
    return F.split(line, _quote(sep), -1)


def _quote(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def assemble(cells, sep: str = SEPARATOR) -> Column:
    """Join an array of cell texts into one line (NULL cells are skipped by
    ``array_join``; a densified grid has none)."""
    return F.array_join(_col(cells), sep)


def lenient_double(x, default: float = 0.0) -> Column:
    """Text -> double, anything unparsable -> ``default`` (ANSI-safe)."""
    return F.coalesce(_col(x).try_cast("double"), F.lit(float(default)))


# Arrays of a known width up to this are processed with one expression per
# position, which whole-stage code generation compiles; wider ones use a lambda
# (``transform``).  The results are the same.
UNROLL_LIMIT = 1024


def of_size(arr, width: int) -> Column:
    """The array, or a failed job when its size is not ``width``."""
    arr = _col(arr)
    message = F.format_string(f"row of %d values where {width} are expected", F.size(arr))
    return F.when(F.size(arr) != width, F.raise_error(message)).otherwise(arr)


def parse_cells(cells, default: float = 0.0, width: int | None = None) -> Column:
    """array<string> -> array<double> with ``lenient_double`` per element.
    ``width`` (the known array size) keeps the work code-generated; a row of
    another size fails."""
    cells = _col(cells)
    if width is None:
        return F.transform(cells, lambda v: lenient_double(v, default))
    if 0 < width <= UNROLL_LIMIT:
        message = F.format_string(f"row of %d values where {width} are expected", F.size(cells))
        return F.when(F.size(cells) == width, F.array(*[lenient_double(F.get(cells, F.lit(i)), default) for i in range(width)])) \
            .when(cells.isNotNull(), F.raise_error(message))
    return F.transform(of_size(cells, width), lambda v: lenient_double(v, default))


def positional_complement(arr, positions: Iterable[int]) -> Column:
    """Elements whose 0-based index is not listed, order kept."""
    positions = sorted({int(p) for p in positions})
    idx = F.array(*[F.lit(p) for p in positions]) if positions else F.array().cast("array<int>")
    return F.filter(_col(arr), lambda x, i: ~F.array_contains(idx, i))


def is_missing(x) -> Column:
    """NULL, "", "0" or "0.0" — the texts that mean "no answer"."""
    x = _col(x)
    return x.isNull() | x.isin(*MISSING_TEXTS)


def vector_text(features) -> Column:
    """array<double> -> "[a,b,c]" (Java double printing, as a dense vector
    prints itself).  A NULL element prints as NaN and keeps its place."""
    return F.concat(F.lit("["),
                    F.array_join(F.transform(_col(features), lambda v: v.cast("string")), ",", "NaN"),
                    F.lit("]"))

