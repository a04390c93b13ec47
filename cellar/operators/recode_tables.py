"""Code tables of the housing-survey recodes.

Every table maps a category code ("0", "1", "2", ...) to the midpoint of the
range the code stands for; code "0" means "no answer".  The year table is
built from its rule.
"""

from __future__ import annotations

import math
from functools import lru_cache

# --- fixed values (must equal the survey's code book for equal results) ------
# Midpoints for codes 0, 1, 2, ... in order.
MIDPOINTS: dict[str, list[float]] = {
    "HQ17": [0, 250, 750, 1500, 3500, 7500, 15000, 25000, 40000, 75000, 175000, 375000,
             625000, 875000, 1000000],
    "HQ15": [0, 250, 750, 1500, 3500, 7500, 15000, 25000, 40000, 75000, 100000],
    "HQ14": [0, 310, 650, 700, 740, 770, 630],
    "HQ5b2": [0, 1, 2.25, 2.75, 3.25, 3.75, 4.25, 4.75, 5.25, 5.75, 6.25, 6.75, 7.25, 7.75,
              8.25],
    "HQ5a": [0, 1, 2.25, 2.75, 3.25, 3.75, 4.25, 4.75, 5.25, 5.75, 6.25, 6.75, 7.25, 7.75,
             8.25],
    "HQR2bnew": [0, 3, 30, 365, 730, 1095, 1460],
    "HQR1b": [0, 1, 3, 5, 7, 10, 15, 0],
    "HQH6a": [0, 3, 9, 18, 30, 40],
    "HQH1b": [0, 1, 3, 5, 7, 9, 12, 0],
    "HQ4b1": [0, 2, 12, 30, 50],
    # category columns paired with a raw-value column
    "HQH11b2": [0, 12500, 37500, 75000, 125000, 175000, 250000, 400000, 650000, 850000],
    "HQH5m3": [0, 1, 2.25, 2.75, 3.25, 3.75, 4.25, 4.75, 5.25, 5.75, 6.25, 6.75, 7.25, 7.75,
               8.25],
    "HQH5c2": [0, 250, 750, 1250, 1750, 2250, 2750, 3250, 3750, 4250, 4750, 5250, 5750, 6250],
    "HQH2bnew": [0, 2500, 7500, 12500, 17500, 25000, 40000, 65000, 90000, 125000, 175000,
                 350000, 625000, 875000],
    "HQH2b": [0, 25000, 75000, 125000, 175000, 250000, 400000, 650000, 900000, 1150000],
    # category of the home value, used by the three-tier fallback
    "HQ1b": [0, 25000, 75000, 125000, 175000, 225000, 275000, 325000, 375000, 425000, 475000,
             525000, 575000, 625000, 675000, 750000, 850000, 950000, 1125000, 1375000, 1750000,
             2500000, 3250000],
}
# Year codes: "0" (no answer) -> 1910, "1959" ("before 1960") -> 1955, and
# 1960 .. 2014 stand for themselves.
YEAR_MISSING_CODE, YEAR_MISSING_VALUE = "0", 1910
YEAR_BEFORE_CODE, YEAR_BEFORE_VALUE = "1959", 1955
YEAR_FIRST, YEAR_LAST = 1960, 2014
# HQH1 is the year table plus code "1" ("did not buy") -> 0.
HQH1_EXTRA = {"1": 0}
# Column lists of the survey recode, in the order the survey lists them.
YEAR_COLUMNS = ["HQR6f", "HQR6d", "HQR1a", "HQH11f", "HQH11d", "HQH11a", "HQH5k", "HQH5i",
                "HQH1ab2", "HQH1aa"]
CATEGORY_COLUMNS = ["HQ17", "HQ15", "HQ14", "HQ5b2", "HQ5a", "HQR2bnew", "HQR1b", "HQH6a",
                    "HQH1b", "HQH1", "HQ4b1"]
RAW_CATEGORY_PAIRS = [("HQH11b_1", "HQH11b2"), ("HQH5m2_1", "HQH5m3"), ("HQH5b", "HQH5c2"),
                      ("HQH2new_1", "HQH2bnew"), ("HQH2_1", "HQH2b")]
SIGN_PAIR = ("HQH6a3", "HQH6a3part2_1")      # sign code column, magnitude column
SIGN_NEGATIVE_CODE = "3"
FALLBACK_COLUMNS = ("HQ1_1", "HQ1hidden_1", "HQ1b")   # primary, hidden, category
# -----------------------------------------------------------------------------

YEARS = "years"


def year_table() -> dict[str, float]:
    table = {YEAR_MISSING_CODE: float(YEAR_MISSING_VALUE),
             YEAR_BEFORE_CODE: float(YEAR_BEFORE_VALUE)}
    table.update({str(y): float(y) for y in range(YEAR_FIRST, YEAR_LAST + 1)})
    return table


@lru_cache(maxsize=None)
def _tables() -> dict[str, dict[str, float]]:
    out = {name: {str(code): float(v) for code, v in enumerate(values)}
           for name, values in MIDPOINTS.items()}
    out[YEARS] = year_table()
    hqh1 = {code: float(v) for code, v in HQH1_EXTRA.items()}
    hqh1.update(year_table())
    out["HQH1"] = hqh1
    return out


_OWN: dict[str, dict[str, float]] = {}


def register_table(name: str, values: dict[str, float]) -> None:
    """A caller's code table.  Codes must be texts and values finite numbers; a
    shipped table's name is refused."""
    if name in _tables():
        raise ValueError(f"code table {name!r} is shipped")
    if not values:
        raise ValueError(f"code table {name!r} is empty")
    for code, value in values.items():
        if not isinstance(code, str):
            raise ValueError(f"code {code!r} of table {name!r} is not text")
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
            raise ValueError(f"value {value!r} of code {code!r} in table {name!r} is not a finite number")
    _OWN[name] = {code: float(v) for code, v in values.items()}


def get_table(name: str) -> dict[str, float]:
    """Code -> value.  Unknown table names raise (a spec needs its table)."""
    found = _tables().get(name) or _OWN.get(name)
    if found is None:
        raise ValueError(f"no code table named {name!r}")
    return dict(found)


def value_text(v: float) -> str:
    """Cell text for a mapped value: integers without decimals."""
    return str(int(v)) if float(v).is_integer() else repr(float(v))


def recode_rows() -> list[tuple[str, str, float]]:
    """All tables in long form ``(table, code, value)``."""
    return [(name, code, value) for name, t in sorted((_tables() | _OWN).items())
            for code, value in t.items()]
