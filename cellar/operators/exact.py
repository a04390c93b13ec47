"""Sums of doubles that do not depend on the order or the grouping of the rows.

A double is split into limbs, whole numbers below 2**18 kept as doubles, so adding
limbs is exact as long as fewer than 2**35 rows are added: partial sums of any
partitions merge to the same total, with Spark's own ``sum`` or ``Summarizer``.

* ``Cells``  for values of any size: a bin of limbs for every exponent (117 limbs);
  the total is the exact sum, rounded once.
* ``Fixed``  for columns of known largest value: three limbs a column, a grid of
  2**-54 of the column's power of two.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LIMB = 18
#: Limbs from 2**-1074 up to the largest double, and one place for NaN and infinities.
LIMBS = (1074 + 1024) // LIMB + 1
WIDTH = LIMBS + 1
_ONE = float(1 << LIMB)


def cell_sums(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """The limbs of the sum of ``values`` >= 0 in each group: (groups, ``WIDTH``)."""
    out = np.zeros((groups, WIDTH))
    finite = np.isfinite(values)
    if not finite.all():
        np.add.at(out[:, LIMBS], group[~finite], values[~finite])
        values, group = values[finite], group[finite]
    if not len(values):
        return out
    top = np.maximum((np.frexp(values)[1] + 1073) // LIMB, 0)
    rest = np.ldexp(values, 1074 - LIMB * top)
    flat = out.reshape(-1)
    for step in range(4):
        limb = np.floor(rest)
        at = group * WIDTH + np.maximum(top - step, 0)
        flat += np.bincount(at, weights=limb, minlength=len(flat))
        rest = (rest - limb) * _ONE
    return out


def cell_total(limbs: np.ndarray) -> float:
    """Limbs -> the sum, rounded once."""
    if limbs[LIMBS] != 0:  # NaN or infinite
        return float(limbs[LIMBS])
    whole = 0
    for i in np.flatnonzero(limbs):
        whole += int(limbs[i]) << (LIMB * int(i))
    try:
        return whole / (1 << 1074)
    except OverflowError:
        return float("inf")


@dataclass(frozen=True)
class Fixed:
    """The grid of each column: |value| <= 2**exponent."""
    exponent: np.ndarray

    @staticmethod
    def of(largest) -> "Fixed":
        """From the columns' largest absolute values."""
        return Fixed(np.frexp(np.maximum(np.asarray(largest, np.float64), 0.0))[1].astype(np.int64))

    def limbs(self, x: np.ndarray) -> np.ndarray:
        """(rows, d) -> (rows, 3 d): whole numbers; only the highest limb has a sign."""
        rest = np.ldexp(x, LIMB - self.exponent)
        out = np.empty((x.shape[0], 3, x.shape[1]))
        for i in range(3):
            out[:, i] = np.floor(rest)
            rest = (rest - out[:, i]) * _ONE
        return out.reshape(x.shape[0], -1)

    def mean(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Summed limbs (groups, 3 d) and counts -> means (groups, d)."""
        part = sums.reshape(len(sums), 3, -1)
        high, middle, low = part[:, 0], part[:, 1], part[:, 2]
        # carry upwards, so that equal sums have equal limbs
        carry = np.floor(low / _ONE)
        middle, low = middle + carry, low - carry * _ONE
        carry = np.floor(middle / _ONE)
        high, middle = high + carry, middle - carry * _ONE
        count = np.asarray(n, np.float64)[:, None]
        value = high / count + middle / (count * _ONE) + low / (count * _ONE * _ONE)
        return np.ldexp(value, self.exponent - LIMB)
