"""Array helpers with Go-slice index semantics (R1–R7), as native expressions.

Indexes are 0-based and ranges half-open, as in ``a[lo:hi]``. Where Go
panics on an out-of-range index these return null instead of raising, so
one bad row does not fail a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def array_slice(a, lo, hi) -> Column:
    """``a[lo:hi]``; null when ``lo < 0``, ``lo > hi`` or ``hi > len(a)``."""
    a, lo, hi = _c(a), _c(lo), _c(hi)
    ok = (lo >= 0) & (lo <= hi) & (hi <= F.size(a))
    # slice() is 1-based with a length; a zero length gives [].
    return F.when(ok, F.slice(a, lo + 1, hi - lo))


def head(a, n) -> Column:
    """``a[:n]``."""
    return array_slice(a, 0, n)


def tail_from(a, lo) -> Column:
    """``a[lo:]``."""
    return array_slice(a, lo, F.size(_c(a)))


def append(a, x) -> Column:
    """``append(a, x)``."""
    return F.array_append(_c(a), _c(x))


def prepend(a, x) -> Column:
    """``append([]T{x}, a...)``."""
    return F.array_prepend(_c(a), _c(x))


def concat(a, b) -> Column:
    """``append(a, b...)``."""
    return F.concat(_c(a), _c(b))


def replace_at(a, i, x) -> Column:
    """A copy of ``a`` with ``a[i] = x``; null when ``i`` is out of range."""
    a, i, x = _c(a), _c(i), _c(x)
    return F.when((i >= 0) & (i < F.size(a)), F.transform(a, lambda v, j: F.when(j == i, x).otherwise(v)))


def length(a) -> Column:
    """``len(a)``."""
    return F.size(_c(a))


def last(a) -> Column:
    """``a[len(a)-1]``; null for an empty array."""
    return F.try_element_at(_c(a), F.lit(-1))


def at(a, i) -> Column:
    """``a[i]``; null out of range (``a[i]`` raises under ANSI)."""
    return F.get(_c(a), _c(i))
