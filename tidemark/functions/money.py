"""Rounding that agrees with engines that round doubles half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Double to digits places; the plain round goes through decimal text and differs on binary halves."""
    scale = float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale
