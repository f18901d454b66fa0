"""The 3-sigma ("usual") rule and the usual rate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SIGMAS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_usual(value, mean, sd, n, ddof: int) -> Column:
    """True when a reading lies within three standard deviations of its group.

    ``ddof=0`` (population sd, inclusive ``<=``): the bucket and device-type
    analyses.  ``sd = 0`` counts as usual: all readings are equal, but the
    mean of e.g. 0.1, 0.1, 0.1 is 0.10000000000000002 while the population sd
    is exactly 0, so a plain ``<=`` would lose the group.

    ``ddof=1`` (sample sd, strict ``<``): the recent analyses.  A group of one
    reading is usual (its sample sd is undefined; the reference's engine read
    it as NaN, and ``x < NaN`` holds); a group of equal readings is not."""
    dev = F.abs(_c(value) - _c(mean))
    if ddof == 0:
        return (_c(sd) == F.lit(0.0)) | (dev <= F.lit(float(SIGMAS)) * _c(sd))
    if ddof == 1:
        return (_c(n) == F.lit(1)) | (dev < F.lit(float(SIGMAS)) * _c(sd))
    raise ValueError("ddof must be 0 or 1")


def usual_rate(usual, count) -> Column:
    """Usual readings / readings, as a double."""
    return _c(usual).cast("double") / _c(count).cast("double")
