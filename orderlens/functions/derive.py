"""Scalar column functions: unit conversions, ratios, time gaps, flags and bins.

All are built-in Spark expressions, so they stay inside whole-stage codegen. Division goes
through ``try_divide`` (null on zero, as the source data assumes) because ANSI mode is on.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The weekend days as ``dayofweek`` numbers them (Sun=1 ... Sat=7). The source
# computes ``dayofweek >= 6`` (Friday and Saturday) while meaning Saturday and Sunday.
WEEKEND_DAYS = (1, 7)
SOURCE_WEEKEND_DAYS = (6, 7)
SECONDS_PER_HOUR = 3600


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_metres(df: DataFrame, cols: Iterable[str], suffix: str = "_cm") -> DataFrame:
    """``x_cm`` -> ``x`` in metres; the centimetre column is dropped."""
    cols = list(cols)
    out = df.withColumns({c[: -len(suffix)]: F.col(c) / 100 for c in cols})
    return out.drop(*cols)


def volume_m3(length_cm: ColumnOrName, height_cm: ColumnOrName, width_cm: ColumnOrName, scale: int = 2) -> Column:
    """Volume in m^3 from centimetres, rounded half-up.

    The product is taken in cm^3 as doubles (exact for integer sizes up to 2^53, no integer
    overflow) and divided once, so values that sit exactly on a rounding boundary round the same
    way on every engine.
    """
    cm3 = _col(length_cm).cast("double") * _col(height_cm) * _col(width_cm)
    return F.round(cm3 / 1_000_000, scale)


def to_kg(grams: ColumnOrName, scale: int = 2) -> Column:
    return F.round(_col(grams) / 1000, scale)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int | None = 2) -> Column:
    """``num / den``, null when ``den`` is 0 or null; rounded half-up unless ``scale`` is None."""
    ratio = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return ratio if scale is None else F.round(ratio, scale)


def hours_between(end: ColumnOrName, start: ColumnOrName, scale: int = 2) -> Column:
    """Whole-second gap in hours, rounded; negative when ``end`` is earlier; null if either is."""
    seconds = F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))
    return F.round(seconds / SECONDS_PER_HOUR, scale)


def weekend_flag(ts: ColumnOrName, days: Sequence[int] = WEEKEND_DAYS) -> Column:
    """1 when the day falls on ``days`` (``dayofweek`` numbering), else 0; null -> 0."""
    return F.when(F.dayofweek(_col(ts)).isin(list(days)), 1).otherwise(0)


def threshold_flag(c: ColumnOrName, above: float = 1) -> Column:
    """``(c > above)`` as 0.0/1.0 (null stays null)."""
    return (_col(c) > above).cast("double")


def binary_target(score: ColumnOrName, cut: float = 4) -> Column:
    """1 when the score is at least ``cut``, else 0; null or unparsable text -> 0."""
    return F.when(_col(score).try_cast("double") >= cut, 1).otherwise(0)


def bin3(c: ColumnOrName, lo: float, hi: float, labels: Sequence[str]) -> Column:
    """Three bins: ``<= lo``, ``<= hi``, else; edges go to the lower bin, null to the last."""
    low, mid, high = labels
    x = _col(c)
    return F.when(x <= lo, low).when(x <= hi, mid).otherwise(high)


# The three bin definitions (input mean, edges, labels).
PHOTO_BINS = ("mean_photo", 5, 15, ("Minimal", "Moderate", "Abundant"))
NAME_BINS = ("mean_name", 20, 50, ("Short name", "Medium name", "Long name"))
DESCRIPTION_BINS = (
    "mean_description",
    500,
    1500,
    ("Short description", "Medium description", "Long description"),
)
BINS = {"nbr_photo": PHOTO_BINS, "name_length": NAME_BINS, "description_length": DESCRIPTION_BINS}
