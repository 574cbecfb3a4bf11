"""Scalar column expressions (SC1-SC14), all native Catalyst expressions.

Every helper returns a ``Column``; nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def str_length(c: str | Column) -> Column:
    """SC1: length in characters."""
    return F.length(_c(c))


# fixed value: the title pattern (a word of letters followed by a period,
# preceded by a space)
TITLE_PATTERN = r" ([A-Za-z]+)\."


def regex_group(c: str | Column, pattern: str = TITLE_PATTERN, group: int = 1) -> Column:
    """SC2: first match's capture group, '' when absent."""
    return F.regexp_extract(_c(c), pattern, group)


# fixed value: leading capital letters of a cabin code
DECK_PATTERN = r"^[A-Z]+"


def regex_prefix(c: str | Column, pattern: str = DECK_PATTERN) -> Column:
    """SC3: whole match of an anchored pattern, '' when absent."""
    return F.regexp_extract(_c(c), pattern, 0)


def split_first(c: str | Column, delim: str = ",") -> Column:
    """SC4: text before the first delimiter (whole text if absent)."""
    return F.split_part(_c(c), F.lit(delim), F.lit(1))


def concat_key(*cols: str | Column) -> Column:
    """SC5: text key from mixed-type columns (numbers formatted as strings)."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def contains_flag(c: str | Column, needle: str = "/") -> Column:
    """SC6: 1 if the text contains ``needle`` else 0."""
    return _c(c).contains(needle).cast("int")


def parse_timestamp(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """SC7: text to TIMESTAMP_NTZ; unparsable text gives NULL."""
    # read without a zone; the zoned parse only tells whether the text can be read at all
    return F.when(F.try_to_timestamp(_c(c), F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(_c(c), F.lit(fmt)))


def date_parts(c: str | Column) -> dict[str, Column]:
    """SC8: hour (as Time), minute, day of month, month, year."""
    c = _c(c)
    return {"Time": F.hour(c), "Minute": F.minute(c), "Day": F.dayofmonth(c),
            "Month": F.month(c), "Year": F.year(c)}


def hour_band_flag(hour: str | Column) -> Column:
    """SC9: 1 for hour 0 or 8..23 (awake), else 0."""
    h = _c(hour)
    return ((h == 0) | h.between(8, 23)).cast("int")


# fixed values: month sets of the four season flags as written in the
# reference flow (December is in none; A8)
SEASONS = {"Summer": (5, 6, 7), "Fall": (8, 9, 10), "Winter": (11, 0, 1), "Spring": (2, 3, 4)}


def season_flags(month: str | Column, seasons: dict[str, tuple[int, ...]] = SEASONS) -> dict[str, Column]:
    """SC10/PR11: one 0/1 column per season by month membership."""
    m = _c(month)
    return {name: m.isin(*months).cast("int") for name, months in seasons.items()}


def safe_ln(x: str | Column) -> Column:
    """Natural log, NULL for x <= 0 (pandas gives -inf/NaN; A4)."""
    x = _c(x)
    return F.when(x > 0, F.ln(x))


def log_odds(p: str | Column) -> Column:
    """SC11: ln p - ln(1-p); NULL at p <= 0 or p >= 1."""
    p = _c(p)
    return safe_ln(p) - safe_ln(1 - p)


def neg_log10(p: str | Column) -> Column:
    """SC12: -log10(p), NULL for p <= 0."""
    p = _c(p)
    return F.when(p > 0, -F.log10(p))


def abs_value(c: str | Column) -> Column:
    """SC13."""
    return F.abs(_c(c))


def above(score: str | Column, threshold: float = 0.5) -> Column:
    """SC14: score > threshold (NULL score counts as False)."""
    return F.coalesce(_c(score) > threshold, F.lit(False))


def vote_and(a: str | Column, b: str | Column, threshold: float = 0.5) -> Column:
    """SC14/ML12: both scores above the threshold."""
    return above(a, threshold) & above(b, threshold)


def vote_or(a: str | Column, b: str | Column, threshold: float = 0.5) -> Column:
    """SC14/ML13: either score above the threshold."""
    return above(a, threshold) | above(b, threshold)
