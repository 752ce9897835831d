"""Quarter arithmetic on an integer index, ``year * 4 + quarter - 1``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: what counts as a quarter inside a label (case is ignored)
QUARTER_PATTERN = r"(?i)(\d{4})\s*[- ]?Q\s*([1-4])"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quarter_index(label: Column | str) -> Column:
    """Index of the first quarter found in a label; NULL if there is none."""
    text = as_column(label)
    year = F.regexp_extract(text, QUARTER_PATTERN, 1).try_cast("int")
    quarter = F.regexp_extract(text, QUARTER_PATTERN, 2).try_cast("int")
    return year * 4 + quarter - 1


def quarter_label(index: Column | str) -> Column:
    """``8005`` -> ``2001Q2``."""
    i = as_column(index)
    place = F.pmod(i, F.lit(4))
    return F.concat(((i - place) / 4).cast("int").cast("string"), F.lit("Q"), (place + 1).cast("int").cast("string"))


def quarter_start(index: Column | str) -> Column:
    """First day of the quarter."""
    i = as_column(index)
    place = F.pmod(i, F.lit(4))
    return F.make_date(((i - place) / 4).cast("int"), (place * 3 + 1).cast("int"), F.lit(1))


def date_quarter_index(day: Column | str) -> Column:
    d = as_column(day)
    return F.year(d) * 4 + F.quarter(d) - 1


def add_quarters(label: Column | str, k: Column | int) -> Column:
    """Move a quarter label by ``k`` quarters; NULL if it has no quarter."""
    step = F.lit(k) if isinstance(k, int) else k
    return quarter_label(quarter_index(label) + step)


def quarter_diff(label: Column | str, origin: Column | str) -> Column:
    """How many quarters ``label`` lies after ``origin``."""
    return quarter_index(label) - quarter_index(origin)


def origin_quarter(version: Column | str) -> Column:
    """The part of ``2022Q4M1`` before the month."""
    return F.substring_index(as_column(version), "M", 1)


def origin_has_quarter(version: Column | str) -> Column:
    """Can the horizon be read from the label: a full quarter stands before the month."""
    return F.coalesce(origin_quarter(version).rlike(QUARTER_PATTERN), F.lit(False))


def label_is_parseable(version: Column | str) -> Column:
    """The looser test of the row removal: some digit stands before the first ``Q``."""
    return F.coalesce(as_column(version).rlike(r"^[^Q]*\d[^Q]*Q"), F.lit(False))
