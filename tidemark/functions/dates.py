"""Collection dates in free-text headers, and calendar bins, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earliest plausible collection year by virus code.
MIN_YEAR = {"SCV2": 2019, "HIV": 1980, "IAV": 1900}
DEFAULT_MIN_YEAR = 1950
#: Fixed patterns of dates in headers.
FULL_DATE = r"(?<![\d/])(?:19|20)\d{2}-\d{1,2}(?:-\d{1,2})?(?!\d)"
STRAIN_YEAR = r"/((?:19|20)\d{2})(?=\D|$)"
BARE_YEAR = r"(?<![\w/])((?:19|20)\d{2})(?!\d)"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normal_date(year: Column, month: Column, day: Column) -> Column:
    """struct(year, month): month 0 is unknown, and so is day 0; null if month or day is out of range."""
    month_known = F.when(month == 0, None).otherwise(month)
    ok = (month_known.isNull() | month.between(1, 12)) & (day.isNull() | (month == 0) | day.between(0, 31))
    return F.when(ok, F.struct(year.alias("year"), month_known.alias("month")))


def _read(found: Column) -> Column:
    part = F.split(found, "-")
    number = [F.get(part, k).cast("int") for k in range(3)]
    return normal_date(*number)


def parse_date(header) -> Column:
    """struct(year int, month int) of a header; both null if it has no date.

    The first valid full date (YYYY-MM or YYYY-MM-DD), looked for in the first, the last, then the middle |-fields; else the last
    /YYYY; else the first bare year."""
    header = _col(header)
    fields = F.transform(F.split(header, r"\|", -1), lambda f: F.trim(f))
    n = F.size(fields)
    order = F.when(n > 1, F.concat(F.slice(fields, 1, 1), F.slice(fields, -1, 1), F.slice(fields, F.lit(2), F.greatest(n - 2, F.lit(0))))).otherwise(fields)
    found = F.flatten(F.transform(order, lambda f: F.regexp_extract_all(f, F.lit(FULL_DATE), 0)))
    full = F.get(F.filter(F.transform(found, _read), lambda d: d.isNotNull()), F.lit(0))
    strain = F.regexp_extract_all(header, F.lit(STRAIN_YEAR), 1)
    bare = F.nullif(F.regexp_extract(header, BARE_YEAR, 1), F.lit(""))
    year = F.coalesce(F.when(F.size(strain) > 0, F.element_at(strain, -1)), bare).cast("int")
    return F.coalesce(full, F.struct(year.alias("year"), F.lit(None).cast("int").alias("month")))


def yearly_label(year, start: int) -> Column:
    """`before START`, the year, or `unknown`."""
    year = _col(year)
    return F.when(year.isNull(), "unknown").when(year < start, f"before {start}").otherwise(year.cast("string"))


def monthly_label(year, month, start: int | None = None) -> Column:
    """YYYY-MM, YYYY-unknown or `unknown`; years before start (if given) are `unknown`, so they stay in the count."""
    year, month = _col(year), _col(month)
    known = year.isNotNull() if start is None else year.isNotNull() & (year >= start)
    return F.when(~known, "unknown").when(month.isNull(), F.format_string("%04d-unknown", year)).otherwise(F.format_string("%04d-%02d", year, month))


def calendar(start: int, end: int, monthly: bool) -> list[str]:
    """All labels of an axis in their order."""
    if not monthly:
        return [f"before {start}", *map(str, range(start, end + 1)), "unknown"]
    return [label for y in range(start, end + 1) for label in (*(f"{y}-{m:02d}" for m in range(1, 13)), f"{y}-unknown")] + ["unknown"]


def label_valid(label, monthly: bool, min_year: int | Column, max_year: int | None = None) -> Column:
    """Whether a column label is a plausible date bin; max_year: next year if not given."""
    label = _col(label)
    shape = r"^(19|20)\d{2}-(0[1-9]|1[0-2])$" if monthly else r"^(19|20)\d{2}$"
    top = F.year(F.current_date()) + 1 if max_year is None else F.lit(max_year)
    year = F.when(label.rlike(shape), F.substring(label, 1, 4).cast("int"))
    return F.coalesce(year.between(F.lit(min_year), top), F.lit(False))


def label_order(label: str) -> tuple[int, str]:
    """Sort key of bin columns: before, dates, unknown, Count."""
    return (0 if label.startswith("before") else 2 if label == "unknown" else 3 if label == "Count" else 1, label)
