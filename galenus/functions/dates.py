"""Dates, quarters, bounded numbers and release ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years of each age unit code (decade, year, month, week, day, hour).
AGE_UNITS = {"800": 10.0, "801": 1.0, "802": 1 / 12, "803": 7 / 365.25, "804": 1 / 365.25, "805": 1 / 8766}


def strict_date(value: Column) -> Column:
    """Eight digits as a date; else null."""
    return F.when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd"))


def parse_date(value: Column, order: str = "dmy") -> Column:
    """An ISO prefix, eight digits, or slashes in the declared order (dmy or mdy); else null."""
    v = F.trim(value)
    iso = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"))
    slash = F.when(v.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(v, "d/M/yyyy" if order == "dmy" else "M/d/yyyy"))
    return F.coalesce(iso, strict_date(v), slash)


def first_receipt(received: Column, receipt: Column) -> Column:
    return F.least(received, receipt)


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def measure(value: Column, most: float = 1e6) -> Column:
    """A number in [0, most); else null."""
    v = value.try_cast("double")
    return F.when((v >= 0) & (v < most), v)


def bounded_int(value: Column) -> Column:
    return F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(value).try_cast("int"))


def age_years(age: Column, unit: Column) -> Column:
    table = F.create_map(*(x for k, v in AGE_UNITS.items() for x in (F.lit(k), F.lit(v))))
    return measure(age) * F.try_element_at(table, unit)


def release_id(day: Column, cadence: str) -> Column:
    """monthly 2024-05, weekly (ISO) 2024-W07, daily 2024-05-31."""
    if cadence == "monthly":
        return F.date_format(day, "yyyy-MM")
    if cadence == "weekly":
        return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day))
    if cadence == "daily":
        return F.date_format(day, "yyyy-MM-dd")
    raise ValueError(f"unknown cadence {cadence!r}")


def interval_before(day: Column) -> Column:
    """Struct (start, end): the twelve months that end the day before; 29 February starts at 28 February."""
    return F.struct(F.add_months(day, -12).alias("start"), F.date_sub(day, 1).alias("end"))
