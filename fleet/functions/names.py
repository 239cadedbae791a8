"""Names, paths and formatted times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The folder pattern of image labels and the two time formats of run and lineage names.
LABEL_PATTERN = "flower_photos/([^/]+)"
RUN_DATE_FORMAT = "yyMMdd"
LINEAGE_TIME_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def label_from_path(path: Column | str, pattern: str = LABEL_PATTERN) -> Column:
    """The first capture of ``pattern`` in a path, empty when it does not match."""
    return F.regexp_extract(path, pattern, 1)


def composite_key(*columns: Column | str) -> Column:
    """Values of several columns joined by an underscore."""
    return F.concat_ws("_", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])


def numbered_name(prefix: str, number: Column, width: int = 2) -> Column:
    """``prefix`` and the number, zero-padded to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def last_part(name: Column) -> Column:
    return F.element_at(F.split(name, "[.]"), -1)


def as_path(name: Column) -> Column:
    return F.replace(name, F.lit("."), F.lit("/"))


def run_date(time: Column) -> Column:
    return F.date_format(time, RUN_DATE_FORMAT)


def lineage_time(time: Column) -> Column:
    return F.date_format(time, LINEAGE_TIME_FORMAT)
