"""Report periods (a day or a month) and parameter checks."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_MONTH = re.compile(r"^\d{4}-\d{2}$")

DEFAULT_ROW_LIMIT = 5


@dataclass(frozen=True)
class Period:
    """Half-open date range ``[start, end)`` with a label.

    A day filter is an equality and a month filter is a range on the stored
    ``event_date`` column, so both prune date partitions and push down to the
    Parquet scan (unlike ``year(..) = y and month(..) = m``).
    """

    kind: str
    start: date
    end: date
    label: str

    @classmethod
    def day(cls, text: str) -> "Period":
        if not isinstance(text, str) or not _DAY.match(text.strip()):
            raise ValueError(f"day must be YYYY-MM-DD, got {text!r}")
        d = datetime.strptime(text.strip(), "%Y-%m-%d").date()
        return cls("day", d, date.fromordinal(d.toordinal() + 1), d.isoformat())

    @classmethod
    def month(cls, year: int | str, month: int | None = None) -> "Period":
        if month is None:
            text = str(year).strip()
            if not _MONTH.match(text):
                raise ValueError(f"month must be YYYY-MM, got {year!r}")
            d = datetime.strptime(text, "%Y-%m").date()
        else:
            if not 1 <= int(month) <= 12:
                raise ValueError(f"month out of range: {month!r}")
            d = date(int(year), int(month), 1)
        nxt = date(d.year + (d.month == 12), d.month % 12 + 1, 1)
        return cls("month", d, nxt, f"{d.year:04d}-{d.month:02d}")

    @classmethod
    def parse(cls, text: str) -> "Period":
        """``YYYY-MM-DD`` → day, ``YYYY-MM`` → month."""
        t = str(text).strip()
        return cls.day(t) if _DAY.match(t) else cls.month(t)

    def contains(self, col: Column | str = "event_date") -> Column:
        c = F.col(col) if isinstance(col, str) else col
        if self.kind == "day":
            return c == F.lit(self.start)
        return (c >= F.lit(self.start)) & (c < F.lit(self.end))


def as_period(p: Period | str) -> Period:
    return p if isinstance(p, Period) else Period.parse(p)


def require_id(value: str, what: str = "id") -> str:
    """A non-empty, stripped identifier."""
    if value is None or not str(value).strip():
        raise ValueError(f"{what} must not be empty")
    return str(value).strip()


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an ordered frame; all of them for None."""
    return df if limit is None else df.limit(limit)


def row_limit(value, default: int = DEFAULT_ROW_LIMIT) -> int:
    """A display row limit; anything that is not a positive integer → default."""
    try:
        n = int(value)
    except (TypeError, ValueError):
        return default
    return n if n > 0 else default
