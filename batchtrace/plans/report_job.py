"""The period report job: every report of a day or month written as CSV.

One directory per report and period (S8). The DLQ report is written only when
the period has dead letters; that test is a plain filter with a limit, which
stops at the first task that finds a row, and has no sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from batchtrace.functions.period import Period, as_period, row_limit
from batchtrace.operators import dlq as Q
from batchtrace.operators import reports as R
from batchtrace.plans.curated import Curated
from batchtrace.sinks.files import write_csv_report


def period_reports(c: Curated, period: Period | str, limit: int | None = None) -> dict[str, DataFrame]:
    p = as_period(period)
    return {
        "station": R.station_report(c.kitchen, p, limit),
        "recipe": R.recipe_report(c.kitchen, p, limit),
        "ingredient": R.ingredient_usage(c.kitchen, p, limit),
        "driver": R.driver_report(c.dispatch, p, limit),
        "canteen": R.canteen_report(c.dispatch, p, limit),
    }


def display_reports(c: Curated, period: Period | str, rows: object = None) -> dict[str, DataFrame]:
    """The reports cut to ``rows`` rows for display; no valid number means the default."""
    return period_reports(c, period, row_limit(rows))


def write_period_reports(c: Curated, period: Period | str, out_root: str) -> dict[str, str]:
    """Write all reports of the period; returns report name → directory."""
    p = as_period(period)
    kind = "daily" if p.kind == "day" else "monthly"
    written: dict[str, str] = {}
    for name, df in period_reports(c, p).items():
        path = f"{out_root}/{kind}/{kind}_{name}_{p.label}"
        write_csv_report(df, path)
        written[name] = path
    dlq = Q.dlq_report(c.dlq, p)
    if not Q.dated_in(c.dlq, p).isEmpty():
        path = f"{out_root}/{kind}/{kind}_dlq_{p.label}"
        write_csv_report(dlq, path)
        written["dlq"] = path
    if p.kind == "month":
        undated = Q.dlq_undated(c.dlq)
        if not Q.undated(c.dlq).isEmpty():
            path = f"{out_root}/unknown_timestamp_dlq"
            write_csv_report(undated, path)
            written["dlq_undated"] = path
    return written
