"""Week calendars. A calendar has one row per week, so global order over it is a small sort by meaning."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import iso_label, iso_month, iso_year, monday_sequence


def calendar_of(df: DataFrame, day: str) -> DataFrame:
    """One row per ISO week in which `day` occurs (aggregated on the map side, bounded by the date range)."""
    start = F.trunc(F.col(day).cast("date"), "week")
    return df.select(start.alias("week_start_date")).distinct().select(
        iso_label("week_start_date").alias("year_week"), "week_start_date",
        F.date_add("week_start_date", 6).alias("week_end_date"),
        iso_year("week_start_date").alias("year"), iso_month("week_start_date").alias("month"),
        monday_sequence("week_start_date").alias("week_seq"))


def broken_week(start: str = "week_start_date", end: str = "week_end_date") -> Column:
    """Not Monday to Sunday, or not seven days after the previous week."""
    previous = F.lag(start).over(Window.orderBy(start))
    return (
        (F.dayofweek(start) != 2)                                        # 2 = Monday
        | (F.datediff(end, start) != 6)
        | (previous.isNotNull() & (F.datediff(F.col(start), previous) != 7))
    )


def wrong_label(label: str = "year_week", start: str = "week_start_date") -> Column:
    """Label used twice, or not the ISO label of the start day."""
    twice = F.count("*").over(Window.partitionBy(label)) > 1
    return twice | (F.col(label) != iso_label(start))


def open_at(ingested: str, week_end: str) -> Column:
    """The row was ingested before its week was over."""
    return F.col(ingested) < F.to_timestamp(F.date_add(week_end, 1))


def weeks_per_month(df: DataFrame, year: str, month: str, name: str) -> DataFrame:
    return df.groupBy(F.format_string("%d-%02d", F.col(year), F.col(month)).alias("month_label")).agg(
        F.count("*").alias(name))


def compare_months(df: DataFrame) -> DataFrame:
    """Weeks per month before and after the ISO repair; full outer, 0 where a month is missing on one side."""
    before = weeks_per_month(df, "year_raw", "month_raw", "weeks_before")
    after = weeks_per_month(df, "year", "month", "weeks_after")
    return before.join(after, "month_label", "full").fillna({"weeks_before": 0, "weeks_after": 0})
