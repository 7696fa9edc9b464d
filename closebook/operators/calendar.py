"""Literal calendar: what a date means to the close, worked out once for each day.

Cash flows carry dates as integers ``YYYYMMDD``. Month end, year and both period
labels are columns of a small table keyed by that integer, so a cash flow looks them
up instead of computing them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions import dates
from closebook.params import CloseParams

DAY, MONTH_END, YEAR, BY_WINDOW, BY_YEAR = "ymd", "month_end", "year", "by_window", "by_year"


def calendar(spark: SparkSession, params: CloseParams = CloseParams()) -> DataFrame:
    """One row for each day of the parameters' calendar years, and one for the open end.

    A literal table: it starts no job, and its rows follow from the years alone.
    """
    first, last = (dt.date(year, 1, 1) for year in (params.calendar_years[0], params.calendar_years[1] + 1))
    days = spark.range((last - first).days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    days = days.unionByName(spark.range(1).select(F.lit(params.open_end).alias("day")))
    days = days.select("day", dates.to_int(F.col("day")).alias(DAY))
    month_end, ymd = dates.align_month_end(F.col("day")), F.col(DAY)
    return days.select(
        DAY,
        month_end.alias(MONTH_END),
        F.year(month_end).alias(YEAR),
        dates.bucket_by_window(ymd, params).alias(BY_WINDOW),
        dates.bucket_by_year(ymd, params).alias(BY_YEAR),
    )


def look_up(
    df: DataFrame, column: str, wanted: Mapping[str, str], params: CloseParams = CloseParams()
) -> DataFrame:
    """``df`` with the ``wanted`` calendar columns (new name to column) of the day in ``column``.

    A null day has none. A day that is not in the calendar is an error, be it impossible
    or outside the parameters' years: a cash flow without a period would vanish unseen.
    """
    known = calendar(df.sparkSession, params).select(
        F.col(DAY).alias("_day"), *[F.col(of).alias(f"_c_{new}") for new, of in wanted.items()]
    )
    joined = df.join(known, F.col(column) == F.col("_day"), "left")
    first = next(iter(wanted))
    return joined.withColumns(
        {new: _there(F.col(f"_c_{new}"), column) if new == first else F.col(f"_c_{new}") for new in wanted}
    ).drop("_day", *[f"_c_{new}" for new in wanted])


def _there(found: Column, column: str) -> Column:
    lost = F.col("_day").isNull() & F.col(column).isNotNull()
    text = F.concat(F.lit(f"{column} is no day of the calendar: "), F.col(column).cast("string"))
    return F.when(lost, F.raise_error(text)).otherwise(found)
