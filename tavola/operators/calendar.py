"""Fiscal calendar: 13 periods x 4 weeks per 364-day year (DT-06, DT-09..12).

The calendar is a dimension with one row per day, so its size is bounded by
the covered span (about 365 rows a year) and it is always safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.functions.dates import shift_date_text
from tavola.functions.util import as_col

DAYS_PER_YEAR = 364
DAYS_PER_PERIOD = 28
DAYS_PER_WEEK = 7


FISCAL_NAMES = ("date", "dow", "week", "period", "quarter", "year", "week_index", "period_index",
                "week_start", "week_end", "period_start", "period_end", "quarter_start",
                "quarter_end", "year_start", "year_end")


def fiscal_columns(date_col, epoch: str) -> list[Column]:
    """Calendar attributes of a DATE column, relative to fiscal day 0."""
    d = as_col(date_col)
    e = F.to_date(F.lit(epoch))
    n = F.datediff(d, e)
    year0 = F.year(e)
    in_year = F.pmod(n, F.lit(DAYS_PER_YEAR))
    period = F.floor(in_year / DAYS_PER_PERIOD).cast("int") + 1
    dow = F.pmod(n, F.lit(DAYS_PER_WEEK)).cast("int") + 1
    quarter = F.least(F.floor((period - 1) / 3).cast("int") + 1, F.lit(4))
    year_start = F.date_sub(d, in_year)
    return [
        d.alias("date"),
        dow.alias("dow"),
        (F.floor(F.pmod(n, F.lit(DAYS_PER_PERIOD)) / DAYS_PER_WEEK).cast("int") + 1).alias("week"),
        period.alias("period"),
        quarter.alias("quarter"),
        (year0 + F.floor(n / DAYS_PER_YEAR)).cast("int").alias("year"),
        F.floor(n / DAYS_PER_WEEK).cast("int").alias("week_index"),
        F.floor(n / DAYS_PER_PERIOD).cast("int").alias("period_index"),
        F.date_sub(d, dow - 1).alias("week_start"),
        F.date_add(d, 7 - dow).alias("week_end"),
        F.date_sub(d, F.pmod(n, F.lit(DAYS_PER_PERIOD)).cast("int")).alias("period_start"),
        F.date_add(F.date_sub(d, F.pmod(n, F.lit(DAYS_PER_PERIOD)).cast("int")),
                   DAYS_PER_PERIOD - 1).alias("period_end"),
        F.date_add(year_start, (quarter - 1) * 3 * DAYS_PER_PERIOD).alias("quarter_start"),
        F.when(quarter < 4, F.date_add(year_start, quarter * 3 * DAYS_PER_PERIOD - 1))
         .otherwise(F.date_add(year_start, DAYS_PER_YEAR - 1)).alias("quarter_end"),
        year_start.alias("year_start"),
        F.date_add(year_start, DAYS_PER_YEAR - 1).alias("year_end"),
    ]


def fiscal_calendar(spark: SparkSession, epoch: str, days: int) -> DataFrame:
    """DT-12 generator: ``days`` consecutive days from ``epoch``."""
    return (spark.range(0, days, numPartitions=1)
            .select(F.date_add(F.to_date(F.lit(epoch)), F.col("id").cast("int")).alias("d"))
            .select(*fiscal_columns("d", epoch)))


def calendar_for(df: DataFrame, date_col: str, epoch: str) -> DataFrame:
    """DT-06 + DT-12: the calendar over the date span present in ``df``.

    One aggregate (min/max) over the column, then one generated row per day;
    the result has one row per day of the span, independent of row count.
    """
    span = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*fiscal_columns("d", epoch))


def calendar_weeks(df: DataFrame, date_col: str, epoch: str) -> DataFrame:
    """The calendar of all whole fiscal weeks that hold a date of ``df``'s span."""
    e = F.to_date(F.lit(epoch))
    def into_week(d):
        return F.pmod(F.datediff(d, e), F.lit(DAYS_PER_WEEK)).cast("int")
    span = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    days = span.select(F.explode(F.sequence(F.date_sub("lo", into_week(F.col("lo"))),
                                            F.date_add("hi", 6 - into_week(F.col("hi"))))).alias("d"))
    return days.select(*fiscal_columns("d", epoch))


def date_series(df_or_spark, start, end) -> DataFrame:
    """DT-06: inclusive series of dates as a one-column DataFrame."""
    spark = df_or_spark if isinstance(df_or_spark, SparkSession) else df_or_spark.sparkSession
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("date"))


def fiscal_week_index(epoch: str, year: int, period: int, week: int) -> int:
    """DT-09: index of a fiscal week since the epoch (52 weeks a year, 4 a period)."""
    return (year - int(epoch[:4])) * 52 + (period - 1) * 4 + week - 1


def week_end(cal: DataFrame, year: int, period: int, week: int) -> DataFrame:
    """DT-09: last day (dow = 7) of a fiscal week with its indexes."""
    return (cal.filter((F.col("year") == year) & (F.col("period") == period) &
                       (F.col("week") == week) & (F.col("dow") == 7))
               .select("date", "week_index", "period_index"))


def fiscal_of(df: DataFrame, date_col: str, cal: DataFrame,
              cols=("dow", "week", "period", "year", "week_index", "period_index")) -> DataFrame:
    """DT-09: attach fiscal attributes to the rows of ``df`` by date."""
    c = cal.select(F.col("date").alias("_cal_date"), *cols)
    return (df.join(F.broadcast(c), F.to_date(F.col(date_col)) == F.col("_cal_date"), "left")
              .drop("_cal_date"))


def fiscal_range(cal: DataFrame, year: int, period: int | None = None,
                 week: int | None = None) -> DataFrame:
    """DT-10: (start, end) of a fiscal year, period or week - by name and
    min/max, not by row position."""
    cond = F.col("year") == year
    if period is not None:
        cond = cond & (F.col("period") == period)
    if week is not None:
        cond = cond & (F.col("week") == week)
    return cal.filter(cond).agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))


def prior_week_end(cal: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """DT-11: for each date, the last day of the previous fiscal week."""
    wk = cal.select(F.col("date").alias("_d"), "week_index")
    ends = cal.filter(F.col("dow") == 7).select(
        (F.col("week_index") + 1).alias("week_index"), F.col("date").alias("prior_week_end"),
        F.col("year").alias("prior_year"), F.col("period").alias("prior_period"),
        F.col("week").alias("prior_week"))
    return (dates.join(F.broadcast(wk), F.to_date(F.col(date_col)) == F.col("_d"), "left")
                 .join(F.broadcast(ends), "week_index", "left")
                 .drop("_d"))


CALENDAR_DATE_COLUMNS = ("date", "week_start", "week_end", "period_start", "period_end",
                         "quarter_start", "quarter_end", "year_start", "year_end")


def roll_calendar(cal_text: DataFrame, days: int = DAYS_PER_YEAR, fmt: str = "MM/dd/yy",
                  date_cols=CALENDAR_DATE_COLUMNS) -> DataFrame:
    """DT-12 roll-forward: next fiscal year from this one - year + 1 and every
    date column (text in ``fmt``) moved by 364 days; text that is not a date
    passes through. Other columns are kept."""
    out = cal_text.withColumn("year", F.col("year") + 1)
    for c in date_cols:
        if c in cal_text.columns:
            out = out.withColumn(c, shift_date_text(c, days, fmt))
    return out


def calendar_as_text(cal: DataFrame, fmt: str = "MM/dd/yy",
                     date_cols=CALENDAR_DATE_COLUMNS) -> DataFrame:
    """Render the date columns as text (the CSV form of the calendar)."""
    return cal.select(*[F.date_format(c, fmt).alias(c) if c in date_cols else F.col(c)
                        for c in cal.columns])
