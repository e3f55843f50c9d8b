"""Calendar features as Column expressions.

Holiday and anchor tables are built per year from rules with DataFrame
expressions; their size is (number of years) x (rules), fixed by the
calendar span, so joins against them broadcast.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- F20-F24, F33, F34
def parse_date(col, fmt: str) -> Column:
    """``pd.to_datetime(c, format=...)`` (F20) with a Spark pattern, e.g. 'dd.MM.yyyy'."""
    return F.to_date(_c(col), fmt)


def date_parts(col) -> dict[str, Column]:
    """Year, month, day, day of year, quarter, hour, minute (F21), weekday
    with Monday = 0 (F22), month name (F23), weekend flag and 4-level
    weekday group Mon-Thu / Fri / Sat / Sun (F24), 'MM-dd' (F33) and days in
    month (F34)."""
    c = _c(col)
    d = F.to_date(c)
    wd = F.weekday(d)
    return {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "dayofyear": F.dayofyear(c),
        "quarter": F.quarter(c), "hour": F.hour(c), "minute": F.minute(c),
        "weekday": wd, "month_name": F.date_format(d, "MMMM"),
        "weekend": (wd >= 5).cast("int"),
        "weekday_group": F.when(wd <= 3, 0).when(wd == 4, 1).when(wd == 5, 2).otherwise(3),
        "mmdd": F.date_format(d, "MM-dd"),
        "days_in_month": F.dayofmonth(F.last_day(d)),
    }


def repair_day(year, month, day) -> Column:
    """Clip an impossible day of month (e.g. Feb 30) to the month's last day."""
    last = F.dayofmonth(F.last_day(F.make_date(_c(year), _c(month), F.lit(1))))
    return F.least(_c(day), last)


# ---------------------------------------------------------------- F25-F28
def cyclic(x, period: float) -> tuple[Column, Column]:
    """sin / cos of 2*pi*x/period."""
    a = _c(x) * F.lit(2 * math.pi / period)
    return F.sin(a), F.cos(a)


def fourier_terms(doy, k_max: int, period: float = 365.0) -> dict[str, Column]:
    """sin/cos(2*pi*k*doy/period) for k = 1..k_max (F25); multiply by a
    product indicator for interactions (F26)."""
    out = {}
    for k in range(1, k_max + 1):
        s, c = cyclic(_c(doy) * k, period)
        out[f"sin{k}"], out[f"cos{k}"] = s, c
    return out


def leap_aligned_doy(col) -> Column:
    """Day of year shifted by one after Feb 29 in leap years, so a date has
    the same index in every year (F27)."""
    d = F.to_date(_c(col))
    leap = F.dayofmonth(F.last_day(F.make_date(F.year(d), F.lit(2), F.lit(1)))) == 29
    return F.when(leap & (F.month(d) > 2), F.dayofyear(d) - 1).otherwise(F.dayofyear(d))


def keep_if_important(col, important_mmdd: list[str]) -> Column:
    """Day of year kept on listed 'MM-dd' days, 0 otherwise."""
    d = F.to_date(_c(col))
    return F.when(F.date_format(d, "MM-dd").isin(important_mmdd), F.dayofyear(d)).otherwise(0)


# ---------------------------------------------------------------- F29 Easter
def easter_date(year) -> Column:
    """Gregorian Easter Sunday (anonymous computus) as integer arithmetic."""
    y = _c(year).cast("int")

    def div(a, b):
        return F.floor(a / F.lit(b)).cast("int")

    a = y % 19
    b = div(y, 100)
    c = y % 100
    d = div(b, 4)
    e = b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = div(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = div(a + 11 * h + 22 * l_, 451)
    month = div(h + l_ - 7 * m + 114, 31)
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y, month, day)


def easter_offset(col) -> Column:
    """Days from that year's Easter Sunday (F29); flags are comparisons on it."""
    d = F.to_date(_c(col))
    return F.datediff(d, easter_date(F.year(d)))


def offset_flags(offset: Column, days: list[int], prefix: str) -> dict[str, Column]:
    """One 0/1 column per listed offset (F29, e.g. -5..4 and 40..47)."""
    return {f"{prefix}{'m' if d < 0 else ''}{abs(d)}": (offset == d).cast("int") for d in days}


# ---------------------------------------------------------------- F30-F31
def fixed_date_flags(col, month: int, days: list[int], prefix: str) -> dict[str, Column]:
    """``(month == m) & (day == d)`` flags."""
    c = _c(col)
    return {f"{prefix}{d}": ((F.month(c) == month) & (F.dayofmonth(c) == d)).cast("int") for d in days}


def last_weekday_of_month(year, month: int, dow: str) -> Column:
    """Last given weekday ('Mon'..'Sun') of a month, e.g. last Wed of June."""
    end = F.last_day(F.make_date(_c(year), F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(end, 7), dow)


def first_weekday_of_month(year, month: int, dow: str) -> Column:
    """First given weekday of a month, e.g. first Sunday of November."""
    start = F.make_date(_c(year), F.lit(month), F.lit(1))
    return F.next_day(F.date_sub(start, 1), dow)


def nth_weekday_of_month(year, month: int, dow: str, n: int) -> Column:
    return F.date_add(first_weekday_of_month(year, month, dow), 7 * (n - 1))


def season_windows(years: DataFrame) -> DataFrame:
    """Per-year interval table (J14): Christmas season Dec 15-31 and the
    Black Friday weekend (Friday after the 4th Thursday of November through
    Monday).  Input: one ``year`` column (e.g. distinct years of the data)."""
    y = F.col("year")
    bf = F.date_add(nth_weekday_of_month(y, 11, "Thu", 4), 1)
    xmas = years.select(y, F.lit("xmas").alias("window"), F.make_date(y, F.lit(12), F.lit(15)).alias("start"),
                        F.make_date(y, F.lit(12), F.lit(31)).alias("end"))
    bfw = years.select(y, F.lit("black_friday").alias("window"), bf.alias("start"), F.date_add(bf, 3).alias("end"))
    return xmas.unionByName(bfw)


# ---------------------------------------------------------------- J15 holiday calendar
# Holiday rules per region key (region, month, day, name); a
# rule with month 0 is an offset in days from Easter Sunday.
HOLIDAY_RULES = [
    (0, 1, 1, "New Year"), (1, 1, 1, "New Year"), (2, 1, 1, "New Year"), (3, 1, 1, "New Year"),
    (4, 1, 1, "New Year"), (1, 1, 1, "Founders Day"), (1, 7, 4, "Independence Day"),
    (3, 5, 1, "Labour Day"), (3, 0, -2, "Good Friday"), (3, 0, 1, "Easter Monday"),
    (3, 0, 39, "Ascension"), (3, 0, 50, "Whit Monday"), (0, 12, 25, "Christmas"),
    (1, 12, 25, "Christmas"), (3, 12, 25, "Christmas"), (3, 12, 26, "Boxing Day"),
    (2, 10, 1, "National Day"), (4, 3, 21, "Nowruz"),
]


def holiday_table(years: DataFrame) -> DataFrame:
    """(n_regionkey, date, holiday) for every year in ``years`` from
    ``HOLIDAY_RULES``: one explode of the literal rule list per year (rows =
    years x rules, fixed by the calendar span); Easter-relative rules use the
    computus."""
    rules = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("n"))
                      for r, m, d, n in HOLIDAY_RULES])
    y = F.col("year")
    x = years.select(y, F.explode(rules).alias("h"))
    date = F.when(F.col("h.m") == 0, F.date_add(easter_date(y), F.col("h.d"))) \
        .otherwise(F.make_date(y, F.col("h.m"), F.col("h.d")))
    return x.select(F.col("h.r").alias("n_regionkey"), date.alias("date"), F.col("h.n").alias("holiday"))


# ---------------------------------------------------------------- F32 year-dated lookup
def yearly_lookup(df: DataFrame, table: DataFrame, keys: list[str], date_col: str, value: str,
                  log: bool = True) -> DataFrame:
    """Join a (keys..., year, value) table on the row's year (F32), with an
    optional natural log; the table has one row per key and year."""
    d = df.withColumn("year", F.year(date_col))
    out = d.join(table, [*keys, "year"], "left")
    return out.withColumn(f"{value}_log", F.ln(value)) if log else out
