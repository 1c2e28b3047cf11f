"""Date helpers. "Today" is always a parameter."""
import calendar
import datetime as dt

from pyspark.sql import Column, functions as F

# Mean length of a month in days, report date format.
DAYS_PER_MONTH = 30.436875
REPORT_DATE_FORMAT = "dd-MMM-yyyy"
DEFAULT_BIRTH_DATE = "1970-10-10"


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def shift_months(value, months: int) -> dt.date:
    """Calendar shift; the day is held inside the target month."""
    d = as_date(value)
    index = d.year * 12 + d.month - 1 + months
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, min(d.day, calendar.monthrange(year, month + 1)[1]))


def month_window(year: int, month: int) -> tuple:
    first = dt.date(year, month, 1)
    return first, dt.date(year, month, calendar.monthrange(year, month)[1])


def fractional_months(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(DAYS_PER_MONTH)


def age_years(birth: Column, as_of) -> Column:
    return F.floor(F.datediff(F.lit(as_date(as_of)), birth) / F.lit(365))


def plausible_birth_date(birth: Column, as_of, low: int = 18, high: int = 99) -> Column:
    age = age_years(birth, as_of)
    default = F.lit(as_date(DEFAULT_BIRTH_DATE))
    return F.when(birth.isNull() | (age < low) | (age > high), default).otherwise(birth)


def report_date(c: Column) -> Column:
    return F.date_format(c, REPORT_DATE_FORMAT)


def local_time(c: Column, zone: str = "Africa/Nairobi") -> Column:
    return F.from_utc_timestamp(c, zone)
