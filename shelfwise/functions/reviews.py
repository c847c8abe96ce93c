"""Parsing of the textual review fields. Bad text gives null, never an error."""

from pyspark.sql import Column, functions as F

# The accepted month names, in full or by their first three letters.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
_NAMES = MONTHS + [m[:3] for m in MONTHS]
# Fixed value: "month day, year", blanks before a number allowed, anything after it ignored.
DATE_PATTERN = r"(?s)^[ \t]*([A-Za-z]+) [ \t]*(-?\d+), [ \t]*(-?\d+)"
# Fixed value: the rating text that stands for "no rating".
NO_RATING = "None"

# Days from 1970 that a timestamp of microseconds can hold in any time zone, and years around them.
_TIMESTAMP_DAYS = 106_751_988
_TIMESTAMP_YEARS = 292_300


def date_parts(text: Column) -> list[Column]:
    """``name, day, year`` of a date text: the place of the month's name in ``_NAMES`` from 1, 0 where it
    is none, and two numbers. Text of another form has name 0."""
    word, day, year = (F.regexp_extract(text, DATE_PATTERN, i) for i in (1, 2, 3))
    name = F.find_in_set(F.lower(word), F.lit(",".join(_NAMES)))
    return [name.alias("name"), day.try_cast("bigint").alias("day"), year.try_cast("bigint").alias("year")]


def date_of(name: Column, day: Column, year: Column) -> tuple[Column, Column]:
    """``accepted`` and ``date`` of ``parsed_date``, from the columns of ``date_parts``."""
    accepted = F.coalesce(name > 0, F.lit(False))
    month = F.when(name > 0, (name - 1) % len(MONTHS) + 1).cast("int")
    near = F.when(year.between(-_TIMESTAMP_YEARS, _TIMESTAMP_YEARS), year.cast("int"))
    first = F.unix_date(F.make_date(near, month, F.lit(1)))
    close = day.between(-2 * _TIMESTAMP_DAYS, 2 * _TIMESTAMP_DAYS)
    number = F.when(accepted & close, first + day - 1)
    held = F.when(number.between(-_TIMESTAMP_DAYS, _TIMESTAMP_DAYS), number.cast("int"))
    return accepted.alias("accepted"), F.date_from_unix_date(held).cast("timestamp").alias("date")


def parsed_date(text: Column) -> Column:
    """A struct: ``accepted``, whether the text is a "February 03, 2010" style date, and ``date``,
    its midnight in the session's time zone.

    Days past the end of a month roll over into the next one (February 30 is March 1 or 2), years
    may be zero or negative. An accepted date that no timestamp can hold is null. Over many rows
    ``date_parts`` and then ``date_of`` cost a fraction of this, which has to be one expression.
    """
    return _bound(F.struct(*date_parts(text)), lambda x: F.struct(*date_of(x["name"], x["day"], x["year"])))


def review_date(text: Column) -> Column:
    """The date of ``parsed_date``; null also for text that is no date."""
    return parsed_date(text)["date"]


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def review_rating(text: Column) -> Column:
    """The rating as a double. Null for "None" and for text that is no number.

    The cast also takes spellings such as "inf" and "nan" that are not numbers in review files.
    """
    loose = text.rlike(r"(?i)^[\x00-\x20]*([+-]?inf(inity)?|[+-]?nan)[\x00-\x20]*$")
    strict = text.rlike(r"^[\x00-\x20]*[+-]?(Infinity|NaN)[\x00-\x20]*$")
    return F.when(~loose | strict, text.try_cast("double"))


def rating_is_acceptable(text: Column) -> Column:
    """False for a review that has to be dropped for its rating text."""
    return F.coalesce((text == NO_RATING) | review_rating(text).isNotNull(), F.lit(False))
