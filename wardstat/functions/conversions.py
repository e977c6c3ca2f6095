"""Text to number and text to date. A bad value gives null in either ANSI mode."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

# The number forms that serving accepts. Spark alone would also
# take Java forms such as 1d or 0x1p3.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"

# A date with a time of day after it.
TIMESTAMP = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
             r"(Z|[+-][0-9]{2}:?[0-9]{2})?$")


def to_double(col):
    return col.try_cast("double")


def to_number(col, data_type=None):
    """Coerce to double the way serving does: what is no number, or is too large
    for a double, is null."""
    if isinstance(data_type, T.NumericType):
        value = col.cast("double")
        return F.when(~F.isnan(value), value)
    text = col.cast("string")
    value = text.try_cast("double")
    finite = text.rlike(PLAIN_NUMBER) & (F.abs(value) < float("inf"))
    return F.when(finite | text.rlike(INFINITE), value)


def to_work_date(col, data_type=None):
    """Accept ``yyyyMMdd`` (text or integer), ``yyyy-MM-dd``, either alone or, the
    latter, with a time of day, dates and timestamps. All else is null. The form
    is chosen by the length: a parser that fails costs far more than one that fits."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    text = F.trim(col.cast("string"))
    size = F.length(text)
    return (F.when(size == 8, F.try_to_date(text, "yyyyMMdd"))
            .when(size == 10, F.try_to_date(text, "yyyy-MM-dd"))
            .when(text.rlike(TIMESTAMP), F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")))
