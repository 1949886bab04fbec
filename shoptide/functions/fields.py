"""Masking, ages, document ids, index names, percentages and keyword tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import constants as C

# A Han character is a word of its own; other letters, digits and underscores join into words.
WORD_PATTERN = r"\p{IsHan}|[\p{L}\p{N}_&&[^\p{IsHan}]]+"


def masked_phone(tel: Column) -> Column:
    """The leading characters and a run of stars whose length does not depend on the number's."""
    return F.concat(F.substring(tel, 1, C.PHONE_KEEP), F.lit(C.PHONE_STARS))


def mask_phone(df: DataFrame, column: str = "consignee_tel") -> DataFrame:
    return df.withColumn(column, masked_phone(F.col(column)))


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between two days (not calendar years); null for an unreadable birthday."""
    days = F.date_diff(as_of.cast("date"), birthday.try_cast("date"))
    return F.call_function("div", days, F.lit(C.DAYS_PER_AGE_YEAR)).cast("int")


def with_age(df: DataFrame, birthday: str = "birthday", as_of: Column | str | None = None) -> DataFrame:
    return df.withColumn("user_age", age_in_years(F.col(birthday), as_of_day(as_of)))


def as_of_day(as_of: Column | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of) if isinstance(as_of, str) else as_of


def index_name(prefix: str, as_of: Column | str | None = None) -> Column:
    """``<prefix>-yyyy-MM-dd`` for the processing day."""
    return F.concat(F.lit(prefix), F.lit("-"), as_of_day(as_of).cast("date").cast("string"))


def upper_columns(df: DataFrame) -> DataFrame:
    """The same rows under upper-cased column names, as the relational order table declares them."""
    return df.toDF(*[name.upper() for name in df.columns])


def percent(part: Column, total: Column) -> Column:
    """Share in percent with one decimal, halves rounded up; 0.0 of an empty total."""
    tenths = F.floor(part * F.lit(1000.0) / F.nullif(total, F.lit(0)) + F.lit(0.5))
    return F.coalesce(tenths / F.lit(10.0), F.lit(0.0)).cast("double")


def percent_rest(*parts: Column) -> Column:
    """What the given percentages leave of 100, with one decimal."""
    rest = F.lit(100.0)
    for part in parts:
        rest = rest - part
    return (F.floor(rest * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)).cast("double")


def words(text: Column) -> Column:
    """Lower-cased words of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def has_all_words(text: Column, keyword: str) -> Column:
    """True where every word of the keyword is a word of the text; a keyword without words matches nothing."""
    wanted = words(F.lit(keyword))
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, words(text))) == 0)
