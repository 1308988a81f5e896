"""Text, time and salary column functions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# City names and the spellings found in a location, first match wins.
CITY_RULES = (
    ("Berlin", ("berlin",)),
    ("Munich", ("munich", "münchen")),
    ("Hamburg", ("hamburg",)),
    ("Frankfurt", ("frankfurt",)),
    ("Cologne", ("cologne", "köln")),
    ("Vienna", ("vienna", "wien")),
    ("Zurich", ("zurich", "zürich")),
)

# Country codes and the spellings that imply them, first match wins.
COUNTRY_RULES = (
    ("DE", ("germany", "berlin", "munich", "münchen", "hamburg", "köln", "frankfurt", "cologne")),
    ("AT", ("austria", "vienna", "wien")),
    ("CH", ("switzerland", "zurich", "zürich")),
)

# Fixed value: the amount comes before the currency.  The blank class is spelled
# out because Java's \s also takes the vertical tab.
SALARY_PATTERN = r"(\d{2,3}[\.,]?\d{3})[\t\n\f\r ]*(?:€|EUR|euro)"

# Exclusive upper bounds of the salary bands, in EUR.
SALARY_BANDS = (
    (40_000, "<40k"),
    (60_000, "40-60k"),
    (80_000, "60-80k"),
    (100_000, "80-100k"),
    (130_000, "100-130k"),
)
TOP_SALARY_BAND = "130k+"

# Fixed value: the code points with the Unicode White_Space property.
UNICODE_BLANKS = (
    "\t\n\x0b\x0c\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# timestamp_seconds raises beyond these epoch seconds (years 0001 to 9999).
_EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)

Rules = Iterable[tuple[str, Iterable[str]]]


def first_match(text: Column, rules: Rules, otherwise: Column) -> Column:
    """Label of the first rule with a spelling inside ``text``, ignoring case."""
    lowered = F.lower(text)
    branches = F
    for label, spellings in rules:
        hit = reduce(lambda a, b: a | b, [lowered.contains(s) for s in spellings])
        branches = branches.when(hit, F.lit(label))
    return branches.otherwise(otherwise)


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def normalize_city(location: Column, rules: Rules = CITY_RULES) -> Column:
    """Known city name, else the trimmed location, else null."""
    return first_match(location, rules, blank_to_null(location))


def infer_country(location: Column, rules: Rules = COUNTRY_RULES) -> Column:
    """P10: country code, independent of the city rule; null when unknown."""
    return first_match(location, rules, F.lit(None).cast("string"))


def normalize_tag(tag: Column) -> Column:
    """Lower case without surrounding double quotes; blanks stay."""
    return F.lower(F.trim(tag, F.lit('"')))


def normalize_alias(alias: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(alias))


def strip_blanks(text: Column) -> Column:
    """Strips every kind of Unicode blank from both ends."""
    return F.trim(text, F.lit(UNICODE_BLANKS))


def extract_salary(text: Column) -> Column:
    """First amount in front of a currency; '' without one."""
    return F.regexp_extract(text, SALARY_PATTERN, 1)


def parse_salary(raw: Column) -> Column:
    """Amount without separators as INT, null when it is no number."""
    return F.translate(raw, ".,", "").try_cast("int")


def salary_band(eur: Column) -> Column:
    """Band label; the upper bounds are exclusive."""
    branches = F
    for bound, label in SALARY_BANDS:
        branches = branches.when(eur < bound, F.lit(label))
    return branches.otherwise(F.lit(TOP_SALARY_BAND))


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text to zone-less UTC; null when malformed."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def epoch_to_timestamp(seconds: Column) -> Column:
    """P5: epoch seconds to zone-less UTC; null outside the calendar's range."""
    return F.when(seconds.between(*_EPOCH_RANGE), F.timestamp_seconds(seconds)).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    """Start of the day, still zone-less."""
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def week_of(ts: Column) -> Column:
    """Start of the ISO week (Monday), still zone-less."""
    return F.date_trunc("week", ts).cast("timestamp_ntz")


def or_unknown(code: Column, unknown: str = "XX") -> Column:
    """The code, or the label of the unknown bucket."""
    return F.coalesce(code, F.lit(unknown))


def share(part: Column, whole: Column) -> Column:
    """Ratio as DOUBLE, null when the whole is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0).cast("bigint"))


def as_day(as_of: date | datetime | Column | None) -> Column:
    """The reference day of a clock-dependent query; today when not given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def within_days(ts: Column, days: int, as_of: date | datetime | Column | None = None) -> Column:
    """P25: at most ``days`` days before ``as_of``."""
    return ts >= F.date_sub(as_day(as_of), days).cast("timestamp_ntz")


def posting_key(source: Column, source_id: Column) -> Column:
    """One-column key; null when either part is null."""
    return F.concat(source, F.lit("|"), source_id)
