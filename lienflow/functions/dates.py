"""Date and office-hour expressions."""

from __future__ import annotations

from lienflow import fixed_values as fixed
from lienflow.functions.sql import quote, replace_all
from lienflow.functions.text import strip

# Accepted shapes of a date and how each reads as year-month-day after a "=".
# A month is a number or the first three letters of its name.  Years of two digits from 69 on
# belong to the last century.
SLASH_SHAPES = [
    (r"^(\d{1,2})/(\d{1,2})/((?!0000)\d{4})$", "=$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(69|[7-9]\d)$", "=19$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/([0-5]\d|6[0-8])$", "=20$3-$1-$2"),
]
OTHER_SHAPES = [
    (r"(?s)^((?!0000)\d{4}-\d{1,2}-\d{1,2})T.*$", "=$1"),
    (r"^(\d{1,2})-(\d{1,2})-((?!0000)\d{4})$", "=$3-$1-$2"),
    (r"^((?!0000)\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0?[1-9])$", "=$1-$2-$3"),
    (r"^(?:(\d{1,2})-([A-Za-z]{3})-|([A-Za-z]{3})\s+(\d{1,2}),\s+)((?!0000)\d{4})$", "=$5-$2$3-$1$4"),
]
ISO_SHAPE = r"^(?!0000)\d{4}-\d{2}-\d{2}$"


def normalize_date(value: str) -> str:
    """The date in any accepted shape, null when the text is no valid date.

    ISO dates, the usual case, are parsed at once.  Otherwise each shape rewrites its own texts only, and
    what no shape fits lacks the "=" that the parser asks for.
    """
    text = strip(value)
    plain = f"translate({text}, '=', ' ')"
    marked = f"if(contains({text}, '/'), {replace_all(plain, *SLASH_SHAPES)}, {replace_all(plain, *OTHER_SHAPES)})"
    other = f"try_to_date({marked}, {quote(chr(39) + '=' + chr(39) + 'yyyy-[MMM][M]-d')})"
    return f"if({text} RLIKE {quote(ISO_SHAPE)}, try_to_date({text}, 'yyyy-MM-dd'), {other})"


def is_before(filing_date: str, since: str) -> str:
    """True only when both dates are readable and the first is earlier; text or dates."""

    def read(day: str) -> str:
        return f"try_to_date(left(cast({day} AS string), 10), 'yyyy-M-d')"

    return f"coalesce({read(filing_date)} < {read(since)}, false)"


def _clock(time: str) -> str:
    return f"interval '{time}' hour to minute"


def within_office_hours(moment: str, zone: str) -> str:
    """True when the moment falls in office hours of the zone; false for an unknown zone."""
    local = f"from_utc_timestamp({moment}, {zone})"
    day = f"date_trunc('day', {local})"
    opened = f"{local} BETWEEN {day} + {_clock(fixed.OFFICE_OPENS)} AND {day} + {_clock(fixed.OFFICE_CLOSES)}"
    return f"coalesce(({opened}) AND weekday({local}) < 5, false)"


def next_office_moment(moment: str, zone: str) -> str:
    """The moment itself in office hours, else the next weekday opening; null for an unknown zone."""
    local = f"from_utc_timestamp({moment}, {zone})"
    today = f"date_trunc('day', {local}) + {_clock(fixed.OFFICE_OPENS)}"
    opening = f"if({today} > {local}, {today}, {today} + interval 1 day)"
    weekend = f"CASE weekday({opening}) WHEN 5 THEN interval 2 day WHEN 6 THEN interval 1 day ELSE interval 0 day END"
    later = f"to_utc_timestamp({opening} + {weekend}, {zone})"
    return f"if({within_office_hours(moment, zone)}, {moment}, {later})"
