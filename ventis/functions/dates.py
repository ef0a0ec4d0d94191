"""Timestamps: mixed-format parsing, calendar parts, seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_FIRST = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(?!\d)"
_YEAR_FIRST = r"^(\d{4})[/.-](\d{1,2})[/.-](\d{1,2})"
# Two-digit years: 00-69 are 2000-2069, 70-99 are 1970-1999.
_SHORT_2000 = r"^(\d{1,2})[/.-](\d{1,2})[/.-]([0-6]\d)(?!\d)"
_SHORT_1900 = r"^(\d{1,2})[/.-](\d{1,2})[/.-]([7-9]\d)(?!\d)"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])"
_COMPACT_TIME = r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})$"
# A letter other than the T and Z of ISO texts: a month's name or AM/PM.
_SPELLED = r"(?i)[a-su-y]"
_MONTH_FIRST = r"(?i)^([a-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(?=\d{4})"
_AROUND_MONTH = r"^(\d{1,2})(?:st|nd|rd|th)?[\s/.-]+(\d{2})[\s/.,-]+(\d{4})"
_CLOCK_12 = r"(?i)(?<=[T ])(0?[1-9]|1[0-2])(?::(\d{2}))?(?::(\d{2}(?:\.\d+)?))?\s*([ap])\.?m\.?$"
# English month names and short forms.
_MONTHS = [
    "jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?",
    "aug(?:ust)?", "sep(?:t|tember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?",
]

# Southern-hemisphere season of each month.
SEASONS = {
    "verano": [12, 1, 2],
    "otono": [3, 4, 5],
    "invierno": [6, 7, 8],
    "primavera": [9, 10, 11],
}
UNKNOWN_SEASON = "desconocida"

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _numbered(text: Column) -> Column:
    """A date with a month's name as day-month-year digits."""
    text = F.regexp_replace(text, _MONTH_FIRST, "$2 $1 ")
    for number, name in enumerate(_MONTHS, 1):
        text = F.regexp_replace(text, rf"(?i)(?<![a-z]){name}(?![a-z])\.?", f"{number:02d}")
    return F.regexp_replace(text, _AROUND_MONTH, "$1-$2-$3")


def _clock_24(text: Column) -> Column:
    """A time with AM or PM as hours from 0 to 23."""
    part = lambda group: F.regexp_extract(text, _CLOCK_12, group)
    digits = lambda group: F.when(part(group) == "", "00").otherwise(part(group))
    hour = part(1).try_cast("int") % 12 + F.when(F.lower(part(4)) == "p", 12).otherwise(0)
    shaped = F.concat(F.regexp_replace(text, _CLOCK_12, ""), F.lpad(hour.cast("string"), 2, "0"),
                      F.lit(":"), digits(2), F.lit(":"), digits(3))
    return F.when(text.rlike(_CLOCK_12), shaped).otherwise(text)


def parse_date_mixed(col: Column | str, policy: str = "iso") -> Column:
    """Text in mixed formats to TIMESTAMP_NTZ, NULL when unreadable.

    ``iso``: year-first dates are year-month-day, others are day-first (month-first only when
    day-first is impossible). ``legacy_dayfirst``: year-first dates are tried as year-day-month
    before year-month-day, which reproduces historical exports. Separators are ``/``, ``-`` and
    ``.``; compact digits, two-digit years, English month names and AM/PM are read too.
    """
    if policy not in ("iso", "legacy_dayfirst"):
        raise ValueError("policy debe ser 'iso' o 'legacy_dayfirst'.")
    shapes = [
        (_YEAR_FIRST, "$1-$2-$3"), (_DAY_FIRST, "$3-$2-$1"), (_DAY_FIRST, "$3-$1-$2"),
        (_SHORT_2000, "20$3-$2-$1"), (_SHORT_2000, "20$3-$1-$2"),
        (_SHORT_1900, "19$3-$2-$1"), (_SHORT_1900, "19$3-$1-$2"),
        (_COMPACT, "$1-$2-$3"), (_COMPACT_TIME, "$1-$2-$3 $4:$5:$6"),
    ]
    if policy == "legacy_dayfirst":
        shapes.insert(0, (_YEAR_FIRST, "$1-$3-$2"))

    def read(text: Column) -> Column:
        return F.coalesce(*[
            F.when(text.rlike(pattern),
                   F.regexp_replace(text, pattern, order).try_cast("timestamp_ntz"))
            for pattern, order in shapes
        ])

    text = F.trim(col)
    # Names and AM/PM are spelled out once per text, and only in texts that have letters.
    spelled = F.transform(F.transform(F.array(_numbered(text)), _clock_24), read)
    return F.coalesce(read(text), F.when(text.rlike(_SPELLED), F.element_at(spelled, 1)))


def season_of(ts: Column | str) -> Column:
    month = F.month(ts)
    season = F.lit(UNKNOWN_SEASON)
    for name, months in SEASONS.items():
        season = F.when(month.isin(*months), F.lit(name)).otherwise(season)
    return season


def day_name(ts: Column | str) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.get(names, F.weekday(ts))


def calendar_parts(ts: Column | str = "fecha_hora") -> dict[str, Column]:
    """Date, year, month, day, hour and English day name."""
    return {
        "fecha": F.to_date(ts),
        "anio": F.year(ts),
        "mes": F.month(ts),
        "dia": F.dayofmonth(ts),
        "hora": F.hour(ts),
        "dia_semana": day_name(ts),
    }


def feature_calendar(ts: Column | str = "fecha_hora") -> dict[str, Column]:
    """Calendar features of the forecast; here the weekday is a number, Monday = 0."""
    return {
        "hora": F.hour(ts),
        "dia": F.dayofmonth(ts),
        "mes": F.month(ts),
        "dia_semana": F.weekday(ts),
        "estacion_del_ano": season_of(ts),
    }


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour, computed without a time zone so NTZ values stay NTZ."""
    base = F.col(ts) if isinstance(ts, str) else ts
    zero = F.lit(0)
    return base - F.make_dt_interval(zero, zero, F.minute(base), F.extract(F.lit("SECOND"), base))


def plus_hours(ts: Column | str, hours: int) -> Column:
    base = F.col(ts) if isinstance(ts, str) else ts
    return base + F.expr(f"INTERVAL {int(hours)} HOURS")


def iso_timestamp(ts: Column | str) -> Column:
    """ISO text; microseconds are written only when there are any."""
    text = (F.col(ts) if isinstance(ts, str) else ts).cast("string")
    whole = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.when(F.length(text) > 19, F.concat(whole, F.lit("."), micros)).otherwise(whole)
