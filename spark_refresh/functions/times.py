"""Wall clock times in one fixed zone, and their text and epoch forms.

Nothing here reads the session zone: NTZ values are taken apart field by field or
cast to text, both of which Spark does without a zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of all event times and the text form they are stored in.
ZONE = "America/Phoenix"
TEXT_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


# Fixed value: seconds from the start of the first year to 1970.
SECONDS_TO_1970 = 62_135_596_800


def wall(value: datetime | str) -> Column:
    """A wall clock literal; it folds to a constant, so filters on it push down."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def as_wall(value: Column | datetime | str) -> Column:
    return value if isinstance(value, Column) else wall(value)


def plus_seconds(c: Column, seconds: Column | int) -> Column:
    amount = F.lit(seconds) if isinstance(seconds, int) else seconds
    return c + amount.cast("bigint") * F.lit(timedelta(seconds=1))


def wall_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 on the same clock, rounded down.

    Counted from the first year, before which no time lies, as casts cut towards zero.
    """
    since = (c - wall("0001-01-01 00:00:00")).cast("interval second").cast("bigint")
    return since - SECONDS_TO_1970


def seconds_to_wall(seconds: Column) -> Column:
    return plus_seconds(wall("1970-01-01 00:00:00"), seconds)


def utc_wall(c: Column) -> Column:
    """The wall clock of UTC at an instant, to the microsecond, whatever the session zone is."""
    return wall("1970-01-01 00:00:00") + F.unix_micros(c) * F.lit(timedelta(microseconds=1))


def zone_wall(c: Column, zone: str = ZONE) -> Column:
    """The wall clock of ``zone`` at an instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall(c))


def instant(value: datetime | str, zone: str = ZONE) -> Column:
    """The instant at which the clock of ``zone`` shows a time; a literal, so filters push down."""
    shown = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    return F.lit(shown.replace(tzinfo=ZoneInfo(zone)))


def drop_fraction(c: Column) -> Column:
    """The time without its fraction of a second."""
    return seconds_to_wall(wall_seconds(c))


def to_epoch(c: Column, zone: str = ZONE) -> Column:
    """Epoch seconds of a wall clock time read in ``zone``."""
    return wall_seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), c))


def from_epoch(seconds: Column, zone: str = ZONE) -> Column:
    """Wall clock time in ``zone`` of an epoch second."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), seconds_to_wall(seconds))


def parse_text(c: Column) -> Column:
    """Text to wall clock time, NULL where the text is not a valid time.

    Fields may be unpadded and further apart than one blank. The cast to TIMESTAMP_NTZ
    reads them without a zone; the shape leaves out what else it would take.
    """
    spaced = F.regexp_replace(c, r"\s+", " ")
    return F.when(
        c.rlike(TEXT_SHAPE),
        F.coalesce(c.try_cast("timestamp_ntz"), spaced.try_cast("timestamp_ntz")),
    )


def is_valid_text(c: Column) -> Column:
    return F.coalesce(parse_text(c).isNotNull(), F.lit(False))


def require_text(c: Column) -> Column:
    """Like :func:`parse_text`, but a bad or missing text stops the job."""
    shown = F.coalesce(c, F.lit("NULL"))
    return F.coalesce(
        parse_text(c),
        F.raise_error(F.concat(F.lit("not a yyyy-MM-dd HH:mm:ss time: "), shown)).cast("timestamp_ntz"),
    )


def format_text(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 19)


def short_text(c: Column) -> Column:
    """Short local form, for example ``3/18/25 4:26 AM``."""
    half_day = F.hour(c) % 12

    def two_digits(n: Column) -> Column:
        return F.lpad(n.cast("string"), 2, "0")

    return F.concat(
        F.month(c).cast("string"), F.lit("/"), F.dayofmonth(c).cast("string"), F.lit("/"),
        two_digits(F.year(c) % 100), F.lit(" "),
        F.when(half_day == 0, F.lit("12")).otherwise(half_day.cast("string")), F.lit(":"),
        two_digits(F.minute(c)), F.when(F.hour(c) < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from one epoch second to another, to two decimals."""
    return F.round((end - start) / 60, 2)


def iso_normalise(c: Column) -> Column:
    """``2025-01-01T00:00:00.000Z`` to ``2025-01-01 00:00:00``."""
    return F.replace(F.replace(c, F.lit("T"), F.lit(" ")), F.lit(".000Z"), F.lit(""))


def in_hours(c: Column, start: int, end: int) -> Column:
    """True in the hours ``start <= hour < end``, when no copy should start."""
    if start > end:
        raise ValueError(f"window must start before it ends: {start} > {end}")
    return (F.hour(c) >= start) & (F.hour(c) < end)


def avoid_window(c: Column, window: str) -> Column:
    """The window given as text such as ``6-18``; without a dash it never holds."""
    if "-" not in window:
        return F.lit(False)
    start, end = (int(part) for part in window.split("-"))
    return in_hours(c, start, end)


def past_top_of_hour(c: Column) -> Column:
    """False in the first three minutes of an hour, when claims wait."""
    return F.minute(c) > 2


def claims_open(c: Column, hold: bool = False, avoid: str = "") -> Column:
    """Whether claims may begin at a wall clock time: with ``hold`` not in the first minutes
    of an hour, and never in the hours ``avoid`` names."""
    return (past_top_of_hour(c) if hold else F.lit(True)) & ~avoid_window(c, avoid)


def local_now(zone: str = ZONE) -> datetime:
    return datetime.now(ZoneInfo(zone)).replace(tzinfo=None, microsecond=0)


def wall_of_epoch(seconds: float, zone: str = ZONE) -> datetime:
    """The wall clock of ``zone`` at a time of the driver's clock, to the whole second."""
    return datetime.fromtimestamp(int(seconds), ZoneInfo(zone)).replace(tzinfo=None)
