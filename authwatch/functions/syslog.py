"""Expressions over a raw syslog line and the path it came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the syslog header, the header time, and the
# full header (time, host, process, optional pid, text).
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
TIME_PATTERN = rf"((?:{MONTHS}) +[0-9]{{1,2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})"
HEADER_PATTERN = (r"^([A-Z][a-z]{2} +[0-9]{1,2} [0-9:]{8}) ([^ ]+) (.*?)"
                  r"(?:\[([0-9]+)\])?: (.*)$")
MONTH_ORDER = MONTHS.replace("|", "")


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def file_stem(path: Column) -> Column:
    """``/data/ssh-20240131.log`` -> ``20240131``."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"^ssh-|\.log$", "")


def year_of(stem: Column) -> Column:
    return F.substring(stem, 1, 4)


def syslog_time(message: Column) -> Column:
    """Header time as written, from anywhere in the line; NULL if absent."""
    return blank_to_null(F.regexp_extract(message, TIME_PATTERN, 1))


def header_parts(message: Column) -> Column:
    """Groups of the header as an array, from one match; NULL if the line has none.

    The replacement sets the groups apart by U+0001. A line may hold that character
    too, so it is first written as U+0002 and a digit, and read back in each group.
    """
    stands_for = (("\u0002", "\u00020"), ("\u0001", "\u00021"))
    plain = message
    for character, written in stands_for:
        plain = F.replace(plain, F.lit(character), F.lit(written))
    apart = F.regexp_replace(plain, HEADER_PATTERN, "$1\u0001$2\u0001$3\u0001$4\u0001$5")

    def read_back(group: Column) -> Column:
        for character, written in reversed(stands_for):
            group = F.replace(group, F.lit(written), F.lit(character))
        return group

    groups = F.split(apart, "\u0001")
    odd = F.contains(message, F.lit("\u0001")) | F.contains(message, F.lit("\u0002"))
    return F.when(F.contains(apart, F.lit("\u0001")),
                  F.when(odd, F.transform(groups, read_back)).otherwise(groups))


def month_number(name: Column) -> Column:
    """``Jan`` .. ``Dec`` -> 1 .. 12, by its place in the list of names."""
    return ((F.instr(F.lit(MONTH_ORDER), name) + 2) / 3).cast("int")


def instant(year: Column, log_time: Column, log_tz: str = "UTC") -> Column:
    """Year + header time, read in ``log_tz``. Impossible dates become NULL.

    The text is rearranged to an ISO date, because the plain cast is much
    cheaper than a pattern parser. The day may be padded with a blank.
    """
    month = month_number(F.substring(log_time, 1, 3)).cast("string")
    day = F.trim(F.substring(log_time, F.lit(4), F.length(log_time) - 11))
    clock = F.substring(log_time, -8, 8)
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), clock)
    local = text.try_cast("timestamp")
    return local if log_tz == "UTC" else F.to_utc_timestamp(local, log_tz)


def kst_iso(ts: Column) -> Column:
    """The instant as ISO text with millisecond precision at +09:00."""
    return F.date_format(F.from_utc_timestamp(ts, "Asia/Seoul"),
                         "yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00'")


def fingerprint(*cols: Column) -> Column:
    return F.sha2(F.concat_ws(":", *cols), 256)


def local_time(ts: Column, report_tz: str = "UTC") -> Column:
    return ts if report_tz == "UTC" else F.from_utc_timestamp(ts, report_tz)
