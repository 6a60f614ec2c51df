"""Dates of heterogeneous feeds as one ISO form, and as timestamps for order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks.functions.text import strip, text

#: Numbers above this are milliseconds.
MILLISECONDS = 1e11
#: The end of a date text that says where its clock stands.
OFFSET = r"(?i)[0-9](\s*(Z|UTC|GMT)|\s*[+-]\d{1,2}(:?\d{2})?)$"


def utc_clock(ts: Column) -> Column:
    """What a clock in UTC shows at an instant, as a timestamp without a zone,
    whatever the session's zone; one without a zone is such a clock already."""
    since = F.make_dt_interval(secs=F.unix_seconds(ts.cast("timestamp")))
    return F.when(F.typeof(ts) == "timestamp", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).otherwise(ts.cast("timestamp_ntz"))


def iso(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS+00:00`` of a timestamp, in any session; empty for
    null.  A timestamp without a zone counts as UTC."""
    shown = utc_clock(ts).cast("string")
    return F.coalesce(F.concat(F.replace(F.substring(shown, 1, 19), F.lit(" "), F.lit("T")), F.lit("+00:00")), F.lit(""))


def moment(s: Column) -> Column:
    """Timestamp of a text that begins with an ISO date; UTC without an offset."""
    bare = F.when(F.length(s) == 10, F.concat(s, F.lit("T00:00:00Z"))).when(~s.rlike(OFFSET), F.concat(s, F.lit("Z")))
    return F.try_to_timestamp(F.coalesce(bare, F.regexp_replace(s, r"([+-]\d{2})(\d{2})$", "$1:$2")))


def from_epoch(number: Column) -> Column:
    """Timestamp of epoch seconds or milliseconds; null where out of range."""
    x = number.cast("double")
    seconds = F.floor(F.when(F.abs(x) > MILLISECONDS, x / 1000).otherwise(x))
    return F.when(seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds))


def from_text(c: Column) -> Column:
    """Timestamp of an ISO, RFC-822 or epoch text; null where unreadable.

    A text of nine digits or more is an epoch; shorter ones (a year) are no
    date.  Texts without an offset are UTC.
    """
    s = strip(c)
    day = s.rlike(r"^\d{4}-\d{2}-\d{2}")
    compact = s.rlike(r"^\d{8}$")
    mail = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^[A-Za-z]{3,},\s*", ""), r"\s+(GMT|UTC|UT|Z)$", " +0000"), r"\s*\([^)]*\)$", "")
    zoned = mail.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}$")
    bare = mail.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}$")
    return (
        F.when(s.rlike(r"^-?\d{9,}$"), from_epoch(F.expr("0") + s.try_cast("double")))
        .when(day, moment(s))
        .when(compact, moment(F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")))
        .when(zoned, F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")))
        .when(bare, F.try_to_timestamp(F.concat(mail, F.lit(" +0000")), F.lit("d MMM yyyy HH:mm:ss Z")))
    )


def to_iso_utc(c: Column) -> Column:
    """Date text in the one ISO form, to the second; empty where unreadable."""
    return iso(F.date_trunc("second", from_text(c)))


def epoch_to_iso(c: Column) -> Column:
    """Numeric epoch in the one ISO form; null is empty."""
    return iso(from_epoch(c))


def instant(c: Column) -> Column:
    """Timestamp of a date text for ordering; null (sorted last) if unreadable."""
    s = text(c)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), moment(s))


def day_of(c: Column) -> Column:
    """ISO date that a date text names, empty if unreadable."""
    return F.coalesce(F.when(instant(c).isNotNull(), F.substring(text(c), 1, 10)), F.lit(""))
