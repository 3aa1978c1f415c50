"""Text and instant rules of the two readers, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns.
# The consumers' idea of blank: Unicode space, but not the no-break spaces.
CONSUMER_BLANK = r"^[\s\x1c-\x1f\p{Z}&&[^\u00a0\u2007\u202f]]*$"
# The gateway trims every Unicode space, no-break ones included.
GATEWAY_SPACE = r"^[\s\p{Z}\x85]+|[\s\p{Z}\x85]+$"
# An ISO-8601 instant: date, time with seconds, optional fraction, offset. A date alone is refused.
ISO_INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{0,9})?(Z|[+-]\d\d(:?\d\d(:?\d\d)?)?)$"
# The stricter form the gateway decodes. Offsets go up to a day there, further than Spark's own.
RFC3339 = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)\z"


def is_blank(text: Column) -> Column:
    return text.rlike(CONSUMER_BLANK)


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, GATEWAY_SPACE, "")


def instant(text: Column) -> Column:
    """Timestamp of an ISO-8601 instant; NULL for anything else, never an error."""
    upper = F.upper(text)
    return F.when(upper.rlike(ISO_INSTANT), F.try_to_timestamp(upper))


def is_rfc3339(text: Column) -> Column:
    """True for a time the gateway can decode. Only its local part is read, which holds all that can be wrong."""
    return text.rlike(RFC3339) & F.try_to_timestamp(F.substring(text, 1, 19)).isNotNull()


def instant_text(at: Column) -> Column:
    """UTC instant text with the shortest fraction: ``...:00Z``, ``...:00.25Z``."""
    full = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(full, r"\.?0+$", ""), F.lit("Z"))
