"""Strict date / timestamp parsing (never aborts a job on bad input)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from staylens.reference_data import DATE_PATTERN

# The usual spellings, read by Spark as they are: date, optional time with
# optional seconds / fraction, optional Z or +hh:mm offset.
TIMESTAMP_PATTERN = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"
                     r"(Z|[+-]\d{2}:\d{2})?$")
# Also basic form, a comma or more digits in the fraction, hour only, offsets without minutes or colon.
ISO_PATTERN = (r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
               r"(?:Z|([+-]\d{2})(?::?(\d{2}))?)?)?$")


def strict_date(s: Column) -> Column:
    """DATE of a ``YYYY-MM-DD`` string; NULL for any other spelling or impossible day."""
    return F.when(s.rlike(DATE_PATTERN), F.try_to_date(s, "yyyy-MM-dd"))


def strict_timestamp(s: Column) -> Column:
    """UTC TIMESTAMP of an ISO-8601 string (no offset = UTC); NULL otherwise."""
    part = lambda i: F.regexp_extract(s, ISO_PATTERN, i)
    two = lambda i: F.lpad(part(i), 2, "0")
    spelled = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), two(4), F.lit(":"), two(5),
                       F.lit(":"), two(6), F.lit("."), F.rpad(part(7), 6, "0"),
                       F.when(part(8) == "", F.lit("+00")).otherwise(part(8)), F.lit(":"), two(9))
    return (F.when(s.rlike(TIMESTAMP_PATTERN), F.try_to_timestamp(s))
            .when(s.rlike(ISO_PATTERN), F.try_to_timestamp(spelled)))
