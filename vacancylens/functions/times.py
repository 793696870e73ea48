"""Timestamps and epochs. The session time zone is pinned to UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ENVELOPE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_iso(text: Column) -> Column:
    """A timestamp from ISO text; a text without a full date is NULL."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}(?:[ T].*)?$"), F.try_to_timestamp(text))


def format_iso(moment: Column) -> Column:
    return F.date_format(moment, ENVELOPE_FORMAT)


def epoch_seconds(moment: Column) -> Column:
    return F.unix_seconds(moment)


def display_date(moment: Column) -> Column:
    """Like ``1 December 2021``."""
    return F.date_format(moment, "d MMMM yyyy")


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def snapshot_key(obtained: Column, source_name: Column) -> Column:
    """``<epoch seconds>_<source>``, the name a snapshot is archived under."""
    return F.concat_ws("_", epoch_seconds(obtained).cast("string"), source_name)
