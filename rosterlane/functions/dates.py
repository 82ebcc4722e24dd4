"""Report dates. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlane.fixed_values import EXPORT_STAMP, REPORT_DATE, REPORT_ZONE


def local_date(moment: Column, zone: str = REPORT_ZONE, utc_wall: bool = False) -> Column:
    """Calendar date of a moment in the report's zone.

    ``moment`` is a TIMESTAMP (an instant); with ``utc_wall`` it is a TIMESTAMP_NTZ read as UTC.
    """
    source = F.lit("UTC") if utc_wall else F.current_timezone()
    return F.convert_timezone(source, F.lit(zone), moment.cast("timestamp_ntz")).cast("date")


def report_date(moment: Column, zone: str = REPORT_ZONE, utc_wall: bool = False) -> Column:
    """Date text of the detail rows, zero padded."""
    return F.date_format(local_date(moment, zone, utc_wall), REPORT_DATE)


def export_stamp(moment: Column, zone: str = REPORT_ZONE, utc_wall: bool = False) -> Column:
    """Date text of the exported report's name."""
    return F.date_format(local_date(moment, zone, utc_wall), EXPORT_STAMP)


def parse_report_date(column: Column) -> Column:
    """Date of a report date text."""
    return F.to_date(column, REPORT_DATE)
