"""Network of a message: connected SSID, its signal strength and the display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ssid() -> Column:
    """Connected SSID, empty when the message has none."""
    return F.coalesce("connected_ssid", F.lit(""))


def rssi() -> Column:
    """Strength of the first scan entry with the connected SSID, 0 when there is none.

    Without a connected SSID the compare value is empty, so a hidden network can match.
    """
    matches = F.filter("scan", lambda entry: F.coalesce(entry.ssid, F.lit("")) == ssid())
    return F.coalesce(F.get(matches, F.lit(0)).rssi, F.lit(0))


def text(ssid_column: str = "ssid", rssi_column: str = "rssi") -> Column:
    return F.format_string("%s : %s", F.col(ssid_column), F.col(rssi_column))


def known(ssid_column: str = "ssid", rssi_column: str = "rssi") -> Column:
    return (F.col(ssid_column) != "") & (F.col(rssi_column) != 0)
