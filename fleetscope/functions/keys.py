"""Key and date-part expressions (column expressions only, no actions).

Keys are positional: the client is the first three characters of the server
name, the host its fifth character, the disk the first character of the disk
name.  A name too short for a position gives the empty string, a NULL name a
NULL key.  Membership (which rows belong to a key) is in
``fleetscope.operators.membership``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import schema as S

# --- fixed values: key positions in the names (1-based start, length) ----------
CLIENT_POS = (1, 3)
HOST_POS = (5, 1)
DISK_POS = (1, 1)
# Weekday labels for dayofweek 1..7 (1 = Sunday).
DAY_LABELS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
# --- end of fixed values ---------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def client_key(name=S.SERVER) -> Column:
    return F.substring(_col(name), *CLIENT_POS)


def host_key(name=S.SERVER) -> Column:
    return F.substring(_col(name), *HOST_POS)


def disk_key(disk_name=S.DISK) -> Column:
    return F.substring(_col(disk_name), *DISK_POS)


DATE_PARTS = {
    "hour": F.hour,
    "dayofweek": F.dayofweek,
    "dayofmonth": F.dayofmonth,
}

# Report sections and the date part each one groups by.
SECTION_PARTS = {"hourly": "hour", "weekly": "dayofweek", "monthly": "dayofmonth"}


def date_part(part: str, ts=S.TIME) -> Column:
    try:
        fn = DATE_PARTS[part]
    except KeyError:
        raise ValueError(f"unknown date part {part!r}; one of {sorted(DATE_PARTS)}") from None
    return fn(_col(ts))


def day_label(dow) -> Column:
    """Weekday label of a ``dayofweek`` number (1 = Sunday)."""
    return F.element_at(F.array(*[F.lit(x) for x in DAY_LABELS]), _col(dow))
