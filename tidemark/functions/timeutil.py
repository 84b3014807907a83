"""Time columns (T1-T8).  Epoch milliseconds stay BIGINT and are the order
key; timestamps are derived for reporting only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import INTERVAL_MS, LOCAL_TZ

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_ms(c) -> Column:
    """Epoch ms of a TIMESTAMP_NTZ column (session-zone independent)."""
    name = c if isinstance(c, str) else None
    if name is not None:
        return F.expr(f"timestampdiff(MILLISECOND, {EPOCH_NTZ}, `{name}`)")
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), c)


def ms_to_utc(c) -> Column:
    """Exact epoch-ms -> TIMESTAMP (no floating /1000)."""
    return F.timestamp_millis(col_(c))


def utc_to_local(c, tz: str = LOCAL_TZ) -> Column:
    """DST-aware wall clock in ``tz``."""
    return F.from_utc_timestamp(col_(c), tz)


def add_local_time(df: DataFrame, ms_col: str, prefix: str, tz: str = LOCAL_TZ) -> DataFrame:
    """``<prefix>_dt_utc`` and ``<prefix>_dt_syd`` from an epoch-ms column."""
    utc_c = ms_to_utc(ms_col)
    return df.withColumns({f"{prefix}_dt_utc": utc_c, f"{prefix}_dt_syd": utc_to_local(utc_c, tz)})


def hour_of_day(c) -> Column:
    return F.hour(col_(c))


def weekday_short(c) -> Column:
    """T4: 'Mon'..'Sun'."""
    return F.date_format(col_(c), "E")


def weekday_long(c) -> Column:
    return F.date_format(col_(c), "EEEE")


def interval_ms_map() -> Column:
    return F.create_map(*[x for k, v in INTERVAL_MS.items() for x in (F.lit(k), F.lit(v).cast("long"))])


def interval_ms(c="interval") -> Column:
    """T5: interval label -> ms; unknown label -> NULL."""
    return interval_ms_map()[col_(c)]


def in_hours(ts, start: int, end: int) -> Column:
    """Hour of ``ts`` within [start, end] inclusive (UTC)."""
    return F.hour(col_(ts)).between(start, end)


# Session windows in GMT hours, inclusive start, exclusive end.
SESSIONS = {"asian": (22, 9), "american": (13, 21)}


def session_flags(ts) -> dict[str, Column]:
    """One boolean per session (they overlap, so flags rather than one label)."""
    h = F.hour(col_(ts))
    out = {}
    for name, (a, b) in SESSIONS.items():
        out[f"in_{name}"] = (h >= a) | (h < b) if a > b else (h >= a) & (h < b)
    return out


def session_label(ts) -> Column:
    """First matching label (Asian, then American), else 'Other'."""
    f = session_flags(ts)
    return F.when(f["in_asian"], "Asian").when(f["in_american"], "American").otherwise("Other")


def time_split(ts, train_end, valid_end) -> Column:
    """Half-open train [.., train_end), valid [train_end, valid_end), test."""
    t = col_(ts)
    return (F.when(t < F.lit(train_end), "train")
            .when(t < F.lit(valid_end), "valid")
            .otherwise("test"))
