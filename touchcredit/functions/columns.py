"""Small column expressions shared by the operators (P6, P7, P8, P11,
P12, P13). All JVM-side; no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchcredit import config as C


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def source_or_default(source: str | Column = "source") -> Column:
    return F.coalesce(_c(source), F.lit(C.DEFAULT_SOURCE))


def medium_or_default(medium: str | Column = "medium") -> Column:
    return F.coalesce(_c(medium), F.lit(C.DEFAULT_MEDIUM))


def channel_label(source: str | Column = "source", medium: str | Column = "medium") -> Column:
    """``coalesce(source,'(direct)') || ' / ' || coalesce(medium,'(none)')``"""
    return F.concat(source_or_default(source), F.lit(C.CHANNEL_SEPARATOR), medium_or_default(medium))


def conversion_id(user: str | Column = "user_pseudo_id", micros: str | Column = "event_timestamp") -> Column:
    """``user || '-' || cast(micros as string)``; NULL when either side is NULL."""
    return F.concat(_c(user), F.lit("-"), _c(micros).cast("string"))


def event_key(user: str | Column = "user_pseudo_id", micros: str | Column = "event_timestamp",
              name: str | Column = "event_name") -> Column:
    """Idempotency key: leading hex digits of sha256(``user|micros|name``).

    NULL inputs give a NULL key (never the hash of the text ``None``); the
    quality checks report such rows.
    """
    raw = F.concat(_c(user), F.lit("|"), _c(micros).cast("string"), F.lit("|"), _c(name))
    return F.substring(F.sha2(raw, 256), 1, C.EVENT_KEY_HEX_DIGITS)


def blank_to_null(x: str | Column) -> Column:
    """``NULLIF(x, '')``"""
    return F.nullif(_c(x), F.lit(""))


def text_to_double(x: str | Column) -> Column:
    """``CASE WHEN x = '' THEN NULL ELSE CAST(x AS REAL) END``; junk text gives
    NULL instead of failing the job under ANSI mode."""
    return F.when(_c(x) == "", F.lit(None).cast("double")).otherwise(_c(x).try_cast("double"))


def micros_to_ts(micros: str | Column = "event_timestamp") -> Column:
    """``timestamp_micros``; kept beside the raw micros, which the
    arithmetic uses."""
    return F.timestamp_micros(_c(micros))


def ntz_to_micros(ts: str | Column) -> Column:
    """Micros since the epoch of a TIMESTAMP_NTZ read as UTC."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def micros_to_day(micros: str | Column) -> Column:
    """``yyyyMMdd`` of the UTC day of ``micros``."""
    return F.date_format(F.timestamp_micros(_c(micros)), "yyyyMMdd")
