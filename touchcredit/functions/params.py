"""Lookups in the repeated ``event_params`` struct (P1, P2) and the
repeated-key count used by the quality checks.

``event_params.key`` extracts the array of keys and ``array_position`` finds
the first match: both are whole-stage-codegen expressions (a lambda
``filter`` is interpreted per element). A key may occur twice in one event;
a scalar lookup then has no single answer, so we take the first match and
count such rows separately. A NULL or empty array gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARAMS = "event_params"


def _col(params: str | Column) -> Column:
    return F.col(params) if isinstance(params, str) else params


def _value(key: str, field: str, params: str | Column = PARAMS) -> Column:
    p = _col(params)
    idx = F.array_position(p["key"], F.lit(key))
    return F.when(idx > 0, p["value"][field][idx - F.lit(1)])


def param_int(key: str, params: str | Column = PARAMS) -> Column:
    """``(select value.int_value from unnest(event_params) where key = ...)``"""
    return _value(key, "int_value", params)


def param_str(key: str, params: str | Column = PARAMS) -> Column:
    """``(select value.string_value from unnest(event_params) where key = ...)``"""
    return _value(key, "string_value", params)


def key_count(key: str, params: str | Column = PARAMS) -> Column:
    """How often ``key`` occurs in the row's params (0 for NULL params)."""
    keys = F.coalesce(_col(params)["key"], F.array().cast("array<string>"))
    return F.size(keys) - F.size(F.array_remove(keys, F.lit(key)))


def repeated_key(key: str, params: str | Column = PARAMS) -> Column:
    """True when ``key`` occurs more than once in the row's params."""
    return key_count(key, params) > 1
