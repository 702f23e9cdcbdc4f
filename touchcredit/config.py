"""Model parameters and the fixed values the results depend on."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# --- fixed values (must stay equal to the modelled pipeline) -----------------
# Event that opens a session (a touchpoint) and event that is a conversion.
TOUCH_EVENT = "session_start"
CONVERSION_EVENT = "purchase"
# Defaults when a touchpoint has no source / medium, and the label separator.
DEFAULT_SOURCE = "(direct)"
DEFAULT_MEDIUM = "(none)"
CHANNEL_SEPARATOR = " / "
# Model tags.
FIRST_CLICK = "first_click"
LAST_CLICK = "last_click"
MODELS = (FIRST_CLICK, LAST_CLICK)
# Lineage tags of the two feeds.
BATCH_TAG = "batch"
STREAM_TAG = "streaming"
# Accepted event names of the staging relation.
ACCEPTED_EVENT_NAMES = (
    "session_start",
    "page_view",
    "view_item",
    "add_to_cart",
    "begin_checkout",
    "purchase",
)
# Default lookback (days), trailing batch window (days), freshness limits (hours).
DEFAULT_LOOKBACK_DAYS = 30
DEFAULT_BATCH_WINDOW_DAYS = 60
FRESHNESS_WARN_HOURS = 26
FRESHNESS_ERROR_HOURS = 50
# Idempotency key: this many leading hex digits of sha256(user|micros|name).
EVENT_KEY_HEX_DIGITS = 16
# ----------------------------------------------------------------------------

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


@dataclass(frozen=True)
class AttributionConfig:
    """Parameters of one attribution run.

    ``lookback_days`` is exact elapsed time (``days * 86400`` seconds), never
    calendar days in a session zone. ``chunk_us`` is the width of the time
    chunks the as-of credit operator sorts within; it bounds the rows one
    window task sees for a single user and does not change results. With minutes, a user's carry has at most
    1,440 rows a day of history, whatever the number of events. ``fine_us`` splits the chunks again, for bursts within them.
    """

    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    as_of: _dt.date | None = None
    batch_window_days: int | None = DEFAULT_BATCH_WINDOW_DAYS
    chunk_us: int = 60 * MICROS_PER_SECOND
    # Where given, windows run over (user, fine chunk) groups; chunk_us is a multiple of it.
    fine_us: int | None = None

    @property
    def lookback_us(self) -> int:
        return int(self.lookback_days) * MICROS_PER_DAY
