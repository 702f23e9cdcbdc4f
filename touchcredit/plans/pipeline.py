"""The assembled batch pipeline: sources -> staging -> journeys -> credit ->
marts, each a lazy DataFrame so Catalyst sees (and prunes) the whole plan."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from touchcredit.config import AttributionConfig
from touchcredit.operators import credit as cr
from touchcredit.operators import journeys, marts, staging
from touchcredit.session import ensure_utc
from touchcredit.sources import batch as batch_src
from touchcredit.sources import events_adapter as ea
from touchcredit.streaming import ingest

# Fixed 'today' of the given tables (data span 2024-01-01..2024-01-30).
AS_OF = _dt.date(2024, 1, 31)


@dataclass(frozen=True)
class Inputs:
    batch_raw: DataFrame
    stream_table: DataFrame | None = None


def driver_inputs(spark: SparkSession, sf_dir: str, split_feeds: bool = False,
                  batch_window_days: int | None = None, as_of: _dt.date = AS_OF,
                  hot_user: bool = False) -> Inputs:
    """Feeds derived from the given ``events`` table.

    ``split_feeds=False``: every event arrives through the batch export.
    ``split_feeds=True``: 10 % arrive through the stream (with replays),
    deduplicated by the idempotent ingest, the rest through the batch.
    """
    ensure_utc(spark)
    ev = ea.load_events(spark, sf_dir)
    if hot_user:
        ev = ea.with_hot_user(ev)
    if batch_window_days is not None:
        # the same window on the source column, so it reaches the Parquet reader
        ev = ea.restrict_days(ev, *batch_src.window_bounds(as_of, batch_window_days))
    raw = ea.raw_batch(ev, "batch" if split_feeds else "all")
    raw = batch_src.restrict_window(raw, as_of, batch_window_days)
    if not split_feeds:
        return Inputs(raw)
    return Inputs(raw, ingest.dedupe_deliveries(ea.stream_deliveries(ev, "streaming")))


@dataclass
class Pipeline:
    inputs: Inputs
    config: AttributionConfig = field(default_factory=AttributionConfig)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_events(self.inputs.batch_raw, self.inputs.stream_table)

    @cached_property
    def touchpoints(self) -> DataFrame:
        return journeys.touchpoints(self.stg)

    @cached_property
    def conversions(self) -> DataFrame:
        return journeys.conversions(self.stg)

    @cached_property
    def credited(self) -> DataFrame:
        return cr.credit_events(self.stg, self.config.lookback_us,
                                chunk_us=self.config.chunk_us,
                                fine_us=self.config.fine_us)

    def mart(self, model: str) -> DataFrame:
        return cr.mart(self.credited, model)

    @cached_property
    def channel_daily(self) -> DataFrame:
        return marts.channel_daily(self.credited)

    def with_written_credit(self) -> "Pipeline":
        """The same pipeline with the credit relation computed once and
        written to the shared folder (for outputs with several branches)."""
        from touchcredit.session import cut_lineage
        q = Pipeline(self.inputs, self.config)
        q.__dict__["credited"] = cut_lineage(self.credited, "credited")
        return q

    def relations(self) -> dict[str, DataFrame]:
        """The relations the schema checks look at, by their model names."""
        from touchcredit import config as C
        return {
            "stg_events": self.stg,
            "int_touchpoints": self.touchpoints,
            "int_conversions": self.conversions,
            "mart_attribution_first_click": self.mart(C.FIRST_CLICK),
            "mart_attribution_last_click": self.mart(C.LAST_CLICK),
            "mart_channel_daily": self.channel_daily,
        }
