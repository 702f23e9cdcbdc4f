"""touchcredit: first/last-click revenue attribution on Spark.

Layers, each a function ``DataFrame -> DataFrame``:

* ``sources``   – raw batch export, streaming table, CSV, stream source, sinks
* ``functions`` – column expressions (param lookup, channel label, keys, time)
* ``operators`` – staging, journeys, as-of credit, marts, reports, quality
* ``plans``     – the assembled pipeline and the named query catalogue
* ``streaming`` – idempotent ingest, refresh, live panel, near-real-time credit
"""

from touchcredit.config import AttributionConfig

__all__ = ["AttributionConfig"]
