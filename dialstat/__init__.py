"""dialstat: phone-campaign analytics on Spark DataFrames.

Layers: ``sources`` (driver tables -> raw contacts, ingest, sinks),
``operators`` (cleaning, metrics, distributed ranks, KPI mart, reports,
data-quality checks), ``functions`` (reusable Column helpers), ``plans``
(query catalog, DuckDB oracle texts, ordered build) and ``streaming``
(the stateless cleaning stage applied to a stream of raw files).
"""

from dialstat.params import Params

__all__ = ["Params"]
