"""shoplens: shop-traffic analytics on Spark DataFrames, Spark SQL and Structured Streaming.

Sub-packages:
  sources    -- table scans, test-data adapters, ad-log parsing, stream sources
  functions  -- scalar helpers expressed as Catalyst column expressions
  operators  -- DataFrame -> DataFrame analytics (sessions, categories, page flow, areas, ads)
  sinks      -- keyed, replay-safe table sinks and JDBC append
  streaming  -- Structured Streaming jobs for the advertisement click log
  plans      -- the query catalogue used by ``__spark_entry__`` and the bench
"""

from shoplens.params import TaskParams
from shoplens.runtime import build_session, shared_dir

__all__ = ["TaskParams", "build_session", "shared_dir"]
