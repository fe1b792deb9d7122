"""shoplens: real-time commerce analytics expressed as Spark DataFrame and
Structured Streaming jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from built-in
column expressions, so Catalyst can prune, push down and plan it; the same
function serves batch and streaming wherever Spark allows.
"""

__version__ = "0.1.0"
