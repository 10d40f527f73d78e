"""heliolake — telemetry pipelines (decode, shape, window, upsert, deliver) as Spark jobs.

Every transform is a ``DataFrame -> DataFrame`` function built from Spark SQL built-ins, so
the same code runs on batch tables and on Structured Streaming micro-batches.
"""

__version__ = "0.1.0"
