"""Machine telemetry on Spark: decode, validate, alert, store, roll up and report.

Operators are plain ``DataFrame -> DataFrame`` functions without actions, so the
same code runs in batch jobs and inside Structured Streaming micro-batches.
"""
