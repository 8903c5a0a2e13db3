"""Keep a lakehouse in step with a source warehouse, as Spark jobs.

The package scans a change-tracking table incrementally, turns events into a
prioritised work queue, copies tables through staged Parquet and reports on the
runs. Every step is a ``DataFrame -> DataFrame`` function.
"""
