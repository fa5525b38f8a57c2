"""Layered-lake and event-stream analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns); tables, keys,
time columns and rules are arguments, so the same operator serves batch jobs,
``foreachBatch`` bodies and the end-to-end plans in :mod:`lakeweave.plans`.
"""

__version__ = "0.1.0"
