"""eventide: keyed event histories on Spark.

Batch and streaming operators that reduce each key's events to its type changes
(order-aware, late events rejected), keep each key's history, upsert the latest
state into a table and answer time-travel questions over it.
"""

__version__ = "0.1.0"
