"""roadpulse: congestion analytics as plain DataFrame -> DataFrame functions on Spark.

``functions``  column expressions (time, text, geometry)
``sources``    readers, writers, calendars, publication exports
``operators``  single analytic steps (filters, dedup, aggregates, windows, spatial joins, cleaning)
``plans``      composed products (indices, region metadata, cleaning runs, incremental fill)
``streaming``  the live-feed form of the same steps
``suite``      the driver queries with their oracle SQL
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming", "session"]
