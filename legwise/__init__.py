"""legwise: rolling-window trip-leg analytics on Spark.

Load daily leg files, clean and deduplicate them by a row hash, assign block
groups with a distributed point-in-polygon join, order the legs of each trip
and detect transfers with window functions, rebuild the daily aggregates and
write numbered, map-ready line and point tables.
"""

__version__ = "0.1.0"
