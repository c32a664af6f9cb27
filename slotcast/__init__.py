"""slotcast: sensor occupancy analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` keyed by ``sensor_id``
and partitioned by ``(sensor_id, date)`` so that no single sensor ends up in
one task.  See README.md for the module map.
"""

__version__ = "0.1.0"
