"""geoloom: geometry tables on Spark.

Tables and streams with geometry columns: decode, validate, repair, convert,
flatten, assemble and report, all as ``DataFrame -> DataFrame`` jobs.
"""

from geoloom.schema import GEOM, KINDS

__all__ = ["GEOM", "KINDS"]
