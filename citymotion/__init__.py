"""citymotion — a PySpark toolkit for city-mobility panels.

Everything is DataFrame-in / DataFrame-out.  No module holds a global
SparkSession; callers pass one where a source has to be read.
"""

LOCAL_TZ = "America/Toronto"

__all__ = ["LOCAL_TZ"]
