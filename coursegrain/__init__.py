"""Course-package analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver.  Tables are keyed by ``export_id`` (one exported course package)
so one job covers a whole catalogue of packages.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
