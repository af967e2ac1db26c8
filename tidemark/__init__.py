"""tidemark: versioned-event analytics on Spark.

Change log -> validated operations -> set-based fold into append-only version
rows -> latest-version reads, rollups and a merge-on-read current state.
"""

__version__ = "0.1.0"
