"""tablekit: everyday analytics on Spark tables and streams.

Subpackages
-----------
sources    readers, writers, generated tables
operators  relational helpers, DML on snapshot tables, skew handling, ML, runs
functions  scalar / array helpers and the UDF surface
streaming  incremental file ingest and windowed stream counts
plans      the registered queries checked against an SQL oracle
"""

__version__ = "0.1.0"
