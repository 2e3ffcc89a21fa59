"""vodlens — video-on-demand viewing analytics as plain Spark DataFrame jobs.

Layout: ``sources`` (readers and the test-table mapping), ``operators`` (cleaning
rules, joins and reports), ``functions`` (column expressions), ``sinks``
(JDBC, files, XML payloads), ``plans`` (report registry, daily/backfill runs),
``streaming`` (incremental landing of raw logs).
"""

__version__ = "0.1.0"
