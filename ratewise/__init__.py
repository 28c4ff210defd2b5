"""ratewise: batch analytics over user-item ratings on Spark.

Layout: ``sources`` (readers/parsers), ``functions`` (column expressions),
``operators`` (cleaning, reshaping, joins, aggregates, ranking), ``sinks``
(stored tables and documents), ``plans`` (composite jobs and plan checks),
``streaming`` (incremental ingest), ``cli`` (spark-submit jobs),
``fixtures``/``oracle`` (adapters over the driver's tables and their DuckDB text),
``registry`` (the registered queries).
"""

__version__ = "0.1.0"
