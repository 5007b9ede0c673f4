"""shiftlens: Spark-native analytics for daily nursing-facility staffing records.

Layers: ``sources`` (raw landing/scan, the test panel, Parquet sinks),
``operators`` (bronze->silver, gold builders, scalable ranks), ``functions``
(column expressions), ``plans`` (views, dashboard queries, jobs, SQL views),
``streaming`` (incremental ingest). Jobs run via ``python -m shiftlens``.
"""

__version__ = "0.1.0"
