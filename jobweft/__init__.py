"""Spark-native analytics over job-advertisement snapshots.

Sub-packages: ``sources`` (bronze and silver tables, payload adapters),
``functions`` (column functions), ``operators`` (DataFrame-to-DataFrame steps),
``plans`` (reports, quality checks, the incremental load) and ``streaming``
(the same load driven by Structured Streaming).
"""

#: Version stamped on every posting and every finished run.
PARSER_VERSION = "v2"
