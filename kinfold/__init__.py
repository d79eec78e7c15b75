"""kinfold: cohort-study analytics as lazy Spark DataFrame operators.

Sub-packages
------------
functions   Column -> Column expressions (casts, ids, answers, time rules, statistics helpers)
operators   DataFrame -> DataFrame steps (people, responses, scoring, enrollment summary,
            time-series combine, two-sample statistics, null-safe joins, reshape)
sources     readers for response envelopes, the data dictionary and date-named wearable CSV files
plans       shapes the benchmark tables into the study schemas and registers the named queries
streaming   incremental ingestion of date-named wearable files with Structured Streaming
"""

__version__ = "0.1.0"
