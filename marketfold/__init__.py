"""marketfold: a Spark-native market-data medallion pipeline.

Raw feed frames -> canonical events -> dense per-market interval snapshots
-> Bronze NDJSON -> Silver typed Parquet -> staged export with manifests,
plus inventory, metrics, lag and alert queries.  Every operator is a
DataFrame -> DataFrame function usable from batch jobs and from
Structured Streaming ``foreachBatch`` / stateful operators.
"""

__version__ = "0.1.0"
