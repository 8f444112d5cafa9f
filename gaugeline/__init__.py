"""Host-metrics anomaly analytics on Spark, in batch and as a stream."""
