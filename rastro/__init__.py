"""Click-log analytics on Spark: cleaning, segments, recommendations, metrics."""
