"""Record linkage and data quality for identifier registries, written as Spark DataFrame jobs."""
