"""Time-series preservation and analytics, expressed as Spark DataFrame transformations."""
