"""orderlake: commerce analytics on Spark, from raw order files to governed metrics."""
