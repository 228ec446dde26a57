"""Click-stream and product analytics on Spark: DataFrame in, DataFrame out."""
