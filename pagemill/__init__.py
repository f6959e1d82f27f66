"""Document-page processing on Spark: scan, batch, infer, track and measure."""
